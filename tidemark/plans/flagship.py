"""The flagship: as-of hit rates of every participation over 365 days, ranked within its event, summed by context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .demo import query, with_pt
from .windows import HIST, asof_rate

SQL = with_pt(
    """SELECT venue, rate_rank, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS wins, round(count(*) FILTER (WHERE finish = 1) / count(*), 6) AS win_rate
FROM (SELECT p.venue, p.finish, least(rank() OVER (PARTITION BY p.event ORDER BY r.rate DESC NULLS LAST), 5)::INT AS rate_rank FROM pt p JOIN
 (SELECT entity, d_idx, round(sum(hits) OVER w / nullif(sum(n) OVER w, 0), 6) AS rate FROM hb WINDOW w AS (PARTITION BY entity ORDER BY d_idx RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING)) r USING (entity, d_idx)) GROUP BY 1, 2""",
    HIST,
)


@query("flagship_asof_ranks", SQL)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = asof_rate(spark, sf_dir, 365, keep=("venue", "finish"))
    place = F.rank().over(Window.partitionBy("event").orderBy(F.desc_nulls_last("rate")))
    rows = rows.withColumn("rate_rank", F.least(place, F.lit(5)))
    wins = F.count_if(F.col("finish") == 1)
    return rows.groupBy("venue", "rate_rank").agg(F.count("*").alias("n"), wins.alias("wins"), F.round(wins / F.count("*"), 6).alias("win_rate"))


