"""Exact percentiles of groups of any size: distributed selection by counting, in memory that the data can't grow.

A group of at most `small` rows is one aggregation. Of a larger one the ranks asked for are looked for in its value
range, cut into `bins` equal cells: the cells' counts, least and largest values are summed (partly before the shuffle), the
cell that holds the rank becomes the new range, and so on until it holds `small` rows at most or a single value; then the
distinct values left are counted. A pass keeps `bins` cells for each open rank, whatever the group's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .baseline import written

#: Open groups that are sent to every task; more meet their rows by a join that skewed partitions are split in.
BROADCAST_GROUPS = 10_000


def largest_group(rows: DataFrame, by: Sequence[str], value: str) -> int:
    """Rows with a value of the largest group."""
    return rows.groupBy(*by).agg(F.count(value).alias("n")).agg(F.max("n")).first()[0] or 0


def _sent(groups: DataFrame) -> DataFrame:
    return F.broadcast(groups) if groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS else groups


def percentiles(rows: DataFrame, by: Sequence[str], value: str, q: float = 0.5, *, small: int = 100_000, bins: int = 4096, largest: int | None = None, times: str | None = None) -> DataFrame:
    """by, percentile double: linear between the two nearest ranks, as F.percentile has it. Nulls and NaN are left out;
    groups without values have no row; null keys are a group. largest: rows of the largest group, if known. times: how many values each row stands for, if not one."""
    keys = [f"k{i}" for i in range(len(by))]
    named = [F.col(k).alias(c) for k, c in zip(keys, by, strict=True)]
    v = rows.select(*[F.col(c).alias(k) for k, c in zip(keys, by, strict=True)], F.col(value).cast("double").alias("v"), (F.col(times).cast("long") if times else F.lit(1).cast("long")).alias("t")).filter("v IS NOT NULL AND NOT isnan(v)")
    if largest is None:
        largest = largest_group(v, keys, "v")
    direct = lambda df: df.groupBy(*keys).agg((F.percentile("v", q, F.col("t")) if times else F.percentile("v", q)).alias("percentile")).filter("percentile IS NOT NULL")
    if largest <= small:
        return direct(v).select(*named, "percentile")
    sizes = written(v.groupBy(*keys).agg(F.sum("t").alias("n"), F.count("*").alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi")), "sizes")
    large = sizes.filter(F.col("rows") > small)

    def with_groups(groups: DataFrame, how: str = "inner") -> DataFrame:
        """v joined null-safe with the groups' rows."""
        g = groups.select(*[F.col(k).alias(f"g_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
        g = _sent(g)
        on = F.lit(True)
        for k in keys:
            on = on & v[k].eqNullSafe(g[f"g_{k}"])
        return v.join(g, on, how).drop(*[f"g_{k}" for k in keys])

    place = (F.col("n") - 1) * q
    ranks = F.array_distinct(F.array(F.floor(place), F.ceil(place)))
    asks = written(large.select(*keys, F.explode(ranks).alias("rank"), "n", "rows", "lo", "hi").withColumn("skip", F.col("rank")), "asks")
    done: list[DataFrame] = []
    while True:
        closed = (F.col("rows") <= small) | (F.col("lo") == F.col("hi"))
        done.append(asks.filter(closed))
        asks = asks.filter(~closed)
        if not asks.limit(1).count():
            break
        near = with_groups(asks.drop("n", "rows")).filter("v BETWEEN lo AND hi")
        cell = F.least(F.lit(bins - 1).cast("long"), F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * bins))
        cells = near.groupBy(*keys, "rank", "skip", cell.alias("cell")).agg(F.sum("t").alias("n"), F.count("*").alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy(*keys, "rank").orderBy("cell"))
        found = cells.withColumn("upto", upto).filter((F.col("skip") < F.col("upto")) & (F.col("skip") >= F.col("upto") - F.col("n")))
        asks = written(found.select(*keys, "rank", "n", "rows", "lo", "hi", (F.col("skip") - (F.col("upto") - F.col("n"))).alias("skip")), "asks")
    closed = done[0]
    for more in done[1:]:
        closed = closed.unionByName(more)
    one = closed.filter("lo = hi").select(*keys, "rank", F.col("lo").alias("v"))
    last = with_groups(closed.filter("lo <> hi").drop("n", "rows")).filter("v BETWEEN lo AND hi")
    last = last.groupBy(*keys, "rank", "skip", "v").agg(F.sum("t").alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*keys, "rank").orderBy("v"))
    last = last.withColumn("upto", upto).filter((F.col("skip") < F.col("upto")) & (F.col("skip") >= F.col("upto") - F.col("c")))
    values = one.unionByName(last.select(*keys, "rank", "v"))
    both = values.groupBy(*keys).agg(F.min_by("v", "rank").alias("low"), F.max_by("v", "rank").alias("high"), F.min("rank").alias("first"), F.max("rank").alias("last"))
    g = large.select(*[F.col(k).alias(f"g_{k}") for k in keys], place.alias("place"))
    on = F.lit(True)
    for k in keys:
        on = on & both[k].eqNullSafe(g[f"g_{k}"])
    p = F.when(F.col("first") == F.col("last"), F.col("low")).otherwise((F.col("last") - F.col("place")) * F.col("low") + (F.col("place") - F.col("first")) * F.col("high"))
    big = both.join(g, on).select(*keys, p.alias("percentile"))
    return direct(with_groups(large.select(*keys), "left_anti")).unionByName(big).select(*named, "percentile")
