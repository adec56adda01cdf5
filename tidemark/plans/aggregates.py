"""Queries of the A family."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import stats
from .demo import order_history, participations, query, table, with_oh, with_pt
from .projections import payouts

REC = """count(*) AS n, count(*) FILTER (WHERE finish = 1) AS w1, count(*) FILTER (WHERE finish = 2) AS w2, count(*) FILTER (WHERE finish = 3) AS w3,
  round(100 * count(*) FILTER (WHERE finish <= 1) / count(*), 4) AS win_pct, round(100 * count(*) FILTER (WHERE finish <= 2) / count(*), 4) AS top2_pct,
  round(100 * count(*) FILTER (WHERE finish <= 3) / count(*), 4) AS top3_pct, floor(sum(CASE WHEN finish = 1 THEN round(price * 100)::BIGINT ELSE 0 END) / 100.0::DOUBLE / sum(measure) * 10000 + 0.500001) / 10000 AS roi,
  min(day) AS since, max(day) AS until"""
PERIODS = [("all", "1900-01-01", "2999-12-31"), ("1996", "1996-01-01", "1996-12-31"), ("1997", "1997-01-01", "1997-12-31"), ("last365", "1997-01-01", "1998-01-01")]
PERIOD_SQL = "pd(period, a, b) AS (VALUES " + ", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in PERIODS) + ")"


@query("A1_record", with_pt(f"SELECT venue, going, {REC} FROM pt GROUP BY 1, 2"))
def record(spark, d):
    return participations(spark, d).groupBy("venue", "going").agg(*stats.record())


@query("A2_minimum_sample", with_pt(f"SELECT rider, {REC} FROM pt GROUP BY 1 HAVING count(*) >= 30"))
def minimum_sample(spark, d):
    return participations(spark, d).groupBy("rider").agg(*stats.record()).filter("n >= 30")


@query("A3_periods", with_pt(f"SELECT venue, period, {REC} FROM pt JOIN pd ON day BETWEEN a AND b GROUP BY 1, 2", PERIOD_SQL))
def periods(spark, d):
    return stats.in_periods(participations(spark, d), PERIODS).groupBy("venue", "period").agg(*stats.record())


KINDS = {"entity": ["entity"], "rider": ["rider"], "owner": ["owner"], "sire": ["sire"]}


@query("A4_kinds", with_pt("".join((" UNION ALL " if i else "") + f"SELECT '{k}' AS kind, {c[0]}::VARCHAR AS k1, {REC} FROM pt GROUP BY 2" for i, (k, c) in enumerate(KINDS.items()))))
def kinds(spark, d):
    return stats.by_kinds(participations(spark, d), KINDS).groupBy("kind", "k1").agg(*stats.record())


@query("A5_pair_kinds", with_pt(f"SELECT rider::VARCHAR AS k1, venue::VARCHAR AS k2, period, {REC} FROM pt JOIN pd ON day BETWEEN a AND b GROUP BY 1, 2, 3", PERIOD_SQL))
def pair_kinds(spark, d):
    rows = stats.in_periods(stats.by_kinds(participations(spark, d), {"pair": ["rider", "venue"]}), PERIODS)
    return rows.groupBy("k1", "k2", "period").agg(*stats.record())


@query("A6_grouping_sets", with_pt("""SELECT coalesce(sire, '*') AS sire, CASE WHEN grouping(venue) = 1 THEN '*' ELSE venue::VARCHAR END AS venue, CASE WHEN grouping(going) = 1 THEN '*' ELSE going END AS going,
  count(*) AS n, round(avg(measure), 6) AS mean FROM pt GROUP BY GROUPING SETS ((sire, venue, going), (sire, venue), (sire, going), (sire))"""))
def grouping_sets(spark, d):
    participations(spark, d).createOrReplaceTempView("a6_participations")
    return spark.sql("""SELECT sire, if(grouping(venue) = 1, '*', string(venue)) AS venue, if(grouping(going) = 1, '*', going) AS going, count(*) AS n, round(avg(measure), 6) AS mean
      FROM a6_participations GROUP BY GROUPING SETS ((sire, venue, going), (sire, venue), (sire, going), (sire))""")


@query("A7_breakdown", with_pt("""SELECT venue, going AS part, n, wins, rank FROM (SELECT venue, going, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS wins,
  row_number() OVER (PARTITION BY venue ORDER BY count(*) DESC, going)::INT AS rank FROM pt GROUP BY 1, 2 HAVING count(*) >= 30)"""))
def breakdown(spark, d):
    nested = stats.breakdown(participations(spark, d), ["venue"], "going", 30, [F.count_if(F.col("finish") == 1).alias("wins")])
    flat = nested.select("venue", F.posexplode("parts").alias("k", "p"))
    return flat.select("venue", "p.part", "p.n", "p.wins", (F.col("k") + 1).alias("rank"))


@query("A8_ranked_block", with_pt("""SELECT venue, rider, wins, n, k FROM (SELECT *, row_number() OVER (PARTITION BY venue ORDER BY wins DESC, n, rider)::INT AS k
  FROM (SELECT venue, rider, count(*) FILTER (WHERE finish = 1) AS wins, count(*) AS n FROM pt GROUP BY 1, 2)) WHERE k <= 5"""))
def ranked_block(spark, d):
    g = participations(spark, d).groupBy("venue", "rider").agg(F.count_if(F.col("finish") == 1).alias("wins"), F.count("*").alias("n"))
    w = Window.partitionBy("venue").orderBy(F.desc("wins"), "n", "rider")
    return g.withColumn("k", F.row_number().over(w)).filter("k <= 5")


@query("A9_record_holder", with_pt("""SELECT venue, distance, price AS best, entity, day, going FROM (SELECT *, row_number() OVER (PARTITION BY venue, distance ORDER BY price, day, event, runner_no) AS k FROM pt) WHERE k = 1"""))
def record_holder(spark, d):
    best = F.min_by(F.struct(F.col("price").alias("best"), "entity", "day", "going"), F.struct("price", "day", "event", "runner_no"))
    return participations(spark, d).groupBy("venue", "distance").agg(best.alias("s")).select("venue", "distance", "s.*")


@query("A10_distinct_tuples", "SELECT o_orderstatus AS status, count(DISTINCT (o_custkey, o_orderpriority)) AS n FROM orders GROUP BY 1")
def distinct_tuples(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count_distinct("o_custkey", "o_orderpriority").alias("n"))


@query("A11_filtered", "SELECT l_returnflag AS flag, count(*) FILTER (WHERE l_quantity > 30) AS large, sum(l_quantity) FILTER (WHERE l_linestatus = 'O') AS open_total, bool_or(l_discount > 0.09) AS any_high FROM lineitem GROUP BY 1")
def filtered(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count_if(F.col("l_quantity") > 30).alias("large"), F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).alias("open_total"),
        F.bool_or(F.col("l_discount") > 0.09).alias("any_high"),
    )


@query("A12_quantiles", with_pt("SELECT venue, round(median(measure), 6) AS med, round(quantile_cont(price, 0.1), 4) AS p10, round(quantile_cont(price, 0.9), 4) AS p90 FROM pt GROUP BY 1"))
def quantiles(spark, d):
    q = lambda c, p, n: F.round(F.percentile(c, p), n)
    return participations(spark, d).groupBy("venue").agg(q("measure", 0.5, 6).alias("med"), q("price", 0.1, 4).alias("p10"), q("price", 0.9, 4).alias("p90"))


@query("A13_mode", with_oh("SELECT entity, priority, n FROM (SELECT entity, priority, count(*) AS n, row_number() OVER (PARTITION BY entity ORDER BY count(*) DESC, priority) AS k FROM oh GROUP BY 1, 2) WHERE k = 1"))
def mode(spark, d):
    g = order_history(spark, d).groupBy("entity", "priority").agg(F.count("*").alias("n"))
    return g.groupBy("entity").agg(F.min_by(F.struct("priority", "n"), F.struct((-F.col("n")).alias("m"), "priority")).alias("s")).select("entity", "s.*")


@query("A14_moments", with_pt("SELECT entity, count(*) AS n, round(avg(measure), 4) AS mean, round(var_pop(measure), 4) AS var FROM pt GROUP BY 1"))
def moments(spark, d):
    monthly = participations(spark, d).groupBy("entity", F.trunc("day", "month").alias("m")).agg(F.count("*").alias("n"), F.sum("measure").alias("s"), F.sum(F.col("measure") * F.col("measure")).alias("s2"))
    total = monthly.groupBy("entity").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("s2").alias("s2"))
    mean = F.col("s") / F.col("n")
    return total.select("entity", "n", F.round(mean, 4).alias("mean"), F.round(F.greatest(F.col("s2") / F.col("n") - mean * mean, F.lit(0.0)), 4).alias("var"))


@query("A15_correlation", with_pt("SELECT venue, count(*) AS n, round(corr(price, measure), 4) AS r FROM pt WHERE going <> 'N' GROUP BY 1 HAVING count(*) >= 5"))
def correlation(spark, d):
    x, y = F.col("price") / 1000, F.col("measure")
    parts = participations(spark, d).filter("going <> 'N'").groupBy("venue", "d_idx").agg(
        F.count("*").alias("n"), F.sum(x).alias("x"), F.sum(y).alias("y"), F.sum(x * x).alias("xx"), F.sum(y * y).alias("yy"), F.sum(x * y).alias("xy")
    )
    t = parts.groupBy("venue").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")]).filter("n >= 5")
    cov = F.col("n") * F.col("xy") - F.col("x") * F.col("y")
    dev = lambda a: F.col("n") * F.col(a * 2) - F.col(a) * F.col(a)
    return t.select("venue", "n", F.round(F.try_divide(cov, F.sqrt(dev("x") * dev("y"))), 4).alias("r"))


#: Rows of a partition, about, where a task sorts it more than once.
SORTED_ROWS = 500_000


def partitions(spark, t) -> int:
    """Shuffle partitions for as many rows as t has: as the session has them, or more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-t.count() // SORTED_ROWS))


@query("A16_spearman", with_pt("""SELECT event, round(corr(a, b), 6) AS rho FROM (SELECT event, rank() OVER (PARTITION BY event ORDER BY measure) + (count(*) OVER (PARTITION BY event, measure) - 1) / 2.0 AS a,
  rank() OVER (PARTITION BY event ORDER BY price) + (count(*) OVER (PARTITION BY event, price) - 1) / 2.0 AS b FROM pt) GROUP BY 1 HAVING count(*) >= 4 AND stddev_pop(a) > 0 AND stddev_pop(b) > 0"""))
def spearman(spark, d):
    rows = participations(spark, d).select("event", "measure", "price")
    # Four sorts of a partition are in one task: partitions follow the rows.
    r = rows.repartition(partitions(spark, table(spark, d, "lineitem")), "event").select("event", stats.average_rank(F.col("measure"), ["event"]).alias("a"), stats.average_rank(F.col("price"), ["event"]).alias("b"))
    m = r.groupBy("event").agg(F.count("*").alias("n"), *[F.sum(e).alias(k) for k, e in {"a": F.col("a"), "b": F.col("b"), "aa": F.col("a") * F.col("a"), "bb": F.col("b") * F.col("b"), "ab": F.col("a") * F.col("b")}.items()])
    dev = lambda k: F.col("n") * F.col(k * 2) - F.col(k) * F.col(k)
    rho = F.try_divide(F.col("n") * F.col("ab") - F.col("a") * F.col("b"), F.sqrt(dev("a") * dev("b")))
    return m.filter("n >= 4").select("event", F.round(rho, 6).alias("rho")).filter("rho IS NOT NULL")


@query("A17_median_of_medians", with_pt("""SELECT venue, day, round(median(m), 4) AS value, count(*) AS events FROM (SELECT venue, day, event, median(price / distance * 1000) AS m FROM pt GROUP BY 1, 2, 3 HAVING count(*) >= 3) GROUP BY 1, 2 HAVING count(*) >= 2"""))
def median_of_medians(spark, d):
    per = participations(spark, d).groupBy("venue", "day", "event").agg(F.percentile(F.col("price") / F.col("distance") * 1000, 0.5).alias("m"), F.count("*").alias("n")).filter("n >= 3")
    return per.groupBy("venue", "day").agg(F.round(F.percentile("m", 0.5), 4).alias("value"), F.count("*").alias("events")).filter("events >= 2")


@query("A18_fill_rates", """WITH j AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, l_shipdate, nullif(l_returnflag, 'N') AS flag, l_orderkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)
  SELECT month, 'ship' AS col, count(*) AS n, round(count(l_shipdate) / count(*), 6) AS rate, NULL::DOUBLE AS among FROM j GROUP BY 1
  UNION ALL SELECT month, 'flag', count(*), round(count(flag) / count(*), 6), round(count(flag) / nullif(count(l_orderkey), 0), 6) FROM j GROUP BY 1""")
def fill_rates(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    g = j.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("n"), F.count("l_orderkey").alias("m"), F.count("l_shipdate").alias("ship"), F.count(F.nullif(F.col("l_returnflag"), F.lit("N"))).alias("flag"))
    item = lambda c, among: F.struct(F.lit(c).alias("col"), F.round(F.col(c) / F.col("n"), 6).alias("rate"), among.alias("among"))
    both = F.array(item("ship", F.lit(None).cast("double")), item("flag", F.round(F.try_divide(F.col("flag"), F.col("m")), 6)))
    return g.select("month", "n", F.inline(both))


@query("A19_calendar_coverage", """WITH h AS (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT min(day) AS first, max(day) AS last FROM h),
  e AS (SELECT unnest(generate_series((SELECT first FROM b), (SELECT last FROM b), INTERVAL 1 DAY))::DATE AS day)
  SELECT year(e.day)::INT AS year, count(*) AS expected, count(h.day) AS held, ((SELECT last FROM b) - max(h.day))::INT AS lag_days FROM e LEFT JOIN h USING (day) GROUP BY 1""")
def calendar_coverage(spark, d):
    """Days held of all days from the first to the last one that the table has, by year, and how far the year's last is back."""
    held = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    ends = held.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    expected = ends.select("last", F.explode(F.sequence("first", "last")).alias("day"))
    j = expected.join(held, "day", "left").withColumn("held_day", F.when(F.col("n").isNotNull(), F.col("day")))
    return j.groupBy(F.year("day").alias("year")).agg(
        F.count("*").alias("expected"), F.count("held_day").alias("held"), F.datediff(F.max("last"), F.max("held_day")).alias("lag_days")
    )


@query("A20_top_by_kind", with_pt("SELECT kind, k, event, y FROM (SELECT CASE WHEN finish = 1 THEN 'win' ELSE 'place' END AS kind, event, round(price) AS y, row_number() OVER (PARTITION BY finish = 1 ORDER BY round(price) DESC, event, runner_no)::INT AS k FROM pt WHERE finish <= 3 AND day BETWEEN DATE '1996-01-01' AND DATE '1996-12-31') WHERE k <= 10"))
def top_by_kind(spark, d):
    p = participations(spark, d).filter(F.col("day").between("1996-01-01", "1996-12-31")).select("event").distinct()
    items = payouts(spark, d).join(p, "event", "left_semi").select("event", F.inline("items"))
    w = Window.partitionBy("t").orderBy(F.desc("y"), "event", "c")
    top = items.withColumn("k", F.row_number().over(w)).filter("k <= 10")
    nested = top.groupBy("t").agg(F.sort_array(F.collect_list(F.struct("k", "event", "y"))).alias("rows"))
    return nested.select(F.col("t").alias("kind"), F.inline("rows"))


@query("A21_top_with_ties", with_pt("SELECT venue, sire, n, place FROM (SELECT *, rank() OVER (PARTITION BY venue ORDER BY n DESC)::INT AS place, row_number() OVER (PARTITION BY venue ORDER BY n DESC, sire) AS r FROM (SELECT venue, sire, count(*) // 10 AS n FROM pt GROUP BY 1, 2)) WHERE place <= 3 AND r <= 6"))
def top_with_ties(spark, d):
    g = participations(spark, d).groupBy("venue", "sire").agg(F.floor(F.count("*") / 10).alias("n"))
    return stats.top_with_ties(g, ["venue"], "n", 3, 6, ["sire"])


@query("A22_cumulative_series", with_pt("""SELECT sire, m.month, coalesce(sum(w) OVER (PARTITION BY sire ORDER BY m.month), 0)::BIGINT AS wins FROM (SELECT DISTINCT sire FROM pt) s CROSS JOIN (SELECT DISTINCT date_trunc('month', day)::DATE AS month FROM pt) m
  LEFT JOIN (SELECT sire, date_trunc('month', day)::DATE AS month, count(*) FILTER (WHERE finish = 1) AS w FROM pt GROUP BY 1, 2) c USING (sire, month)"""))
def cumulative_series(spark, d):
    p = participations(spark, d).withColumn("month", F.trunc("day", "month"))
    span = p.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    axis = span.select(F.sequence("a", "b", F.expr("interval 1 month")).alias("months"))
    wins = p.groupBy("sire", "month").agg(F.count_if(F.col("finish") == 1).alias("w"))
    dense = wins.groupBy("sire").agg(F.map_from_entries(F.collect_list(F.struct("month", "w"))).alias("m")).crossJoin(F.broadcast(axis))
    flat = dense.select("sire", F.explode("months").alias("month"), "m").withColumn("w", F.coalesce(F.try_element_at("m", "month"), F.lit(0)))
    return flat.select("sire", "month", F.sum("w").over(Window.partitionBy("sire").orderBy("month")).alias("wins"))


@query("A23_lift", with_pt("SELECT c.venue, c.going, c.n, c.hits, CASE WHEN c.n >= 20 THEN round((c.hits / c.n) / (b.hits / b.n), 4) END AS lift FROM (SELECT venue, going, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS hits FROM pt GROUP BY 1, 2) c JOIN (SELECT venue, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS hits FROM pt GROUP BY 1) b USING (venue)"))
def lift(spark, d):
    return stats.lift(participations(spark, d), ["venue", "going"], ["venue"], F.col("finish") == 1)


@query("A24_count_dimension", with_pt("SELECT k, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS wins FROM (SELECT finish, least(3, count(*) FILTER (WHERE going = 'R') OVER (PARTITION BY event)) AS k FROM pt) GROUP BY 1"))
def count_dimension(spark, d):
    k = F.least(F.lit(3).cast("long"), F.count_if(F.col("going") == "R").over(Window.partitionBy("event")))
    return participations(spark, d).withColumn("k", k).groupBy("k").agg(F.count("*").alias("n"), F.count_if(F.col("finish") == 1).alias("wins"))


@query("A25_shrunk", with_pt("SELECT rider, n, round((hits + 20 * p) / (n + 20), 6) AS rate, round(ln((hits + 5.0) / (n * p + 5.0)), 6) AS log_ratio FROM (SELECT rider, count(*) AS n, count(*) FILTER (WHERE finish <= 3) AS hits FROM pt GROUP BY 1), (SELECT count(*) FILTER (WHERE finish <= 3) / count(*) AS p FROM pt)"))
def shrunk(spark, d):
    g = participations(spark, d).groupBy("rider").agg(F.count("*").alias("n"), F.count_if(F.col("finish") <= 3).alias("hits"))
    total = g.agg((F.sum("hits") / F.sum("n")).alias("p"))
    g = g.crossJoin(F.broadcast(total))  # one row
    ratio = F.log((F.col("hits") + 5.0) / (F.col("n") * F.col("p") + 5.0))
    return g.select("rider", "n", F.round(stats.shrunk(F.col("hits"), F.col("n"), F.col("p"), 20), 6).alias("rate"), F.round(ratio, 6).alias("log_ratio"))


@query("A26_leave_one_out", with_pt("SELECT event, runner_no, round((sum(measure) OVER (PARTITION BY event) - measure) / nullif(count(*) OVER (PARTITION BY event) - 1, 0), 6) AS others, round((sum(measure) OVER (PARTITION BY sire) - sum(measure) OVER (PARTITION BY sire, entity)) / nullif(count(*) OVER (PARTITION BY sire) - count(*) OVER (PARTITION BY sire, entity), 0), 6) AS siblings FROM pt"))
def leave_one_out(spark, d):
    p = participations(spark, d)
    s = lambda *k: F.sum("measure").over(Window.partitionBy(*k))
    n = lambda *k: F.count("*").over(Window.partitionBy(*k))
    own = p.groupBy("sire", "entity").agg(F.sum("measure").alias("s"), F.count("*").alias("n"))
    group = own.groupBy("sire").agg(F.sum("s").alias("gs"), F.sum("n").alias("gn"))
    others = own.join(group, "sire").select("sire", "entity", F.round(F.try_divide(F.col("gs") - F.col("s"), F.col("gn") - F.col("n")), 6).alias("siblings"))
    rows = p.withColumn("others", F.round(F.try_divide(s("event") - F.col("measure"), n("event") - 1), 6))
    return rows.join(others, ["sire", "entity"]).select("event", "runner_no", "others", "siblings")


def implied(p):
    """D-PROB: probability by inverse odds, normalised within the event, and the outcome."""
    q = 1 / (F.col("discount") + 0.05)
    return p.select("event", "runner_no", "entity", "day", "venue", "finish", "price", "discount", (q / F.sum(q).over(Window.partitionBy("event"))).alias("p"), (F.col("finish") == 1).alias("won"))


PB = "pb AS (SELECT event, runner_no, entity, day, venue, finish, price, discount, (1 / (discount + 0.05)) / sum(1 / (discount + 0.05)) OVER (PARTITION BY event) AS p, finish = 1 AS won FROM pt)"


@query("A27_observed_expected", with_pt("SELECT CASE WHEN p < 0.1 THEN 'a' WHEN p < 0.25 THEN 'b' WHEN p < 0.5 THEN 'c' ELSE 'd' END AS band, count(*) AS n, count(*) FILTER (WHERE won) AS win, round(sum(p), 4) AS expected, round(count(*) FILTER (WHERE won) / sum(p), 4) AS ratio, count(DISTINCT event) AS events FROM (SELECT * REPLACE (round(p, 9) AS p) FROM pb) GROUP BY 1", PB))
def observed_expected(spark, d):
    from ..functions.exprs import band

    rows = implied(participations(spark, d)).withColumn("p", F.round("p", 9))
    return rows.groupBy(band(F.col("p"), [0.1, 0.25, 0.5], ["a", "b", "c", "d"]).alias("band")).agg(
        F.count("*").alias("n"), F.count_if("won").alias("win"), F.round(F.sum("p"), 4).alias("expected"),
        F.round(F.count_if("won") / F.sum("p"), 4).alias("ratio"), F.count_distinct("event").alias("events"),
    )


@query("A28_partials", with_pt("SELECT rider, count(*) AS n, sum(measure) AS total FROM pt GROUP BY 1"))
def partials(spark, d):
    monthly = participations(spark, d).groupBy("rider", F.trunc("day", "month").alias("m")).agg(F.count("*").alias("n"), F.sum("measure").alias("total"))
    return monthly.groupBy("rider").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


@query("A29_recent_children", with_oh("SELECT entity, n, string_agg(event, ',' ORDER BY k) AS recent FROM (SELECT *, count(*) OVER (PARTITION BY entity) AS n, row_number() OVER (PARTITION BY entity ORDER BY d_idx DESC, event DESC) AS k FROM oh) WHERE k <= 5 GROUP BY 1, 2"))
def recent_children(spark, d):
    w = Window.partitionBy("entity").orderBy(F.desc("d_idx"), F.desc("event"))
    rows = order_history(spark, d).withColumn("k", F.row_number().over(w))
    g = rows.groupBy("entity").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.when(F.col("k") <= 5, F.struct("k", "event")))).alias("s"))
    return g.select("entity", "n", F.array_join(F.col("s.event").cast("array<string>"), ",").alias("recent"))


@query("A30_milestones", with_oh("SELECT entity, max(CASE WHEN k = 5 THEN day END) AS fifth, min(CASE WHEN day >= DATE '1998-01-01' THEN day END) AS next, max(CASE WHEN day < DATE '1998-01-01' THEN day END) AS previous FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY d_idx, event) AS k FROM oh) GROUP BY 1"))
def milestones(spark, d):
    w = Window.partitionBy("entity").orderBy("d_idx", "event")
    ref = F.lit("1998-01-01").cast("date")
    rows = order_history(spark, d).withColumn("k", F.row_number().over(w))
    return rows.groupBy("entity").agg(
        F.max(F.when(F.col("k") == 5, F.col("day"))).alias("fifth"), F.min(F.when(F.col("day") >= ref, F.col("day"))).alias("next"),
        F.max(F.when(F.col("day") < ref, F.col("day"))).alias("previous"),
    )


@query("A31_band_facts", with_pt("SELECT day, count(*) AS n, count(*) FILTER (WHERE d_idx - pd > 180) AS layoff, count(*) FILTER (WHERE venue <> pv) AS moved, count(*) FILTER (WHERE abs(distance - pdist) >= 100) AS stretched FROM (SELECT *, lag(d_idx) OVER w AS pd, lag(venue) OVER w AS pv, lag(distance) OVER w AS pdist FROM pt WINDOW w AS (PARTITION BY rider ORDER BY d_idx, event, runner_no)) GROUP BY 1"))
def band_facts(spark, d):
    w = Window.partitionBy("rider").orderBy("d_idx", "event", "runner_no")
    p = participations(spark, d)
    rows = p.select("day", "d_idx", "venue", "distance", *[F.lag(c).over(w).alias(f"p_{c}") for c in ("d_idx", "venue", "distance")])
    return rows.groupBy("day").agg(
        F.count("*").alias("n"), F.count_if(F.col("d_idx") - F.col("p_d_idx") > 180).alias("layoff"), F.count_if(F.col("venue") != F.col("p_venue")).alias("moved"),
        F.count_if(F.abs(F.col("distance") - F.col("p_distance")) >= 100).alias("stretched"),
    )


SPANS_SQL = "[{'span': 'day', 'period': day}, {'span': 'week', 'period': date_trunc('week', day)::DATE}, {'span': 'month', 'period': date_trunc('month', day)::DATE}]"


@query("A32_pick_records", with_pt(f"""SELECT mark, band, s.span AS span, s.period AS period, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS wins, count(*) FILTER (WHERE finish <= 3) AS placed, floor(sum(CASE WHEN finish = 1 THEN round(price * 100)::BIGINT ELSE 0 END) / 100.0::DOUBLE / count(*) * 10000 + 0.500001) / 10000 AS roi, count(DISTINCT venue) AS venues
  FROM (SELECT popularity::BIGINT AS mark, CASE WHEN discount < 0.03 THEN 'long' WHEN discount < 0.07 THEN 'mid' ELSE 'short' END AS band, finish, price, venue, unnest({SPANS_SQL}) AS s FROM pt WHERE popularity <= 4) GROUP BY 1, 2, 3, 4
UNION ALL SELECT 0, 'exacta', s.span, s.period, count(*), count(*) FILTER (WHERE a = 1 AND b = 2), count(*) FILTER (WHERE a <= 3 AND b <= 3), NULL, count(DISTINCT venue)
  FROM (SELECT *, unnest({SPANS_SQL}) AS s FROM (SELECT event, day, venue, max(CASE WHEN popularity = 1 THEN finish END) AS a, max(CASE WHEN popularity = 2 THEN finish END) AS b FROM pt GROUP BY 1, 2, 3)) WHERE b IS NOT NULL GROUP BY 3, 4"""))
def pick_records(spark, d):
    """Records of the four picks by mark, odds band and day, week and month, and of the first two as an ordered pair."""
    from ..functions.exprs import band

    p = participations(spark, d)
    spans = [F.struct(F.lit("day").alias("span"), F.col("day").alias("period")), *[F.struct(F.lit(s).alias("span"), F.trunc("day", s).alias("period")) for s in ("week", "month")]]
    picks = p.filter("popularity <= 4").select(
        F.col("popularity").cast("long").alias("mark"), band(F.col("discount"), [0.03, 0.07], ["long", "mid", "short"]).alias("band"), "finish", "price", "venue", F.inline(F.array(*spans))
    )
    one = picks.groupBy("mark", "band", "span", "period").agg(
        F.count("*").alias("n"), F.count_if(F.col("finish") == 1).alias("wins"), F.count_if(F.col("finish") <= 3).alias("placed"),
        stats.half_up(F.sum(F.when(F.col("finish") == 1, F.round(F.col("price") * 100).cast("long")).otherwise(0)) / 100 / F.count("*")).alias("roi"), F.count_distinct("venue").alias("venues"),
    )
    pick = lambda k: F.max(F.when(F.col("popularity") == k, F.col("finish")))
    pairs = p.groupBy("event", "day", "venue").agg(pick(1).alias("a"), pick(2).alias("b")).filter("b IS NOT NULL").select("a", "b", "venue", F.inline(F.array(*spans)))
    two = pairs.groupBy("span", "period").agg(
        F.count("*").alias("n"), F.count_if((F.col("a") == 1) & (F.col("b") == 2)).alias("wins"),
        F.count_if((F.col("a") <= 3) & (F.col("b") <= 3)).alias("placed"), F.count_distinct("venue").alias("venues"),
    )
    two = two.select(F.lit(0).cast("long").alias("mark"), F.lit("exacta").alias("band"), "span", "period", "n", "wins", "placed", F.lit(None).cast("double").alias("roi"), "venues")
    return one.unionByName(two)


@query("A33_transitions", with_oh("SELECT k, count(*) AS n, count(*) FILTER (WHERE now) AS hits, round(count(*) FILTER (WHERE now) / count(*), 6) AS rate FROM (SELECT grade = 1 AS now, least(3, sum((grade = 1)::INT) OVER w)::BIGINT AS k, count(*) OVER w AS held FROM oh WINDOW w AS (PARTITION BY entity ORDER BY d_idx, event ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) WHERE held = 5 GROUP BY 1"))
def transitions(spark, d):
    w = Window.partitionBy("entity").orderBy("d_idx", "event").rowsBetween(-5, -1)
    now = F.col("grade") == 1
    rows = order_history(spark, d).select(now.alias("now"), F.least(F.lit(3).cast("long"), F.count_if(now).over(w)).alias("k"), F.count("*").over(w).alias("held"))
    return rows.filter("held = 5").groupBy("k").agg(F.count("*").alias("n"), F.count_if("now").alias("hits"), F.round(F.count_if("now") / F.count("*"), 6).alias("rate"))
