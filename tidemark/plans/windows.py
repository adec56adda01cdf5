"""Queries of the W family: as-of windows, sequences, changes, states and balances."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import exprs as x
from ..operators import asof, stats
from ..operators.rolling import rolling as moving
from ..sources.io import written
from .demo import OH, hu, order_history, participations, query, table, with_oh, with_pt

HIST = "hb AS (SELECT entity, d_idx, count(*) AS n, count(*) FILTER (WHERE finish <= 3) AS hits, count(*) FILTER (WHERE finish = 1) AS wins, sum(measure) AS m, sum(measure * measure) AS m2 FROM pt GROUP BY 1, 2)"


def history(p, *more, key="entity"):
    """D-HIST: day buckets of a key's participations."""
    sums = {"n": F.lit(1), "hits": (F.col("finish") <= 3).cast("int"), "wins": (F.col("finish") == 1).cast("int"), "m": F.col("measure"), "m2": F.col("measure") * F.col("measure")}
    return asof.day_buckets(p, [key, *more], "d_idx", sums)


def before(days):
    return "UNBOUNDED PRECEDING" if days is None else f"{days} PRECEDING"


def _w1(days):
    return with_pt(f"SELECT p.event, p.runner_no, coalesce(b.nb, 0)::BIGINT AS n, round(b.hb / nullif(b.nb, 0), 6) AS rate FROM pt p JOIN (SELECT entity, d_idx, sum(n) OVER w AS nb, sum(hits) OVER w AS hb FROM hb WINDOW w AS (PARTITION BY entity ORDER BY d_idx RANGE BETWEEN {before(days)} AND 1 PRECEDING)) b USING (entity, d_idx)", HIST)


def asof_rate(spark, d, days, form="frame", keep=()):
    """Hit rate of each participation's entity over the days before, with the columns `keep` of the participation."""
    p = participations(spark, d)
    w = asof.window_sums(history(p), ["entity"], "d_idx", ["n", "hits"], days, form)
    out = p.select("event", "runner_no", "entity", "d_idx", *keep).join(w.select("entity", "d_idx", "n_before", "hits_before"), ["entity", "d_idx"])
    return out.select("event", "runner_no", *keep, F.coalesce("n_before", F.lit(0)).cast("long").alias("n"), asof.rate(F.col("hits_before"), F.col("n_before")).alias("rate"))


for _days in (30, 90, 365, 1095, None):
    query(f"W1_asof_rate_{_days or 'all'}", _w1(_days))(lambda s, d, days=_days: asof_rate(s, d, days))
query("W21_prefix_rate_365", _w1(365))(lambda s, d: asof_rate(s, d, 365, "prefix"))


@query("W2_partitions", with_pt("SELECT event, runner_no, round(ob / nullif(onn, 0), 6) AS overall, round(vb / nullif(vn, 0), 6) AS venue_rate, round(gb / nullif(gn, 0), 6) AS going_rate FROM (SELECT event, runner_no, count(*) OVER o AS onn, count(*) FILTER (WHERE finish <= 3) OVER o AS ob, count(*) OVER v AS vn, count(*) FILTER (WHERE finish <= 3) OVER v AS vb, count(*) OVER g AS gn, count(*) FILTER (WHERE finish <= 3) OVER g AS gb FROM pt WINDOW o AS (PARTITION BY rider ORDER BY d_idx RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), v AS (PARTITION BY rider, venue ORDER BY d_idx RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), g AS (PARTITION BY rider, going ORDER BY d_idx RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"))
def partitions(spark, d):
    p = participations(spark, d)
    hit = F.count_if(F.col("finish") <= 3)
    rate = lambda *k: asof.rate(hit.over(_past(*k)), F.count("*").over(_past(*k)))
    return p.select("event", "runner_no", rate("rider").alias("overall"), rate("rider", "venue").alias("venue_rate"), rate("rider", "going").alias("going_rate"))


def _past(*keys, days=None):
    start = Window.unboundedPreceding if days is None else -days
    return Window.partitionBy(*keys).orderBy("d_idx").rangeBetween(start, -1)


def _seq():
    return Window.partitionBy("entity").orderBy("d_idx", "event")


SEQ_SQL = "WINDOW w AS (PARTITION BY entity ORDER BY d_idx, event)"


@query("W3_last_rows", with_oh(f"SELECT event, {', '.join(f'lag(price, {i}) OVER w AS p{i}' for i in range(1, 6))} FROM oh {SEQ_SQL}"))
def last_rows(spark, d):
    return order_history(spark, d).select("event", *[F.lag("price", i).over(_seq()).alias(f"p{i}") for i in range(1, 6)])


@query("W4_previous_day", with_oh("SELECT o.event, p.total AS previous_total, (o.d_idx - p.d_idx)::INT AS gap FROM oh o ASOF LEFT JOIN (SELECT entity, d_idx, round(sum(price), 2) AS total FROM oh GROUP BY 1, 2) p ON o.entity = p.entity AND o.d_idx > p.d_idx"))
def previous_day(spark, d):
    o = order_history(spark, d)
    days = o.groupBy("entity", F.col("d_idx").alias("at")).agg(F.round(F.sum("price"), 2).alias("previous_total"))
    out = asof.asof_join(o.select("entity", "event", "d_idx"), days, by=["entity"], left_on="d_idx", right_on="at", take=["previous_total", "at"])
    return out.select("event", "previous_total", (F.col("d_idx") - F.col("at")).alias("gap"))


@query("W5_z_scores", with_pt(f"SELECT event, runner_no, {hu('(measure - mean) / nullif(sd, 0)')} AS z, {hu('measure - mean')} AS residual FROM (SELECT p.*, s.mean, s.sd FROM pt p JOIN (SELECT venue, going, d_idx, sum(m) OVER w / sum(n) OVER w AS mean, sqrt(greatest(sum(m2) OVER w / sum(n) OVER w - (sum(m) OVER w / sum(n) OVER w) ** 2, 0)) AS sd FROM (SELECT venue, going, d_idx, count(*) AS n, sum(measure) AS m, sum(measure * measure) AS m2 FROM pt GROUP BY 1, 2, 3) WINDOW w AS (PARTITION BY venue, going ORDER BY d_idx RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING)) s USING (venue, going, d_idx))"))
def z_scores(spark, d):
    p = participations(spark, d)
    w = asof.window_sums(history(p, "going", key="venue"), ["venue", "going"], "d_idx", ["n", "m", "m2"], 365)
    mean = F.col("m_before") / F.col("n_before")
    w = w.select("venue", "going", "d_idx", mean.alias("mean"), F.sqrt(F.greatest(F.col("m2_before") / F.col("n_before") - mean * mean, F.lit(0.0))).alias("sd"))
    gap = F.col("measure") - F.col("mean")
    rows = p.select("event", "runner_no", "venue", "going", "d_idx", "measure").join(w, ["venue", "going", "d_idx"])
    return rows.select("event", "runner_no", stats.half_up(F.try_divide(gap, F.col("sd"))).alias("z"), stats.half_up(gap).alias("residual"))


DAYBIAS = "wb AS (SELECT p.venue, p.d_idx, median(p.price - s.mean) AS bias FROM pt p JOIN (SELECT venue, d_idx, sum(m) OVER w / sum(n) OVER w AS mean FROM (SELECT venue, d_idx, count(*) AS n, sum(price) AS m FROM pt WHERE finish = 1 GROUP BY 1, 2) WINDOW w AS (PARTITION BY venue ORDER BY d_idx RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING)) s USING (venue, d_idx) WHERE p.finish = 1 AND s.mean IS NOT NULL GROUP BY 1, 2)"


def day_bias(p):
    """Median over a venue's day of winners' value minus the mean of the 365 days before."""
    win = p.filter("finish = 1")
    days = asof.day_buckets(win, ["venue"], "d_idx", {"n": F.lit(1), "m": F.col("price")})
    mean = asof.window_sums(days, ["venue"], "d_idx", ["n", "m"], 365).select("venue", "d_idx", (F.col("m_before") / F.col("n_before")).alias("mean"))
    rows = win.join(mean, ["venue", "d_idx"]).filter("mean IS NOT NULL")
    return rows.groupBy("venue", "d_idx").agg(F.percentile(F.col("price") - F.col("mean"), 0.5).alias("bias"))


@query("W6_day_bias", with_pt(f"SELECT venue, d_idx, {hu('bias')} AS bias, {hu('avg(bias) OVER (PARTITION BY venue ORDER BY d_idx RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING)')} AS mean30, {hu('lag(bias) OVER (PARTITION BY venue ORDER BY d_idx)')} AS previous FROM wb", DAYBIAS))
def w6(spark, d):
    b = day_bias(participations(spark, d))
    prev = F.lag("bias").over(Window.partitionBy("venue").orderBy("d_idx"))
    return b.select("venue", "d_idx", stats.half_up(F.col("bias")).alias("bias"), stats.half_up(F.avg("bias").over(_past("venue", days=30))).alias("mean30"), stats.half_up(prev).alias("previous"))


@query("W7_rolling_correlation", with_pt("SELECT venue, d_idx, n, CASE WHEN n >= 10 THEN round((n * xy - x * y) / nullif(sqrt(greatest((n * xx - x * x) * (n * yy - y * y), 0)), 0), 4) END AS r FROM (SELECT venue, d_idx, sum(n) OVER w AS n, sum(x) OVER w AS x, sum(y) OVER w AS y, sum(xx) OVER w AS xx, sum(yy) OVER w AS yy, sum(xy) OVER w AS xy FROM (SELECT venue, d_idx, count(*)::DOUBLE AS n, sum(finish)::DOUBLE AS x, sum(measure) AS y, sum(finish * finish)::DOUBLE AS xx, sum(measure * measure) AS yy, sum(finish * measure) AS xy FROM pt GROUP BY 1, 2) WINDOW w AS (PARTITION BY venue ORDER BY d_idx RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING)) WHERE n IS NOT NULL"))
def rolling_correlation(spark, d):
    a, b = F.col("finish").cast("double"), F.col("measure")
    days = asof.day_buckets(participations(spark, d), ["venue"], "d_idx", {"n": F.lit(1.0), "x": a, "y": b, "xx": a * a, "yy": b * b, "xy": a * b})
    w = asof.window_sums(days, ["venue"], "d_idx", ["n", "x", "y", "xx", "yy", "xy"], 365)
    s = {k: F.col(f"{k}_before") for k in ("n", "x", "y", "xx", "yy", "xy")}
    under = F.greatest((s["n"] * s["xx"] - s["x"] * s["x"]) * (s["n"] * s["yy"] - s["y"] * s["y"]), F.lit(0.0))
    r = F.try_divide(s["n"] * s["xy"] - s["x"] * s["y"], F.sqrt(under))
    return w.filter("n_before IS NOT NULL").select("venue", "d_idx", s["n"].alias("n"), F.when(s["n"] >= 10, F.round(r, 4)).alias("r"))


@query("W8_in_event_ranks", with_pt("SELECT event, runner_no, CASE WHEN v IS NOT NULL THEN round(percent_rank() OVER (PARTITION BY event ORDER BY v NULLS LAST), 6) END AS pct, CASE WHEN v IS NOT NULL THEN rank() OVER (PARTITION BY event ORDER BY v DESC NULLS LAST) END::INT AS place, count(v) OVER (PARTITION BY event) AS known FROM (SELECT event, runner_no, CASE WHEN going <> 'A' THEN measure END AS v FROM pt)"))
def in_event_ranks(spark, d):
    p = participations(spark, d).select("event", "runner_no", F.when(F.col("going") != "A", F.col("measure")).alias("v"))
    e = Window.partitionBy("event")
    known = F.col("v").isNotNull()
    pct, place = F.percent_rank().over(e.orderBy(F.asc_nulls_last("v"))), F.rank().over(e.orderBy(F.desc_nulls_last("v")))
    return p.select("event", "runner_no", F.when(known, F.round(pct, 6)).alias("pct"), F.when(known, place).alias("place"), F.count("v").over(e).alias("known"))


@query("W9_relative", with_pt("SELECT event, runner_no, round(measure - avg(measure) OVER e, 6) AS over_mean, round((measure - avg(measure) OVER e) / greatest(stddev_pop(measure) OVER e, 1.0), 6) AS z, max(measure) OVER e - measure AS to_max, round(avg(CASE WHEN k <= 5 THEN measure END) OVER e, 6) AS top5 FROM (SELECT *, row_number() OVER (PARTITION BY event ORDER BY measure DESC, runner_no) AS k FROM pt) WINDOW e AS (PARTITION BY event)"))
def relative(spark, d):
    e = Window.partitionBy("event")
    p = participations(spark, d).withColumn("k", F.row_number().over(e.orderBy(F.desc("measure"), "runner_no")))
    gap = F.col("measure") - F.avg("measure").over(e)
    return p.select("event", "runner_no", F.round(gap, 6).alias("over_mean"), F.round(gap / F.greatest(F.stddev_pop("measure").over(e), F.lit(1.0)), 6).alias("z"),
                    (F.max("measure").over(e) - F.col("measure")).alias("to_max"), F.round(F.avg(F.when(F.col("k") <= 5, F.col("measure"))).over(e), 6).alias("top5"))


@query("W10_islands", with_oh("SELECT event, b42, b180, row_number() OVER (PARTITION BY entity, b42 ORDER BY d_idx, event)::INT AS since42, row_number() OVER (PARTITION BY entity, b180 ORDER BY d_idx, event)::INT AS since180 FROM (SELECT *, sum(f42) OVER (PARTITION BY entity ORDER BY d_idx, event)::BIGINT AS b42, sum(f180) OVER (PARTITION BY entity ORDER BY d_idx, event)::BIGINT AS b180 FROM (SELECT *, CASE WHEN d_idx - lag(d_idx) OVER w <= 42 THEN 0 ELSE 1 END AS f42, CASE WHEN d_idx - lag(d_idx) OVER w <= 180 THEN 0 ELSE 1 END AS f180 FROM oh " + SEQ_SQL + "))"))
def islands(spark, d):
    """Runs since a break of more than 42 and of more than 180 days."""
    o = order_history(spark, d)
    for gap in (42, 180):
        o = o.withColumn(f"b{gap}", stats.islands(F.col("d_idx"), ["entity"], ["d_idx", "event"], gap))
    since = lambda gap: F.row_number().over(Window.partitionBy("entity", f"b{gap}").orderBy("d_idx", "event")).alias(f"since{gap}")
    return o.select("event", "b42", "b180", since(42), since(180))


@query("W16_adjacent", "SELECT user_id, event_type, hour, value, previous FROM (SELECT *, lag(value) OVER w AS previous, lag(hour) OVER w AS before FROM (SELECT user_id, event_type, date_trunc('hour', ts) AS hour, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2, 3) WINDOW w AS (PARTITION BY user_id, event_type ORDER BY hour)) WHERE before = hour - INTERVAL 1 HOUR")
def adjacent(spark, d):
    """Each snapshot (hour) of a key against the snapshot right before it; where that one is missing there is no pair."""
    e = table(spark, d, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    snaps = e.groupBy("user_id", "event_type", "hour").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))
    w = Window.partitionBy("user_id", "event_type").orderBy("hour")
    rows = snaps.select("*", F.lag("value").over(w).alias("previous"), F.lag("hour").over(w).alias("before"))
    return rows.filter(F.expr("before = hour - INTERVAL 1 HOUR")).drop("before")


@query("W11_meetings", with_pt("SELECT venue, day, block, fy, dense_rank() OVER (PARTITION BY venue, fy ORDER BY block)::INT AS ordinal, row_number() OVER (PARTITION BY venue, fy, block ORDER BY day)::INT AS day_no FROM (SELECT *, sum(f) OVER (PARTITION BY venue ORDER BY day)::BIGINT AS block FROM (SELECT *, CASE WHEN date_diff('day', lag(day) OVER w, day) <= 2 AND fy = lag(fy) OVER w THEN 0 ELSE 1 END AS f FROM (SELECT DISTINCT venue, day, (year(day) - CASE WHEN month(day) < 4 THEN 1 ELSE 0 END)::INT AS fy FROM pt) WINDOW w AS (PARTITION BY venue ORDER BY day)))"))
def meetings(spark, d):
    days = participations(spark, d).select("venue", "day").distinct().withColumn("fy", x.fiscal_year(F.col("day")))
    w = Window.partitionBy("venue").orderBy("day")
    same = (F.datediff("day", F.lag("day").over(w)) <= 2) & (F.col("fy") == F.lag("fy").over(w))
    rows = days.withColumn("f", F.when(same, 0).otherwise(1)).withColumn("block", F.sum("f").over(w)).drop("f")
    return rows.select("venue", "day", "block", "fy", F.dense_rank().over(Window.partitionBy("venue", "fy").orderBy("block")).alias("ordinal"), F.row_number().over(Window.partitionBy("venue", "fy", "block").orderBy("day")).alias("day_no"))


@query("W12_event_level", with_pt("SELECT event, count(nf) AS followed, round(avg((nf <= 3)::INT), 6) AS level FROM (SELECT event, lead(finish) OVER (PARTITION BY entity ORDER BY d_idx, event, runner_no) AS nf FROM pt) GROUP BY 1"))
def event_level(spark, d):
    w = Window.partitionBy("entity").orderBy("d_idx", "event", "runner_no")
    rows = participations(spark, d).select("event", F.lead("finish").over(w).alias("nf"))
    return rows.groupBy("event").agg(F.count("nf").alias("followed"), F.round(F.avg((F.col("nf") <= 3).cast("int")), 6).alias("level"))


@query("W13_changes", with_oh("SELECT event, CASE WHEN lag(priority) OVER w <> priority THEN lag(priority) OVER w || ' > ' || priority END AS changed, lag(status) OVER w IS DISTINCT FROM status AS new_status FROM oh " + SEQ_SQL))
def changes(spark, d):
    prev, cur = F.lag("priority").over(_seq()), F.col("priority")
    return order_history(spark, d).select("event", F.when(prev != cur, F.concat(prev, F.lit(" > "), cur)).alias("changed"), (~F.lag("status").over(_seq()).eqNullSafe(F.col("status"))).alias("new_status"))


@query("W14_seen_before", with_oh("SELECT event, exists(SELECT 1 FROM oh b WHERE b.entity = a.entity AND b.priority = a.priority AND b.d_idx < a.d_idx) AS seen FROM oh a"))
def seen_before(spark, d):
    return order_history(spark, d).select("event", (F.count("*").over(_past("entity", "priority")) > 0).alias("seen"))


@query("W15_change_history", with_oh("SELECT event, a, b, count(*) OVER (PARTITION BY a, b ORDER BY d_idx RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING) AS n FROM (SELECT *, lag(priority) OVER w AS a, priority AS b FROM oh " + SEQ_SQL + ") WHERE a <> b"))
def change_history(spark, d):
    rows = order_history(spark, d).withColumn("a", F.lag("priority").over(_seq())).withColumn("b", F.col("priority")).filter("a <> b")
    # Transitions are few keys: count by day first, so that a frame holds days and not rows.
    days = asof.window_sums(asof.day_buckets(rows, ["a", "b"], "d_idx", {"n": F.lit(1)}), ["a", "b"], "d_idx", ["n"], 365)
    out = rows.select("event", "a", "b", "d_idx").join(days.select("a", "b", "d_idx", "n_before"), ["a", "b", "d_idx"])
    return out.select("event", "a", "b", F.coalesce("n_before", F.lit(0)).cast("long").alias("n"))


WEIGHTS = (1.0, 0.8, 0.64, 0.512, 0.4096)


@query("W17_decayed_mean", with_oh("SELECT event, round((" + " + ".join(f"coalesce(lag(price, {i}) OVER w * {v}, 0)" for i, v in enumerate(WEIGHTS, 1)) + ") / nullif(" + " + ".join(f"(CASE WHEN lag(price, {i}) OVER w IS NOT NULL THEN {v} ELSE 0 END)" for i, v in enumerate(WEIGHTS, 1)) + ", 0), 4) AS mean FROM oh " + SEQ_SQL))
def decayed_mean(spark, d):
    lags = [F.lag("price", i).over(_seq()) for i in range(1, 6)]
    top = sum((F.coalesce(v * w, F.lit(0.0)) for v, w in zip(lags, WEIGHTS, strict=True)), F.lit(0.0))
    low = sum((F.when(v.isNotNull(), F.lit(w)).otherwise(0.0) for v, w in zip(lags, WEIGHTS, strict=True)), F.lit(0.0))
    return order_history(spark, d).select("event", F.round(F.try_divide(top, low), 4).alias("mean"))


@query("W18_rolling", with_oh("SELECT event, round(avg(price) OVER r, 4) AS mean, max(price) OVER r AS most, min(price) OVER r AS least, round(stddev_samp(price) OVER r, 4) AS sd FROM oh WINDOW r AS (PARTITION BY entity ORDER BY d_idx, event ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"))
def rolling(spark, d):
    r = _seq().rowsBetween(-5, -1)
    sd = F.when(F.count("price").over(r) >= 2, F.stddev_samp("price").over(r))
    return order_history(spark, d).select("event", F.round(F.avg("price").over(r), 4).alias("mean"), F.max("price").over(r).alias("most"), F.min("price").over(r).alias("least"), F.round(sd, 4).alias("sd"))


SPANS = (372, 358), (737, 723), (1102, 1088)


@query("W19_seasonal", with_pt("SELECT d.venue, d.d_idx, round(coalesce(s.m, y.m), 4) AS baseline, CASE WHEN s.m IS NOT NULL THEN 'season' WHEN y.m IS NOT NULL THEN 'year' END AS level FROM dv d LEFT JOIN sn s USING (venue, d_idx) LEFT JOIN yr y USING (venue, d_idx)", "dv AS (SELECT DISTINCT venue, d_idx FROM pt)",
    "sn AS (SELECT a.venue, a.d_idx, median(b.measure) AS m FROM dv a JOIN pt b ON b.venue = a.venue AND (" + " OR ".join(f"b.d_idx BETWEEN a.d_idx - {x0} AND a.d_idx - {x1}" for x0, x1 in SPANS) + ") GROUP BY 1, 2 HAVING count(*) >= 8)",
    "yr AS (SELECT a.venue, a.d_idx, median(b.measure) AS m FROM dv a JOIN pt b ON b.venue = a.venue AND b.d_idx BETWEEN a.d_idx - 365 AND a.d_idx - 1 GROUP BY 1, 2 HAVING count(*) >= 8)"))
def seasonal(spark, d):
    p = written(participations(spark, d).groupBy("venue", "d_idx", "measure").agg(F.count("*").alias("times")), "measures")
    days = p.select("venue", "d_idx").distinct()
    facts = p.select("venue", F.col("d_idx").alias("at"), "measure", "times")
    # The years' spans fall on one another when facts move ahead by the end of their span.
    width = SPANS[0][0] - SPANS[0][1] + 1
    ahead = facts.withColumn("by", F.explode(F.array(*[F.lit(b - 1) for _, b in SPANS]))).withColumn("at", F.col("at") + F.col("by"))
    med = lambda facts, k, n: moving(days, facts, by=["venue"], day="d_idx", at="at", value="measure", times="times", days=k).filter("window_n >= 8").select("venue", "d_idx", F.col("window").alias(n))
    s, y = med(ahead, width, "s"), med(facts, 365, "y")
    out = days.join(s, ["venue", "d_idx"], "left").join(y, ["venue", "d_idx"], "left")
    level = F.when(F.col("s").isNotNull(), "season").when(F.col("y").isNotNull(), "year")
    return out.select("venue", "d_idx", F.round(F.coalesce("s", "y"), 4).alias("baseline"), level.alias("level"))


#: Days from which a venue's values are of another kind; venues without one have a single regime.
REGIMES = {0: -1500, 3: -1200, 4: -900, 7: -1000, 11: -700, 19: -1300}
_CUT = "CASE venue " + " ".join(f"WHEN {v} THEN d_idx >= {c}" for v, c in REGIMES.items()) + " ELSE false END AS regime"


@query("W19_regimes", with_pt("SELECT d.venue, d.d_idx, round(coalesce(s.m, y.m), 4) AS baseline, CASE WHEN s.m IS NOT NULL THEN 'season' WHEN y.m IS NOT NULL THEN 'year' END AS level, coalesce(s.n, 0)::BIGINT AS n_season, coalesce(y.n, 0)::BIGINT AS n_year FROM dv d LEFT JOIN sn s USING (venue, d_idx) LEFT JOIN yr y USING (venue, d_idx)",
    f"rg AS (SELECT venue, d_idx, measure, {_CUT} FROM pt)", "dv AS (SELECT DISTINCT venue, d_idx, regime FROM rg)",
    "sn AS (SELECT a.venue, a.d_idx, median(b.measure) AS m, count(*) AS n FROM dv a JOIN rg b ON b.venue = a.venue AND b.regime = a.regime AND (" + " OR ".join(f"b.d_idx BETWEEN a.d_idx - {x0} AND a.d_idx - {x1}" for x0, x1 in SPANS) + ") GROUP BY 1, 2 HAVING count(*) >= 8)",
    "yr AS (SELECT a.venue, a.d_idx, median(b.measure) AS m, count(*) AS n FROM dv a JOIN rg b ON b.venue = a.venue AND b.regime = a.regime AND b.d_idx BETWEEN a.d_idx - 365 AND a.d_idx - 1 GROUP BY 1, 2 HAVING count(*) >= 8)"))
def seasonal_regimes(spark, d):
    """The seasonal baseline from rows of the day's own regime only, with the rows behind each level."""
    cut = F.lit(False)
    for v, c in REGIMES.items():
        cut = F.when(F.col("venue") == v, F.col("d_idx") >= c).otherwise(cut)
    p = participations(spark, d).groupBy("venue", "d_idx", "measure", cut.alias("regime")).agg(F.count("*").alias("times"))
    p = written(p, "measures")
    days, by = p.select("venue", "regime", "d_idx").distinct(), ["venue", "regime"]
    facts = p.select(*by, F.col("d_idx").alias("at"), "measure", "times")
    ahead = facts.withColumn("by", F.explode(F.array(*[F.lit(b - 1) for _, b in SPANS]))).withColumn("at", F.col("at") + F.col("by"))
    med = lambda facts, k, n: moving(days, facts, by=by, day="d_idx", at="at", value="measure", times="times", days=k).filter("window_n >= 8").select("venue", "d_idx", F.col("window").alias(n), F.col("window_n").alias(f"n_{n}"))
    s, y = med(ahead, SPANS[0][0] - SPANS[0][1] + 1, "season"), med(facts, 365, "year")
    out = days.join(s, ["venue", "d_idx"], "left").join(y, ["venue", "d_idx"], "left")
    level = F.when(F.col("season").isNotNull(), "season").when(F.col("year").isNotNull(), "year")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("venue", "d_idx", F.round(F.coalesce("season", "year"), 4).alias("baseline"), level.alias("level"), n("n_season"), n("n_year"))


@query("W20_last_year", with_pt("SELECT p.event, p.runner_no, y.n, y.wins FROM pt p LEFT JOIN yy y ON y.rider = p.rider AND y.yr = year(p.day) - 1", "yy AS (SELECT rider, year(day) AS yr, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS wins FROM pt GROUP BY 1, 2)"))
def last_year(spark, d):
    p = participations(spark, d)
    y = p.groupBy("rider", (F.year("day") + 1).alias("yr")).agg(F.count("*").alias("n"), F.count_if(F.col("finish") == 1).alias("wins"))
    return p.select("event", "runner_no", "rider", F.year("day").alias("yr")).join(y, ["rider", "yr"], "left").drop("rider", "yr")


@query("W22_style", with_oh("SELECT event, CASE WHEN len(u) >= 3 THEN CASE WHEN list_avg(u) < 2.5 THEN 'front' WHEN list_avg(u) < 3.5 THEN 'middle' ELSE 'back' END END AS style FROM (SELECT event, CASE WHEN len(same) >= 3 THEN same ELSE l END AS u FROM (SELECT event, list_transform(l, x -> x.g) AS l, list_transform(list_filter(l, x -> x.s = status), x -> x.g) AS same FROM (SELECT event, status, (SELECT list({'s': status, 'g': grade}) FROM (SELECT * FROM oh b WHERE b.entity = a.entity AND b.d_idx < a.d_idx AND b.d_idx >= a.d_idx - 365 ORDER BY b.d_idx DESC, b.event DESC LIMIT 5)) AS l FROM oh a)))").replace("x -> ", "lambda x: "))
def style(spark, d):
    """Mean position of the last five rows of a year, of those alone that share the row's venue (status) if they are three."""
    o = order_history(spark, d)
    last = asof.last_before(o, ["entity"], "d_idx", ["event"], ["status", "grade"], 5)
    rows = o.select("event", "entity", "d_idx", "status").join(last, ["entity", "d_idx"])
    year = F.filter("last", lambda r: r["d_idx"] >= F.col("d_idx") - 365)
    rows = rows.select("event", "status", year.alias("l"))
    same = F.filter("l", lambda r: r["status"] == F.col("status"))
    used = F.when(F.size(same) >= 3, same).otherwise(F.col("l"))
    g = F.aggregate(used, F.lit(0), lambda a, r: a + r["grade"]) / F.size(used)
    label = F.when(F.size(used) >= 3, F.when(g < 2.5, "front").when(g < 3.5, "middle").otherwise("back"))
    return rows.select("event", label.alias("style"))


@query("W23_form_facts", with_oh("""SELECT event, count(*) OVER p AS runs, (d_idx - max(d_idx) OVER p)::INT AS days_since, round(avg((grade = 1)::INT) OVER p, 6) AS late_rate, round(avg(CASE WHEN prev <= 2 THEN (grade <= 2)::INT END) OVER p, 6) AS hold_rate,
  round(avg(CASE WHEN prev IS NOT NULL THEN (grade > prev)::INT END) OVER p, 6) AS fade_rate, round(avg((grade = 1)::INT) OVER v, 6) AS venue_rate, round(avg((grade = 1)::INT) OVER t, 6) AS weekend_rate, round(median(gap) OVER p, 4) AS median_gap,
  row_number() OVER (PARTITION BY entity, year(day) ORDER BY d_idx, event)::INT AS of_year, round(median(price) OVER p, 4) AS median_price
  FROM (SELECT *, lag(grade) OVER w AS prev, d_idx - lag(d_idx) OVER w AS gap, dayofweek(day) IN (0, 6) AS weekend FROM oh WINDOW w AS (PARTITION BY entity ORDER BY d_idx, event))
  WINDOW p AS (PARTITION BY entity ORDER BY d_idx RANGE BETWEEN 730 PRECEDING AND 1 PRECEDING), v AS (PARTITION BY entity, status ORDER BY d_idx RANGE BETWEEN 730 PRECEDING AND 1 PRECEDING), t AS (PARTITION BY entity, weekend ORDER BY d_idx RANGE BETWEEN 730 PRECEDING AND 1 PRECEDING)"""))
def form_facts(spark, d):
    """Two years before the day: counts, late, hold and fade rates, late rates at the venue and on the kind of day, gaps."""
    p, v, t = _past("entity", days=730), _past("entity", "status", days=730), _past("entity", "weekend", days=730)
    of_year = F.row_number().over(Window.partitionBy("entity", F.year("day")).orderBy("d_idx", "event"))
    o = order_history(spark, d).select(
        "*", F.lag("grade").over(_seq()).alias("prev"), (F.col("d_idx") - F.lag("d_idx").over(_seq())).alias("gap"), F.dayofweek("day").isin(1, 7).alias("weekend")
    )
    share = lambda ok, w: F.round(F.avg(ok.cast("int")).over(w), 6)
    late, prev = F.col("grade") == 1, F.col("prev")
    return o.select(
        "event", F.count("*").over(p).alias("runs"), (F.col("d_idx") - F.max("d_idx").over(p)).alias("days_since"), share(late, p).alias("late_rate"),
        share(F.when(prev <= 2, F.col("grade") <= 2), p).alias("hold_rate"), share(F.when(prev.isNotNull(), F.col("grade") > prev), p).alias("fade_rate"),
        share(late, v).alias("venue_rate"), share(late, t).alias("weekend_rate"), F.round(F.percentile("gap", 0.5).over(p), 4).alias("median_gap"),
        of_year.alias("of_year"), F.round(F.percentile("price", 0.5).over(p), 4).alias("median_price"),
    )


@query("W24_active", with_pt("SELECT sire, d, sum(step) OVER (PARTITION BY sire ORDER BY d)::BIGINT AS active FROM (SELECT sire, d, sum(s) AS step FROM (SELECT sire, d_idx AS d, 1 AS s FROM iv UNION ALL SELECT sire, until, -1 FROM iv) GROUP BY 1, 2)", "dd AS (SELECT DISTINCT sire, entity, d_idx FROM pt)", "iv AS (SELECT sire, d_idx, least(lead(d_idx) OVER (PARTITION BY sire, entity ORDER BY d_idx), d_idx + 365) AS until FROM dd)"))
def active(spark, d):
    dd = participations(spark, d).select("sire", "entity", "d_idx").distinct()
    until = F.least(F.lead("d_idx").over(Window.partitionBy("sire", "entity").orderBy("d_idx")), F.col("d_idx") + 365)
    steps = dd.withColumn("until", until).select("sire", F.inline(F.array(F.struct(F.col("d_idx").alias("d"), F.lit(1).alias("s")), F.struct(F.col("until").alias("d"), F.lit(-1).alias("s")))))
    days = steps.groupBy("sire", "d").agg(F.sum("s").alias("step"))
    return days.select("sire", "d", F.sum("step").over(Window.partitionBy("sire").orderBy("d")).alias("active"))


@query("W25_home", with_pt("SELECT rider, d_idx, home FROM (SELECT a.rider, a.d_idx, b.venue AS home, row_number() OVER (PARTITION BY a.rider, a.d_idx ORDER BY count(*) DESC, b.venue) AS k FROM (SELECT DISTINCT rider, d_idx FROM pt) a JOIN pt b ON a.rider = b.rider AND b.d_idx BETWEEN a.d_idx - 365 AND a.d_idx - 1 GROUP BY 1, 2, 3) WHERE k = 1"))
def home(spark, d):
    p = participations(spark, d)
    days = p.select("rider", "d_idx").distinct()
    out = moving(days, p.select("rider", "d_idx", "venue"), by=["rider"], day="d_idx", value="venue", days=365, stat="mode").filter("window_n > 0")
    return out.select("rider", "d_idx", F.col("window").cast("int").alias("home"))


SIGNED = "CASE WHEN grade <= 2 THEN 10 WHEN grade = 3 THEN 0 ELSE -5 END"


def signed():
    return F.when(F.col("grade") <= 2, 10).when(F.col("grade") == 3, 0).otherwise(-5)


ANCHORED = f"an AS (SELECT *, sum({SIGNED}) OVER (PARTITION BY entity ORDER BY d_idx, event) AS run, CASE WHEN row_number() OVER (PARTITION BY entity, year(day) ORDER BY d_idx, event) = 1 THEN round(price / 1000)::BIGINT END AS official FROM oh)"


@query("W26_balance", with_oh(f"SELECT event, sum({SIGNED}) OVER (PARTITION BY entity, year(day) - CASE WHEN month(day) < 4 THEN 1 ELSE 0 END ORDER BY d_idx, event)::BIGINT AS carried, (run + last_value(official - run IGNORE NULLS) OVER (PARTITION BY entity ORDER BY d_idx, event ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS forwards, (run + first_value(official - run IGNORE NULLS) OVER (PARTITION BY entity ORDER BY d_idx, event ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))::BIGINT AS backwards FROM an", ANCHORED))
def balance(spark, d):
    """Running balance carried within a fiscal year, and rebuilt from official values (each year's first row): forwards
    from the last one and backwards from the next one, by differences of one running sum."""
    o = order_history(spark, d).withColumn("fy", x.fiscal_year(F.col("day"))).withColumn("s", signed())
    run = lambda *k: F.sum("s").over(Window.partitionBy(*k).orderBy("d_idx", "event"))
    first = F.row_number().over(Window.partitionBy("entity", F.year("day")).orderBy("d_idx", "event")) == 1
    o = o.withColumn("run", run("entity")).withColumn("gap", F.when(first, F.round(F.col("price") / 1000).cast("long")) - F.col("run"))
    before, after = _seq().rowsBetween(Window.unboundedPreceding, 0), _seq().rowsBetween(1, Window.unboundedFollowing)
    forwards = F.col("run") + F.last("gap", ignorenulls=True).over(before)
    backwards = F.col("run") + F.first("gap", ignorenulls=True).over(after)
    return o.select("event", run("entity", "fy").alias("carried"), forwards.alias("forwards"), backwards.alias("backwards"))


@query("W27_points", with_oh(f"SELECT event, coalesce(sum({SIGNED}) OVER (PARTITION BY entity ORDER BY d_idx RANGE BETWEEN 365 PRECEDING AND 7 PRECEDING), 0)::BIGINT AS points FROM oh"))
def points(spark, d):
    w = Window.partitionBy("entity").orderBy("d_idx").rangeBetween(-365, -7)
    return order_history(spark, d).select("event", F.coalesce(F.sum(signed()).over(w), F.lit(0)).cast("long").alias("points"))


FOLD = f"WITH RECURSIVE {OH}, s AS (SELECT entity, {SIGNED} AS amount, grade * 20 AS lim, row_number() OVER (PARTITION BY entity ORDER BY d_idx, event) AS k FROM oh), f AS (SELECT entity, 0 AS k, 0 AS points FROM (SELECT DISTINCT entity FROM s) UNION ALL SELECT f.entity, f.k + 1, least(60, greatest(f.points, least(f.points + s.amount, s.lim))) FROM f JOIN s ON s.entity = f.entity AND s.k = f.k + 1) SELECT entity, max(k)::BIGINT AS n, arg_max(points, k)::INT AS points FROM f GROUP BY 1"


@query("W27_folded_points", FOLD)
def folded_points(spark, d):
    """Order-dependent ledger: each amount is capped by a per-row limit and the total by a global one."""
    rows = order_history(spark, d).withColumn("amount", signed())
    seq = F.array_sort(F.collect_list(F.struct("d_idx", "event", "amount", (F.col("grade") * 20).alias("lim"))))
    step = lambda a, r: F.least(F.lit(60), F.greatest(a, F.least(a + r["amount"], r["lim"])))
    return rows.groupBy("entity").agg(seq.alias("s")).select("entity", F.size("s").cast("long").alias("n"), F.aggregate("s", F.lit(0), step).alias("points"))


#: Amounts of the first five places, and the most that a balance can be.
AMOUNTS, CAP = (30, 20, 12, 8, 5), 60
W27_CHECK = f"""WITH RECURSIVE {OH}, rk AS (SELECT *, year(day) AS y, least({CAP}, floor(price / 10000 + 0.5))::BIGINT AS told, rank() OVER (PARTITION BY d_idx, grade ORDER BY floor(price / 50000) DESC) AS place, count(*) OVER (PARTITION BY d_idx, grade, floor(price / 50000)) AS ties, row_number() OVER (PARTITION BY entity, year(day) ORDER BY d_idx, event) AS k FROM oh),
 am AS MATERIALIZED (SELECT *, CASE WHEN place <= 5 THEN list_sum({list(AMOUNTS)}[place:least(place + ties - 1, 5)]) // ties ELSE 0 END::BIGINT AS amount, CASE WHEN place > 1 THEN grade * 20 ELSE {CAP} END AS lim FROM rk),
 f AS (SELECT entity, y, 1::BIGINT AS k, told AS points FROM am WHERE k = 1 UNION ALL SELECT f.entity, f.y, f.k + 1, least({CAP}, greatest(f.points, least(f.points + am.amount, am.lim)))::BIGINT FROM f JOIN am ON am.entity = f.entity AND am.y = f.y AND am.k = f.k + 1),
 ck AS (SELECT entity, lead(y) OVER w AS round, points AS computed, lead(told) OVER w AS published FROM (SELECT entity, y, arg_max(points, k) AS points FROM f GROUP BY 1, 2) JOIN (SELECT entity, y, told FROM am WHERE k = 1) USING (entity, y) WINDOW w AS (PARTITION BY entity ORDER BY y))
 SELECT round::INT AS round, entity, computed, published, computed = published AS matched, count(*) OVER (PARTITION BY round) AS n, count(*) FILTER (WHERE computed = published) OVER (PARTITION BY round) AS hits FROM ck WHERE round IS NOT NULL"""


@query("W27_crosscheck", W27_CHECK)
def crosscheck(spark, d):
    """Balances carried on from each published value (a year's first order) by places' amounts, ties sharing them, against
    the next published one: a row for each check, with its round's checks and hits."""
    race = Window.partitionBy("d_idx", "grade")
    step = F.floor(F.col("price") / 50000)
    rows = order_history(spark, d).withColumn("step", step).withColumn("y", F.year("day")).withColumn("told", F.least(F.lit(CAP), F.floor(F.col("price") / 10000 + 0.5)).cast("long"))
    place, ties = F.rank().over(race.orderBy(F.desc("step"))), F.count("*").over(Window.partitionBy("d_idx", "grade", "step"))
    rows = rows.withColumn("place", place).withColumn("ties", ties)
    limit = F.when(F.col("place") > 1, F.col("grade") * 20).otherwise(CAP).cast("long")
    row = F.struct("d_idx", "event", "told", stats.tie_mean(F.col("place"), F.col("ties"), AMOUNTS).alias("amount"), limit.alias("lim"))
    years = rows.groupBy("entity", "y").agg(F.array_sort(F.collect_list(row)).alias("s"))  # an entity's rows of one year
    later = F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0)))
    years = years.select("entity", "y", F.col("s")[0]["told"].alias("told"), stats.capped_fold(F.col("s")[0]["told"], later, "amount", "lim", CAP).alias("computed"))
    w = Window.partitionBy("entity").orderBy("y")
    checks = years.select("entity", F.lead("y").over(w).alias("round"), "computed", F.lead("told").over(w).alias("published")).filter("round IS NOT NULL")
    checks = checks.withColumn("matched", F.col("computed") == F.col("published"))
    totals = checks.groupBy("round").agg(F.count("*").alias("n"), F.count_if("matched").alias("hits"))
    return checks.join(F.broadcast(totals), "round").select("round", "entity", "computed", "published", "matched", "n", "hits")  # a row a year


#: Dated lines: the points that count from a switch date on.
LINES = (("1990-01-01", 30), ("1997-04-01", 35), ("1999-04-01", 40), ("2001-01-01", 50))
W28 = (
    "ls AS (SELECT entity, last, CASE WHEN month(last) < 4 THEN make_date(year(last), 4, 1) WHEN month(last) < 10 THEN make_date(year(last), 10, 1) ELSE make_date(year(last) + 1, 4, 1) END AS switch FROM (SELECT entity, max(day) AS last FROM oh GROUP BY 1))",
    f"sw AS (SELECT entity, last, switch, coalesce(sum(CASE WHEN day > switch - 730 THEN {SIGNED} END), 0)::BIGINT AS points, coalesce(sum(CASE WHEN day > last - 730 AND day <= switch - 730 THEN {SIGNED} END), 0)::BIGINT AS dropping FROM ls JOIN oh USING (entity) GROUP BY 1, 2, 3)",
    "li AS (SELECT *, (year(switch) - 1980 - entity % 20)::BIGINT AS age, CASE " + " ".join(f"WHEN switch >= DATE '{a}' THEN {b}" for a, b in reversed(LINES)) + " END AS line FROM sw)",
)


@query("W28_forecast", with_oh("SELECT entity, switch, age, line, points, dropping, greatest(line - points, 0) AS short, CASE WHEN age < 3 THEN 'too young' WHEN last < switch - 150 THEN 'inactive' WHEN points < 0 THEN 'negative' WHEN points >= line THEN 'reached' ELSE 'open' END AS reason FROM li", *W28))
def forecast(spark, d):
    """At an entity's next switch date (April or October 1st) after its last row: age, the line of that date, points of the
    730 days before, what drops out until then, the shortfall, and why an entity is left out."""
    o = order_history(spark, d).withColumn("s", signed()).withColumn("last", F.max("day").over(Window.partitionBy("entity")))
    year, month = F.year("last"), F.month("last")
    switch = F.when(month < 4, F.make_date(year, F.lit(4), F.lit(1))).when(month < 10, F.make_date(year, F.lit(10), F.lit(1))).otherwise(F.make_date(year + 1, F.lit(4), F.lit(1)))
    o = o.withColumn("switch", switch)
    start = F.date_sub("switch", 730)
    total = lambda ok: F.coalesce(F.sum(F.when(ok, F.col("s"))), F.lit(0)).cast("long")
    g = o.groupBy("entity", "last", "switch").agg(total(F.col("day") > start).alias("points"), total((F.col("day") > F.date_sub("last", 730)) & (F.col("day") <= start)).alias("dropping"))
    line = F.lit(None).cast("int")
    for day, points in LINES:
        line = F.when(F.col("switch") >= F.lit(day).cast("date"), points).otherwise(line)
    g = g.withColumn("age", F.year("switch") - 1980 - F.col("entity") % 20).withColumn("line", line)
    reason = F.when(F.col("age") < 3, "too young").when(F.col("last") < F.date_sub("switch", 150), "inactive").when(F.col("points") < 0, "negative").when(F.col("points") >= F.col("line"), "reached").otherwise("open")
    return g.select("entity", "switch", "age", "line", "points", "dropping", F.greatest(F.col("line") - F.col("points"), F.lit(0)).alias("short"), reason.alias("reason"))


@query("W29_after_reference", with_oh("SELECT r.entity, count(o.event) AS n, min(o.day) AS first FROM (SELECT entity, min(day) + 365 AS ref FROM oh GROUP BY 1) r LEFT JOIN oh o ON o.entity = r.entity AND o.day > r.ref GROUP BY 1"))
def after_reference(spark, d):
    o = order_history(spark, d)
    ref = F.date_add(F.min("day").over(Window.partitionBy("entity")), 365)
    late = F.when(F.col("day") > F.col("ref"), F.col("day"))
    return o.withColumn("ref", ref).groupBy("entity").agg(F.count(late).alias("n"), F.min(late).alias("first"))


@query("W30_debut", with_oh("SELECT entity, event, day, price FROM (SELECT *, row_number() OVER w AS k FROM oh " + SEQ_SQL + ") WHERE k = 1"))
def debut(spark, d):
    first = F.min_by(F.struct("event", "day", "price"), F.struct("d_idx", "event"))
    return order_history(spark, d).groupBy("entity").agg(first.alias("s")).select("entity", "s.*")


@query("W31_bitemporal", with_pt("SELECT p.event, p.runner_no, any_value(p.pct) AS pct, count(q.measure) AS known, count(q.measure) FILTER (WHERE q.d_idx >= p.d_idx - 14) AS n14, round(avg(q.measure), 6) AS mean FROM (SELECT *, round(percent_rank() OVER (PARTITION BY d_idx, going ORDER BY measure), 6) AS pct FROM pt) p LEFT JOIN pt q ON q.rider = p.rider AND q.d_idx < p.d_idx AND q.d_idx >= p.d_idx - 60 AND q.available <= p.day GROUP BY 1, 2"))
def bitemporal(spark, d):
    """Facts of the 60 days before that had become known by the day, how many of them in 14 days, and the own value's
    rank among all of the day and condition."""
    p = participations(spark, d)
    pct = F.percent_rank().over(Window.partitionBy("d_idx", "going").orderBy("measure"))
    left = p.select("event", "runner_no", "rider", "d_idx", "day", F.round(pct, 6).alias("pct"))
    facts = p.select("rider", F.col("d_idx").alias("at"), "available", "measure")
    near = asof.band_join(left, facts, by=["rider"], left_on="d_idx", right_on="at", days=60).filter("available <= day")
    g = near.groupBy("event", "runner_no").agg(F.count("*").alias("known"), F.count_if(F.col("at") >= F.col("d_idx") - 14).alias("n14"), F.round(F.avg("measure"), 6).alias("mean"))
    out = left.select("event", "runner_no", "pct").join(g, ["event", "runner_no"], "left")
    return out.fillna(0, ["known", "n14"])


@query("W32_partner_conflict", with_pt("SELECT event, runner_no, count(*) FILTER (WHERE other <> runner_no) AS rivals FROM (SELECT a.event, a.runner_no, b.runner_no AS other FROM pt a JOIN pt b ON a.event = b.event AND a.sire = b.sire) GROUP BY 1, 2"))
def partner_conflict(spark, d):
    n = F.count("*").over(Window.partitionBy("event", "sire")) - 1
    return participations(spark, d).select("event", "runner_no", n.alias("rivals"))


W32 = "lp AS (SELECT a.event, a.runner_no, a.rider, a.sire, a.d_idx, list(b.sire ORDER BY b.d_idx DESC, b.event DESC, b.runner_no DESC)[1:3] AS known FROM pt a LEFT JOIN pt b ON b.rider = a.rider AND b.d_idx < a.d_idx GROUP BY ALL)"


@query("W32_known_partners", with_pt("SELECT a.event, a.runner_no, coalesce(list_contains(any_value(a.known), any_value(a.sire)), false) AS chosen, count(*) FILTER (WHERE list_contains(a.known, b.sire)) AS passed_over, count(*) FILTER (WHERE list_contains(b.known, a.sire) AND b.sire <> a.sire) AS dropped_by, any_value(e.entries) AS entries FROM lp a LEFT JOIN lp b ON b.event = a.event AND b.runner_no <> a.runner_no JOIN (SELECT rider, d_idx, count(*) AS entries FROM pt GROUP BY 1, 2) e ON e.rider = a.rider AND e.d_idx = a.d_idx GROUP BY 1, 2", W32))
def known_partners(spark, d):
    """A rider's last three partners (sires) of earlier days against the event's field: whether the present one is among
    them, how many others of the field are, and how many other riders know this runner's partner but ride another; with the
    rider's entries of the day. Pairs are made inside an event only, whose field is small."""
    p = participations(spark, d)
    last = asof.last_before(p, ["rider"], "d_idx", ["event", "runner_no"], ["sire"], 3).select("rider", "d_idx", F.col("last.sire").alias("known"))
    entries = F.count("*").over(Window.partitionBy("rider", "d_idx")).alias("entries")
    a = p.select("event", "runner_no", "rider", "sire", "d_idx", entries).join(last, ["rider", "d_idx"], "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))
    b = a.select("event", F.col("runner_no").alias("no2"), F.col("sire").alias("sire2"), F.col("known").alias("known2"))
    pairs = a.join(b, "event").filter("no2 <> runner_no").groupBy("event", "runner_no").agg(
        F.count_if(F.array_contains("known", F.col("sire2"))).alias("passed_over"), F.count_if(F.array_contains("known2", F.col("sire")) & (F.col("sire2") != F.col("sire"))).alias("dropped_by")
    )
    out = a.select("event", "runner_no", F.array_contains("known", F.col("sire")).alias("chosen"), "entries").join(pairs, ["event", "runner_no"], "left")
    return out.fillna(0, ["passed_over", "dropped_by"])


AS_OF = ("1996-07-01", "1998-01-01", "1999-12-31")


@query("W33_rewind", with_oh("SELECT c.entity, a.d AS as_of, coalesce((SELECT arg_min(l.was, (l.d_idx, l.event)) FROM lg l WHERE l.entity = c.entity AND l.day > a.d), c.now) AS value FROM (SELECT entity, arg_max(priority, (d_idx, event)) AS now FROM oh GROUP BY 1) c CROSS JOIN (VALUES " + ", ".join(f"(DATE '{a}')" for a in AS_OF) + ") a(d)", "lg AS (SELECT * FROM (SELECT *, lag(priority) OVER w AS was FROM oh " + SEQ_SQL + ") WHERE was <> priority)"))
def rewind(spark, d):
    """An attribute as of past days from its current value and a change log: the from-value of the first change after the
    day, else the current value. One grouping for all days."""
    o = order_history(spark, d).withColumn("was", F.lag("priority").over(_seq()))
    at = F.struct("d_idx", "event")
    days = [F.lit(a).cast("date") for a in AS_OF]
    later = [F.min_by("was", F.when((F.col("was") != F.col("priority")) & (F.col("day") > a), at)).alias(f"was{i}") for i, a in enumerate(days)]
    g = o.groupBy("entity").agg(F.max_by("priority", at).alias("now"), *later)
    rows = F.inline(F.array(*[F.struct(a.alias("as_of"), F.coalesce(f"was{i}", "now").alias("value")) for i, a in enumerate(days)]))
    return g.select("entity", rows)


@query("W34_rolling_median", with_pt("SELECT d.rider, d.d_idx, count(q.measure) AS n, median(q.measure) AS med, array_to_string(list(q.measure::INT ORDER BY q.d_idx DESC, q.event DESC, q.runner_no DESC)[1:3], ',') AS last3 FROM (SELECT DISTINCT rider, d_idx FROM pt) d JOIN pt q ON q.rider = d.rider AND q.d_idx BETWEEN d.d_idx - 730 AND d.d_idx - 1 GROUP BY 1, 2"))
def rolling_median(spark, d):
    """Median and count of the 730 days before, and the last three values."""
    p = participations(spark, d)
    out = moving(p.select("rider", "d_idx").distinct(), p, by=["rider"], day="d_idx", value="measure", days=730).filter("window_n > 0")
    last = asof.last_before(p, ["rider"], "d_idx", ["event", "runner_no"], ["measure"], 3)
    year2 = F.filter("last", lambda r: r["d_idx"] >= F.col("d_idx") - 730)
    last = last.select("rider", "d_idx", F.array_join(F.transform(year2, lambda r: r["measure"].cast("int").cast("string")), ",").alias("last3"))
    return out.join(last, ["rider", "d_idx"]).select("rider", "d_idx", F.col("window_n").alias("n"), F.col("window").alias("med"), "last3")