"""Queries of the T family, batch and streaming."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import asof
from ..operators import ticks as tk
from ..operators.probability import payout_coefficients
from ..operators.stats import half_up
from ..streaming import jobs
from .demo import hu, query, table, ticks, with_tk

ML = "tm AS (SELECT *, date_sub('second', ts, deadline) / 60 AS minutes_left FROM tk WHERE ts <= deadline)"
BASES = (30, 20, 10, 5, 3)
BASE_SQL = "bs AS (SELECT grp, day, m, arg_max(value, (ts, id)) AS base FROM tm, (VALUES (30), (20), (10), (5), (3)) v(m) WHERE minutes_left >= m GROUP BY 1, 2, 3), fv AS (SELECT grp, day, arg_max(value, (ts, id)) AS final FROM tm GROUP BY 1, 2)"


def open_ticks(spark, d):
    return tk.before_deadline(ticks(spark, d))


@query("T1_minutes_left", with_tk("SELECT id, round(minutes_left, 4) AS minutes_left FROM tm", ML))
def minutes_left(spark, d):
    return open_ticks(spark, d).select("id", F.round("minutes_left", 4).alias("minutes_left"))


@query("T2_bases", with_tk("SELECT grp, day, m, base FROM bs", ML, BASE_SQL))
def bases(spark, d):
    return tk.base_values(open_ticks(spark, d), ["grp", "day"], BASES)


@query("T3_drops", with_tk("SELECT grp, day, bool_or(1 - final / nullif(base, 0) >= 0.2) AS any_drop, round(max(1 - final / nullif(base, 0)), 6) AS best FROM bs JOIN fv USING (grp, day) GROUP BY 1, 2", ML, BASE_SQL))
def drops(spark, d):
    t = open_ticks(spark, d)
    j = tk.base_values(t, ["grp", "day"], BASES).join(tk.final_values(t, ["grp", "day"]), ["grp", "day"])
    ratio = tk.drop_ratio(F.col("base"), F.col("final"))
    return j.groupBy("grp", "day").agg(F.bool_or(ratio >= 0.2).alias("any_drop"), F.round(F.max(ratio), 6).alias("best"))


@query("T4_series", with_tk("SELECT grp, day, count(*) AS n, string_agg(id, ',' ORDER BY minutes_left DESC, id) AS ids FROM tm WHERE minutes_left <= 240 GROUP BY 1, 2", ML))
def series(spark, d):
    t = open_ticks(spark, d).filter("minutes_left <= 240")
    s = F.array_sort(F.collect_list(F.struct((-F.col("minutes_left")).alias("m"), "id", "value")))
    return t.groupBy("grp", "day").agg(F.count("*").alias("n"), s.alias("s")).select("grp", "day", "n", F.array_join(F.col("s.id").cast("array<string>"), ",").alias("ids"))


CO = "co AS (SELECT id, grp, key, day, value, previous FROM (SELECT *, lag(value) OVER (PARTITION BY key, grp ORDER BY ts, id) AS previous FROM tk) WHERE previous > 0 AND value <= 0.5 * previous)"


@query("T5_collapses", with_tk("SELECT id, grp, key, value, previous FROM co", CO))
def collapses(spark, d):
    return tk.collapses(ticks(spark, d), ["key", "grp"]).select("id", "grp", "key", "value", "previous")


@query("T6_cards", with_tk("SELECT grp, day, count(DISTINCT key) AS keys, count(*) AS steps, round(min(value / previous), 6) AS best, arg_min(key, (value / previous, id)) AS best_key FROM co GROUP BY 1, 2", CO))
def cards(spark, d):
    c = tk.collapses(ticks(spark, d), ["key", "grp"])
    ratio = F.col("value") / F.col("previous")
    return c.groupBy("grp", "day").agg(F.count_distinct("key").alias("keys"), F.count("*").alias("steps"), F.round(F.min(ratio), 6).alias("best"), F.min_by("key", F.struct(ratio.alias("r"), "id")).alias("best_key"))


#: The last hours before the deadline that count, and the length of a slot in hours.
SPAN, SLOT = 12, 4
RC = (
    f"sn AS (SELECT grp, day, key, i, o, rank() OVER (PARTITION BY grp, day, i ORDER BY o)::INT AS r FROM (SELECT grp, day, key, dense_rank() OVER (PARTITION BY grp, day ORDER BY slot)::INT AS i, o FROM (SELECT grp, day, key, hour(ts) // {SLOT} AS slot, arg_max(value, (ts, id)) AS o FROM tk WHERE ts >= deadline - INTERVAL {SPAN} HOUR GROUP BY 1, 2, 3, 4)))",
    "rc AS (SELECT * FROM (SELECT *, lag(i) OVER w AS pi, lag(o) OVER w AS o0, lag(r) OVER w AS r0 FROM sn WINDOW w AS (PARTITION BY grp, day, key ORDER BY i)) WHERE pi = i - 1 AND o0 > 0 AND o > 0 AND r <= 5 AND o <= 0.5 * o0 + 1e-9)",
)


def ranked(spark, d):
    late = ticks(spark, d).filter(F.col("ts") >= F.col("deadline") - F.expr(f"INTERVAL {SPAN} HOUR"))
    return tk.ranked_collapses(tk.slots(late, ["grp", "day"], "key", F.floor(F.hour("ts") / SLOT)), ["grp", "day"], "key")


@query("T5_ranked_collapses", with_tk("SELECT grp, day, key, i, o0, r0, o, r FROM rc", *RC))
def ranked_collapses(spark, d):
    """Halved values among the five best of a slot, against the slot right before, in the last hours before the deadline."""
    return ranked(spark, d).select("grp", "day", "key", "i", "o0", "r0", "o", "r")


T6 = (
    "it AS (SELECT grp, day, key, min(o / o0) AS ratio FROM rc GROUP BY 1, 2, 3)",
    "cd AS (SELECT grp, day, count(*) AS keys, arg_min(key, (ratio, key)) AS best_key, round(min(ratio), 6) AS best FROM it GROUP BY 1, 2)",
    "sp AS (SELECT grp, day, sum(c)::BIGINT AS steps, arg_max(i, (c, i)) AS step FROM (SELECT grp, day, i, count(*) AS c FROM rc GROUP BY 1, 2, 3) GROUP BY 1, 2)",
    "mb AS (SELECT grp, day, m, count(*) AS c FROM (SELECT grp, day, unnest([key % 8, 8 + key % 5]) AS m FROM it) GROUP BY 1, 2, 3)",
    "fo AS (SELECT grp, day, string_agg(m, ',' ORDER BY c DESC, m) AS focus FROM (SELECT *, row_number() OVER (PARTITION BY grp, day ORDER BY c DESC, m) AS k FROM mb JOIN cd USING (grp, day)) WHERE 2 * c >= keys OR k = 1 GROUP BY 1, 2)",
    "fr AS (SELECT grp, day, string_agg(key, ',' ORDER BY v, key) AS result FROM (SELECT *, row_number() OVER (PARTITION BY grp, day ORDER BY v, key) AS k FROM (SELECT grp, day, key, arg_max(value, (ts, id)) AS v FROM tk GROUP BY 1, 2, 3)) WHERE k <= 3 GROUP BY 1, 2 HAVING count(*) = 3)",
)


@query("T6_focus_cards", with_tk("SELECT grp, day, keys, best_key, best, steps, step, focus, result FROM cd JOIN sp USING (grp, day) JOIN fo USING (grp, day) LEFT JOIN fr USING (grp, day)", *RC, *T6))
def focus_cards(spark, d):
    """A card for each group-day with collapses: the best one, the step that has most (the later of equals), members in
    half of the keys or more (else the one in most), and the first three of the final values if there are three.

    A key stands for the pair of its members key % 8 and 8 + key % 5.
    """
    by = ["grp", "day"]
    rc = ranked(spark, d)
    items = rc.groupBy(*by, "key").agg(F.min(F.col("o") / F.col("o0")).alias("ratio"))
    card = items.groupBy(*by).agg(F.count("*").alias("keys"), F.min_by("key", F.struct("ratio", "key")).alias("best_key"), F.round(F.min("ratio"), 6).alias("best"))
    steps = rc.groupBy(*by, "i").agg(F.count("*").alias("c")).groupBy(*by).agg(F.sum("c").alias("steps"), F.max_by("i", F.struct("c", "i")).alias("step"))
    members = items.select(*by, F.explode(F.array(F.col("key") % 8, 8 + F.col("key") % 5)).alias("m")).groupBy(*by, "m").agg(F.count("*").alias("c"))
    joined = lambda rows, sort, what, name: rows.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*sort))), lambda s: s[what].cast("string")), ",").alias(name), F.count("*").alias("__n"))
    k = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("c"), "m"))
    focus = members.join(card.select(*by, "keys"), by).withColumn("k", k).filter("2 * c >= keys OR k = 1")
    final = tk.final_values(ticks(spark, d), [*by, "key"]).withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy("final", "key"))).filter("k <= 3")
    out = card.join(steps, by).join(joined(focus, ("k", "m"), "m", "focus").drop("__n"), by)
    return out.join(joined(final, ("k", "key"), "key", "result").filter("__n = 3").drop("__n"), by, "left")


NEAR = (240, 60, 10)


@query("T7_thinned", with_tk("SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY grp, day ORDER BY ts, id) AS a, row_number() OVER (PARTITION BY grp, day ORDER BY ts DESC, id DESC) AS b, " + ", ".join(f"row_number() OVER (PARTITION BY grp, day ORDER BY abs(minutes_left - {m}), ts, id) AS c{m}" for m in NEAR) + " FROM tm) WHERE a = 1 OR b = 1 OR " + " OR ".join(f"c{m} = 1" for m in NEAR), ML))
def thinned(spark, d):
    return tk.thin(open_ticks(spark, d), ["grp", "day"], NEAR).select("id")


LATE = "lm AS (SELECT grp, day, key, arg_max(value, (ts, id)) AS final, arg_max(value, (ts, id)) FILTER (WHERE minutes_left >= 60) AS mid FROM tm GROUP BY 1, 2, 3), lp AS (SELECT *, (1 / (final + 1)) / sum(1 / (final + 1)) OVER (PARTITION BY grp, day) AS pf, (1 / (mid + 1)) / sum(1 / (mid + 1)) OVER (PARTITION BY grp, day) AS pm FROM lm WHERE mid IS NOT NULL)"


def late_pairs(spark, d):
    """Final and mid value of each key with both implied probabilities, normalised within the group-day."""
    t = open_ticks(spark, d)
    order = F.struct("ts", "id")
    g = t.groupBy("grp", "day", "key").agg(F.max_by("value", order).alias("final"), F.max_by("value", F.when(F.col("minutes_left") >= 60, order)).alias("mid"))
    w = Window.partitionBy("grp", "day")
    share = lambda c: (1 / (F.col(c) + 1)) / F.sum(1 / (F.col(c) + 1)).over(w)
    return g.filter("mid IS NOT NULL").select("*", share("final").alias("pf"), share("mid").alias("pm"))


@query("T8_late_shift", with_tk(f"SELECT grp, day, count(*) AS n, {hu('sum(abs(pf - pm)) / 2')} AS variation, count(*) FILTER (WHERE pf / pm >= 1.3) AS up FROM lp GROUP BY 1, 2", ML, LATE))
def late_shift(spark, d):
    return late_pairs(spark, d).groupBy("grp", "day").agg(F.count("*").alias("n"), half_up(F.sum(F.abs(F.col("pf") - F.col("pm"))) / 2).alias("variation"), F.count_if(F.col("pf") / F.col("pm") >= 1.3).alias("up"))


@query("T9_early_triples", with_tk("SELECT grp, day, arg_min(value, (ts, id)) AS first, arg_max(value, (ts, id)) FILTER (WHERE minutes_left >= 240) AS middle, arg_max(value, (ts, id)) FILTER (WHERE minutes_left >= 10) AS preclose FROM tm GROUP BY 1, 2", ML))
def early_triples(spark, d):
    order = F.struct("ts", "id")
    last = lambda m: F.max_by("value", F.when(F.col("minutes_left") >= m, order))
    return open_ticks(spark, d).groupBy("grp", "day").agg(F.min_by("value", order).alias("first"), last(240).alias("middle"), last(10).alias("preclose"))


@query("T10_marginals", with_tk(f"SELECT grp, key, {hu('s / sum(s) OVER (PARTITION BY grp)', 6)} AS share FROM (SELECT grp, key, sum(1 / (value + 1)) AS s FROM tk GROUP BY 1, 2)"))
def marginals(spark, d):
    g = ticks(spark, d).groupBy("grp", "key").agg(F.sum(1 / (F.col("value") + 1)).alias("s"))
    return g.select("grp", "key", half_up(F.col("s") / F.sum("s").over(Window.partitionBy("grp")), 6).alias("share"))


@query("T11_latest", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def latest(spark, d):
    e = table(spark, d, "events")
    return tk.latest(e, ["user_id"], ["event_id", "value"], ("ts", "event_id"))


@query("T11_latest_stream", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def latest_stream(spark, d):
    out = jobs._out(spark, "latest")
    jobs.latest_state(jobs.read_ticks(spark, f"{d}/events.parquet"), out)
    return jobs.read_latest(spark, out).select("user_id", "event_id", "value")


HOURS = "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2"


@query("T12_windows", HOURS)
def windows(spark, d):
    return tk.tumbling(table(spark, d, "events"), "1 hour", ["event_type"]).drop("total")


@query("T12_windows_stream", HOURS + " HAVING start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)")
def windows_stream(spark, d):
    out = jobs._out(spark, "windows")
    jobs.drain(jobs.windowed_counts(jobs.read_ticks(spark, f"{d}/events.parquet")), out)
    # Appended are the windows that the watermark has closed.
    return spark.read.parquet(out).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("T13_sliding", "SELECT start, event_type, count(*) AS n FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE AS start, event_type FROM events, (VALUES (0), (1)) v(k)) GROUP BY 1, 2")
def sliding(spark, d):
    return tk.tumbling(table(spark, d, "events"), "1 hour", ["event_type"], slide="30 minutes").drop("total")


@query("T13_sessions", "SELECT min(ts) AS start, user_id, count(*) AS n FROM (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS f FROM events)) GROUP BY user_id, s")
def sessions(spark, d):
    return tk.sessions(table(spark, d, "events"), "30 minutes", ["user_id"]).drop("end")


@query("T13_sessions_stream", 'SELECT min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", user_id, count(*) AS n FROM (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS f FROM events)) GROUP BY user_id, s HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)')
def sessions_stream(spark, d):
    out = jobs._out(spark, "sessions")
    jobs.drain(jobs.session_counts(jobs.read_ticks(spark, f"{d}/events.parquet")), out)
    # Appended are the sessions that the watermark has closed.
    plain = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return spark.read.parquet(out).select(plain("start"), plain("end"), "user_id", "n")


@query("T14_first_write_wins", "SELECT user_id, ts::DATE AS day, arg_min(event_id, (ts, event_id)) AS event_id FROM events JOIN (SELECT ts::DATE AS day, max(ts) AS deadline FROM events GROUP BY 1) d ON d.day = ts::DATE WHERE ts <= deadline - INTERVAL 15 MINUTE GROUP BY 1, 2")
def first_write_wins(spark, d):
    e = table(spark, d, "events")
    deadlines = e.groupBy(F.col("ts").cast("date").alias("day")).agg(F.max(F.col("ts").cast("timestamp")).alias("deadline"))
    out = jobs._out(spark, "first")
    jobs.first_write_wins(jobs.read_ticks(spark, f"{d}/events.parquet"), deadlines, out)
    return spark.read.parquet(out).select("user_id", "day", "event_id")


@query("T15_notify", "SELECT subscriber, event_id, event_type, row_number() OVER (PARTITION BY subscriber ORDER BY event_id) <= 50 AS sent FROM events JOIN (SELECT DISTINCT event_type, user_id % 7 AS subscriber FROM events WHERE user_id % 3 = 0) USING (event_type)")
def notify(spark, d):
    out = jobs._out(spark, "notify")
    subscribers = table(spark, d, "events").filter("user_id % 3 = 0").select("event_type", (F.col("user_id") % 7).alias("subscriber")).distinct()
    jobs.notify(jobs.read_ticks(spark, f"{d}/events.parquet"), subscribers, out, cap=50)
    g = spark.read.parquet(out).groupBy("subscriber", "event_id", "event_type")
    return g.agg(F.bool_or("sent").alias("sent"))


@query("T15_baselines", """WITH subs AS (SELECT user_id % 7 AS subscriber, event_type, event_id AS created, ts AS since, user_id % 2 = 0 AS silent FROM events WHERE user_id % 3 = 0 AND event_id % 40 = 0),
  held AS (SELECT subscriber, event_type, arg_max(since, created) AS since, arg_max(silent, created) AS silent FROM subs GROUP BY 1, 2)
  SELECT subscriber, event_id, event_type, silent, NOT silent AND row_number() OVER (PARTITION BY subscriber, silent ORDER BY event_id) <= 50 AS sent FROM events JOIN held USING (event_type) WHERE ts > since""")
def notify_baselines(spark, d):
    """Subscriptions with a time from which ticks are new, a silent mode, and several for a device, of which the last counts."""
    out = jobs._out(spark, "notify")
    e = table(spark, d, "events").filter("user_id % 3 = 0 AND event_id % 40 = 0")
    subs = e.select((F.col("user_id") % 7).alias("subscriber"), "event_type", F.col("event_id").alias("created"), F.col("ts").cast("timestamp").alias("since"), (F.col("user_id") % 2 == 0).alias("silent"))
    jobs.notify(jobs.read_ticks(spark, f"{d}/events.parquet"), subs, out, cap=50)
    return spark.read.parquet(out).groupBy("subscriber", "event_id", "event_type").agg(F.bool_or("silent").alias("silent"), F.bool_or("sent").alias("sent"))


@query("T16_heartbeat", "SELECT event_type, max(ts) AS last, date_diff('day', max(ts)::DATE, (SELECT max(ts) FROM events)::DATE)::INT AS idle_days, max(ts) + INTERVAL 6 HOUR < (SELECT max(ts) FROM events) AS due FROM events GROUP BY 1")
def heartbeat(spark, d):
    e = table(spark, d, "events")
    newest = e.agg(F.max("ts").alias("newest"))
    g = e.groupBy("event_type").agg(F.max("ts").alias("last")).crossJoin(F.broadcast(newest))  # one row
    return g.select("event_type", "last", F.datediff(F.col("newest").cast("date"), F.col("last").cast("date")).alias("idle_days"), F.expr("last + INTERVAL 6 HOUR < newest").alias("due"))


@query("T17_observations", f"SELECT o_orderkey AS event, count(e.event_id) AS n, {hu('avg(e.value)')} AS mean FROM orders LEFT JOIN events e ON day(e.ts) = day(o_orderdate) AND hour(e.ts) IN (10, 11, 12) AND e.value BETWEEN 5 AND 95 GROUP BY 1")
def observations(spark, d):
    e = table(spark, d, "events").filter(F.hour("ts").isin(10, 11, 12) & F.col("value").between(5, 95))
    days = e.groupBy(F.dayofmonth("ts").alias("dom")).agg(F.count("*").alias("n"), half_up(F.avg("value")).alias("mean"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("event"), F.dayofmonth("o_orderdate").alias("dom"))
    return o.join(days, "dom", "left").select("event", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "mean")


SEGMENT = "CASE WHEN ts < deadline - INTERVAL 12 HOURS THEN 'early' WHEN ts < deadline - INTERVAL 3 HOURS THEN 'day' WHEN ts < deadline - INTERVAL 1 HOURS THEN 'late' ELSE 'final' END"
BAND = "CASE WHEN o < 3 THEN 'short' WHEN o < 8 THEN 'mid' ELSE 'long' END"
E10_SEGMENTS = (
    f"eo AS (SELECT grp, day, date_diff('day', DATE '2024-01-01', day)::INT AS d, key, id, ts, deadline, 1 + value / 10 AS o, {SEGMENT} AS segment FROM tk)",
    f"es AS (SELECT *, {BAND} AS band FROM (SELECT grp, day, d, key, segment, arg_max(o, (ts, id)) AS o FROM eo GROUP BY 1, 2, 3, 4, 5 UNION ALL SELECT grp, day, d, key, 'first', arg_min(o, (ts, id)) FROM eo GROUP BY 1, 2, 3, 4))",
    "ew AS (SELECT grp, day, any_value(key) AS key, any_value(payout) AS payout FROM (SELECT grp, day, key, arg_max(o, (ts, id)) AS payout, max(ts) = any_value(deadline) AS won FROM eo GROUP BY 1, 2, 3) WHERE won GROUP BY 1, 2 HAVING count(*) = 1)",
    "ec AS (SELECT a.segment, a.band, a.d, count(*) AS n, median(b.ratio) AS coef FROM (SELECT DISTINCT segment, band, d FROM es) a JOIN (SELECT segment, band, d, payout / o AS ratio FROM es JOIN ew USING (grp, day, key)) b ON a.segment = b.segment AND a.band = b.band AND b.d BETWEEN a.d - 14 AND a.d - 1 GROUP BY 1, 2, 3 HAVING count(*) >= 3)",
)


def _segment_prices(spark, d):
    """(prices, winners): odds of each member in each segment with their band; the one member seen at the deadline and its closing odds."""
    rows = ticks(spark, d).withColumn("o", 1 + F.col("value") / 10).withColumn("d", F.datediff("day", F.lit("2024-01-01").cast("date")))
    key = ["grp", "day", "d", "key"]
    o = F.col("o")
    prices = tk.segment_values(rows, key, F.expr(SEGMENT), value="o").withColumn("band", F.when(o < 3, "short").when(o < 8, "mid").otherwise("long"))
    ends = rows.groupBy(*key).agg(F.max_by("o", F.struct("ts", "id")).alias("payout"), (F.max("ts") == F.first("deadline")).alias("won"))
    one = ends.filter("won").groupBy("grp", "day").agg(F.count("*").alias("n"), F.first("key").alias("key"), F.first("payout").alias("payout"))
    return prices, one.filter("n = 1").drop("n")


def _segment_coefficients(prices, winners):
    paid = prices.join(winners, ["grp", "day", "key"]).withColumnRenamed("o", "price")
    return payout_coefficients(prices, paid, by=["segment", "band"], day="d", days=14, least=3)


@query("E10_coefficients", with_tk(f"SELECT segment, band, d, n, {hu('coef')} AS coef FROM ec", *E10_SEGMENTS))
def segment_coefficients(spark, d):
    """Median of payout over odds by time segment (and the first tick) and odds band, from the 14 days before each day."""
    return _segment_coefficients(*_segment_prices(spark, d)).withColumn("coef", half_up(F.col("coef")))


@query("E10_segment_bets", with_tk(f"SELECT segment, band, count(*) AS bets, count(w.key) AS hits, count(*) * 100 AS stake, {hu('coalesce(sum(100 * w.payout), 0)', 2)} AS back FROM (SELECT s.*, p * o * coef AS ev FROM es s JOIN ec USING (segment, band, d) JOIN (SELECT grp, day, key, 1 / o / sum(1 / o) OVER (PARTITION BY grp, day) AS p FROM es WHERE segment = 'first') USING (grp, day, key)) b LEFT JOIN ew w USING (grp, day, key) WHERE floor(ev * 1e6 + 0.500001) >= 200000 GROUP BY 1, 2", *E10_SEGMENTS))
def segment_bets(spark, d):
    """Bets whose expected value by the day's coefficient reaches a fifth: stakes and returns by segment and band.

    The probability is the one that the first odds imply; only events with one winner pay."""
    prices, winners = _segment_prices(spark, d)
    coef = _segment_coefficients(prices, winners).select("segment", "band", "d", "coef")
    p = (1 / F.col("o")) / F.sum(1 / F.col("o")).over(Window.partitionBy("grp", "day"))
    first = prices.filter("segment = 'first'").select("grp", "day", "key", p.alias("p"))
    bets = prices.join(coef, ["segment", "band", "d"]).join(first, ["grp", "day", "key"])
    bets = bets.filter(F.floor(F.col("p") * F.col("o") * F.col("coef") * 1e6 + 0.500001) >= 200000)
    out = bets.join(winners.withColumn("won", F.lit(True)), ["grp", "day", "key"], "left")
    back = half_up(F.coalesce(F.sum(100 * F.col("payout")), F.lit(0.0)), 2)
    return out.groupBy("segment", "band").agg(F.count("*").alias("bets"), F.count("won").alias("hits"), (F.count("*") * 100).alias("stake"), back.alias("back"))


@query("T17_around", f"""WITH ob AS (SELECT user_id % 25 AS station, event_id, event_type, epoch_us(ts) // 1000000 AS t, value FROM events)
  SELECT e.event_id AS event, count(o.t) AS n, {hu('(sum(o.value::DECIMAL(28, 6)) / count(o.t))::DOUBLE')} AS mean FROM ob e LEFT JOIN ob o ON o.station = e.station AND o.event_type <> 'purchase' AND o.value BETWEEN 5 AND 95 AND (o.t // 3600) % 24 BETWEEN 8 AND 19 AND o.t BETWEEN e.t - 1800 AND e.t + 3600 WHERE e.event_type = 'purchase' GROUP BY 1""")
def observations_around(spark, d):
    """Observations of an event's station from half an hour before to an hour after it: sound values of daytime hours only."""
    e = table(spark, d, "events").select((F.col("user_id") % 25).alias("station"), "event_id", "event_type", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"), "value")
    points = e.filter((F.col("event_type") != "purchase") & F.col("value").between(5, 95) & (F.floor(F.col("t") / 3600) % 24).between(8, 19))
    out = asof.around(e.filter("event_type = 'purchase'"), points, by=["station"], key=["event_id"], at="t", value="value", before=1800, after=3600)
    return out.select(F.col("event_id").alias("event"), "n", half_up((F.col("total") / F.col("n")).cast("double")).alias("mean"))
