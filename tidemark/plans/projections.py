"""Queries of the P family: predicates, codings, bands and array expressions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import exprs as x
from .demo import participations, query, table, with_pt


@query("P1_ran", with_pt("SELECT event, runner_no, status <> 'O' OR finish = 1 AS ran FROM pt WHERE NOT regexp_matches(class, 'ECONOMY|SMALL')"))
def ran(spark, d):
    p = participations(spark, d).filter(~F.col("class").rlike("ECONOMY|SMALL"))
    finish = F.when((F.col("status") != "O") | (F.col("finish") == 1), F.col("finish"))
    return p.select("event", "runner_no", x.ran(finish, F.col("status")).alias("ran"))


@query("P2_ordinal", """SELECT o_orderkey AS event, CASE substr(o_orderpriority, 3) WHEN 'URGENT' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3
  WHEN 'LOW' THEN 4 END::INT AS code FROM orders""")
def ordinal(spark, d):
    code = x.ordinal(F.substring("o_orderpriority", 3, 99), ["URGENT", "HIGH", "MEDIUM", "LOW"])
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("event"), code.alias("code"))


WORDS = {"nose": 0.05, "head": 0.2, "neck": 0.3, "far": 20.0}


@query("P3_margin", """SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN 0.2 WHEN 1 THEN p_size::DOUBLE
  WHEN 2 THEN round(p_size::DOUBLE / ((p_partkey % 3) + 2), 6) WHEN 3 THEN round(1 + 1.0 / ((p_partkey % 3) + 2), 6) END::DOUBLE AS margin FROM part""")
def margin(spark, d):
    den = (F.col("p_partkey") % 3 + 2).cast("string")
    text = (
        F.when(F.col("p_partkey") % 5 == 0, "head")
        .when(F.col("p_partkey") % 5 == 1, F.col("p_size").cast("string"))
        .when(F.col("p_partkey") % 5 == 2, F.concat_ws("/", F.col("p_size").cast("string"), den))
        .when(F.col("p_partkey") % 5 == 3, F.concat(F.lit("1.1/"), den))
        .otherwise("unknown")
    )
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.round(x.margin_to_number(text, WORDS), 6).alias("margin"))


@query("P4_clock", """SELECT event_id AS id, (extract(hour FROM ts) * 60 + extract(minute FROM ts))::INT AS minutes,
  (extract(minute FROM ts) * 60 + extract(second FROM ts)::INT)::DOUBLE AS seconds FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)""")
def clock(spark, d):
    e = table(spark, d, "events")
    hhmm = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "HHmm")).otherwise(F.date_format("ts", "HH:mm"))
    return e.select(F.col("event_id").alias("id"), x.clock_minutes(hhmm).alias("minutes"), x.clock_seconds(F.date_format("ts", "m:ss")).alias("seconds"))


@query("P5_text_keys", """SELECT n_nationkey AS id, lpad(n_nationkey::VARCHAR, 3, '0') AS code, left(trim(n_name), 4) AS short,
  nullif(n_regionkey, 0) AS region, coalesce(nullif(n_name, 'JAPAN'), '?') AS name FROM nation""")
def text_keys(spark, d):
    return table(spark, d, "nation").select(
        F.col("n_nationkey").alias("id"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("code"),
        F.left(F.btrim("n_name"), F.lit(4)).alias("short"), F.nullif(F.col("n_regionkey"), F.lit(0)).alias("region"),
        F.coalesce(F.nullif(F.col("n_name"), F.lit("JAPAN")), F.lit("?")).alias("name"),
    )


@query("P6_half_up", "SELECT p_partkey AS id, (floor((p_size * 10 + 100) / 200.0) * 200)::BIGINT AS band FROM part")
def half_up(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), x.half_up(F.col("p_size") * 10, 200).cast("long").alias("band"))


@query("P7_bands", """SELECT CASE WHEN l_quantity < 10 THEN 'a' WHEN l_quantity < 25 THEN 'b' WHEN l_quantity < 40 THEN 'c' ELSE 'd' END AS band,
  count(*) AS n, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1""")
def bands(spark, d):
    band = x.band(F.col("l_quantity"), [10, 25, 40], ["a", "b", "c", "d"]).alias("band")
    return table(spark, d, "lineitem").groupBy(band).agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean"))


def event_arrays(spark, d):
    """Measures of an event in running order, as one array."""
    rows = participations(spark, d).groupBy("event").agg(F.sort_array(F.collect_list(F.struct("runner_no", "measure"))).alias("s"))
    return rows.select("event", F.col("s.measure").alias("a"))


ARR = "ar AS (SELECT event, list(measure ORDER BY runner_no) AS a FROM pt GROUP BY event)"


@query("P8_array_at", with_pt("SELECT event, a[1] AS first, a[4] AS fourth FROM ar", ARR))
def array_at(spark, d):
    return event_arrays(spark, d).select("event", x.at(F.col("a"), 0).alias("first"), x.at(F.col("a"), 3).alias("fourth"))


@query("P9_halves", with_pt("""SELECT event, CASE WHEN len(a) >= 4 THEN round(list_avg(a[1:len(a)//2]), 6) END AS first_half,
  CASE WHEN len(a) >= 4 THEN round(list_avg(a[len(a)//2 + 1:]), 6) END AS second_half, CASE WHEN len(a) >= 4 THEN a[-1] - list_min(a) END AS over_least FROM ar""", ARR))
def halves(spark, d):
    a, b, c = x.halves(F.col("a"), 4)
    return event_arrays(spark, d).select("event", F.round(a, 6).alias("first_half"), F.round(b, 6).alias("second_half"), c.alias("over_least"))


LAG5 = """lg AS (SELECT entity, event, lag(price, 1) OVER w AS p1, lag(price, 2) OVER w AS p2, lag(price, 3) OVER w AS p3, lag(price, 4) OVER w AS p4, lag(price, 5) OVER w AS p5
  FROM oh WINDOW w AS (PARTITION BY entity ORDER BY d_idx, event))"""


def lagged(spark, d):
    from .demo import order_history

    w = Window.partitionBy("entity").orderBy("d_idx", "event")
    return order_history(spark, d).select("entity", "event", *[F.lag("price", i).over(w).alias(f"p{i}") for i in range(1, 6)])


def _with_oh(body, *more):
    from .demo import with_oh

    return with_oh(body, *more)


@query("P10_row_stats", _with_oh("""SELECT l.entity, l.event, count(y) AS n, round(avg(y), 4) AS mean,
  CASE WHEN count(y) >= 2 THEN round(stddev_pop(y), 4) END AS std, CASE WHEN count(y) >= 2 THEN round(regr_slope(y, k), 4) END AS slope
  FROM lg l, LATERAL (VALUES (-1.0::DOUBLE, p1), (-2.0::DOUBLE, p2), (-3.0::DOUBLE, p3), (-4.0::DOUBLE, p4), (-5.0::DOUBLE, p5)) AS v(k, y) GROUP BY 1, 2""", LAG5))
def row_stats(spark, d):
    s = x.row_stats([F.col(f"p{i}") for i in range(1, 6)])
    return lagged(spark, d).select(
        "entity", "event", s["n"].cast("long").alias("n"), *[F.round(s[k], 4).alias(k) for k in ("mean", "std", "slope")]
    )


@query("P11_extremes", _with_oh("SELECT entity, event, greatest(p1, p2, p3) AS most, least(p1, p2, p3) AS fewest FROM lg", LAG5))
def extremes(spark, d):
    return lagged(spark, d).select("entity", "event", F.greatest("p1", "p2", "p3").alias("most"), F.least("p1", "p2", "p3").alias("fewest"))


def payouts(spark, d):
    """D-PAY: per event an array of {t, c, y} for the first three finishers."""
    p = participations(spark, d).filter("finish <= 3")
    kind = F.when(F.col("finish") == 1, "win").otherwise("place")
    item = F.struct(kind.alias("t"), F.col("runner_no").alias("c"), F.round("price").alias("y"))
    return p.groupBy("event").agg(F.collect_list(item).alias("items"))


@query("P12_payout", with_pt("""SELECT event, runner_no, CASE WHEN finish = 1 THEN round(price) ELSE 0 END AS win,
  CASE WHEN finish IN (2, 3) THEN round(price) ELSE 0 END AS place FROM pt"""))
def payout(spark, d):
    rows = participations(spark, d).select("event", "runner_no").join(payouts(spark, d), "event")
    return rows.select("event", "runner_no", *[x.payout(F.col("items"), k, F.col("runner_no")).alias(k) for k in ("win", "place")])


@query("P13_tied_share", with_pt("""SELECT event, runner_no, round(coalesce((SELECT sum(v) FROM (VALUES (1, 100.0), (2, 60.0), (3, 30.0), (4, 10.0)) z(i, v)
  WHERE i BETWEEN r AND r + n - 1), 0) / n, 6)::DOUBLE AS prize FROM (SELECT event, runner_no, rank() OVER (PARTITION BY event ORDER BY measure DESC) AS r, count(*) OVER (PARTITION BY event, measure) AS n FROM pt)"""))
def tied_share(spark, d):
    w = Window.partitionBy("event").orderBy(F.desc("measure"))
    rows = participations(spark, d).withColumn("r", F.rank().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("event", "measure")))
    prizes = F.array(*map(F.lit, (100.0, 60.0, 30.0, 10.0)))
    return rows.select("event", "runner_no", F.round(x.tied_share(prizes, F.col("r"), F.col("n").cast("int")), 6).alias("prize"))


@query("P14_fiscal", """SELECT o_orderkey AS event, (year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END)::INT AS fiscal_year,
  CASE WHEN month(o_orderdate) BETWEEN 4 AND 9 THEN 1 ELSE 2 END::INT AS half, (o_orderdate::DATE - INTERVAL 6 MONTH)::DATE AS since FROM orders""")
def fiscal(spark, d):
    day = F.col("o_orderdate").cast("date")
    half = F.when(F.month(day).between(4, 9), 1).otherwise(2)
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("event"), x.fiscal_year(day).alias("fiscal_year"), half.alias("half"), F.add_months(day, -6).alias("since")
    )


@query("P15_calendar", """SELECT o_orderkey AS event, (o_orderdate::DATE - dayofweek(o_orderdate)::INT)::DATE AS week, date_trunc('month', o_orderdate)::DATE AS month,
  last_day(o_orderdate::DATE) AS month_end, (o_orderdate::DATE - INTERVAL 1 YEAR)::DATE AS year_before FROM orders""")
def calendar(spark, d):
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("event"), x.week_start(day).alias("week"), F.trunc(day, "month").alias("month"),
        F.last_day(day).alias("month_end"), F.add_months(day, -12).alias("year_before"),
    )


@query("P16_lenient_cast", """SELECT event_id AS id, try_cast(json_extract_string(props, '$.k') AS INT) AS k,
  try_cast(CASE WHEN event_id % 3 = 0 THEN 'x' || event_id ELSE event_id::VARCHAR END AS BIGINT) AS n FROM events""")
def lenient_cast(spark, d):
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("x"), F.col("event_id"))).otherwise(F.col("event_id").cast("string"))
    return table(spark, d, "events").select(
        F.col("event_id").alias("id"), F.get_json_object("props", "$.k").try_cast("int").alias("k"), text.try_cast("bigint").alias("n")
    )


@query("P17_json", """SELECT event_id AS id, k.key AS name, json_extract_string(props, '$.' || k.key) AS val
  FROM events, LATERAL (SELECT unnest(json_keys(props)) AS key) k""")
def json_each(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("id"), F.from_json("props", "map<string,string>").alias("m"))
    return e.select("id", F.explode("m").alias("name", "val"))


@query("P18_string_keys", """SELECT p_partkey AS id, concat_ws('|', p_brand, p_type, p_size) AS key, string_split(p_type, ' ')[1] AS head,
  regexp_replace(p_name, '\\s+', '_', 'g') AS name FROM part WHERE p_name ILIKE '%e%'""")
def string_keys(spark, d):
    p = table(spark, d, "part").filter(F.col("p_name").ilike("%e%"))
    return p.select(
        F.col("p_partkey").alias("id"), F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string")).alias("key"),
        F.get(F.split("p_type", " "), 0).alias("head"), F.regexp_replace("p_name", r"\s+", "_").alias("name"),
    )


RULES = [("^PROMO", "promotion"), ("(STEEL|TIN)$", "light"), ("BRUSHED|POLISHED", "finished"), ("^STANDARD", "plain")]


@query("P20_rules", """SELECT p_partkey AS id, CASE WHEN regexp_matches(p_type, '^PROMO') THEN 'promotion' WHEN regexp_matches(p_type, '(STEEL|TIN)$') THEN 'light'
  WHEN regexp_matches(p_type, 'BRUSHED|POLISHED') THEN 'finished' WHEN regexp_matches(p_type, '^STANDARD') THEN 'plain' ELSE 'other' END AS label FROM part""")
def rules(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), x.first_rule(F.col("p_type"), RULES, "other").alias("label"))


def order_strings(spark, d):
    """D-ORD: runner numbers in order of measure, ties in parentheses, groups joined by dashes."""
    groups = participations(spark, d).groupBy("event", "measure").agg(F.sort_array(F.collect_list("runner_no")).alias("ids"))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    text = F.when(F.size("ids") > 1, F.concat(F.lit("("), joined, F.lit(")"))).otherwise(joined)
    out = groups.groupBy("event").agg(F.array_sort(F.collect_list(F.struct((-F.col("measure")).alias("m"), text.alias("t")))).alias("s"))
    return out.select("event", F.array_join("s.t", "-").alias("text"))


@query("P21_ordered_groups", with_pt("SELECT event, runner_no AS id, rank() OVER (PARTITION BY event ORDER BY measure DESC)::INT AS rank FROM pt"))
def ordered_groups(spark, d):
    return order_strings(spark, d).select("event", F.inline(x.ordered_groups(F.col("text"))))


@query("P22_slots", with_pt("""SELECT event, ids[1] AS first, CASE WHEN n >= 3 THEN ids[2] END AS second, CASE WHEN n >= 2 THEN ids[n - 1] END AS second_last, ids[n] AS last
  FROM (SELECT event, list(runner_no ORDER BY popularity) AS ids, count(*) AS n FROM pt WHERE going <> 'A' GROUP BY event)"""))
def slots(spark, d):
    value = F.when(F.col("going") != "A", F.col("runner_no"))
    rows = participations(spark, d).groupBy("event").agg(F.array_sort(F.collect_list(F.struct("popularity", value.alias("v")))).alias("s"))
    rows = rows.select("event", F.col("s.v").alias("v")).filter(F.exists("v", lambda v: v.isNotNull()))
    return rows.select("event", *[x.slot(F.col("v"), n).alias(n) for n in ("first", "second", "second_last", "last")])


@query("P23_text_interval", """SELECT o_orderkey AS event, CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate::DATE ELSE date_trunc('month', o_orderdate)::DATE END AS since,
  CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate::DATE WHEN o_orderkey % 4 = 1 THEN last_day(o_orderdate::DATE)
  WHEN o_orderkey % 4 = 2 THEN make_date(year(o_orderdate), 12, 31) ELSE last_day((o_orderdate::DATE + INTERVAL 3 MONTH)::DATE) END AS until FROM orders""")
def text_interval(spark, d):
    day = F.col("o_orderdate").cast("date")
    month = F.date_format(day, "yyyy-MM")
    k = F.col("o_orderkey") % 4
    text = (
        F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, month).when(k == 2, F.concat(month, F.lit("~12")))
        .otherwise(F.concat(month, F.lit("~"), F.date_format(F.add_months(day, 3), "yyyy-MM")))
    )
    since, until = x.text_interval(text)
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("event"), since.alias("since"), until.alias("until"))
