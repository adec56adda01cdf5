"""Queries of the J, O and U families."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import asof, stats
from .demo import order_history, participations, query, snapshots, table, ticks, with_oh, with_pt, with_snap, with_tk


@query("J1_equi", "SELECT l_orderkey AS event, count(*) AS n, round(sum(l_quantity), 4) AS total, min(o_orderstatus) AS status FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def equi(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy(F.col("l_orderkey").alias("event")).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("total"), F.min("o_orderstatus").alias("status"))


@query("J2_thin_windows", with_pt("SELECT event, runner_no, measure, round(avg(measure) OVER (PARTITION BY event), 6) AS event_mean, count(*) OVER (PARTITION BY event, going) AS same_going FROM pt"))
def thin_windows(spark, d):
    p = participations(spark, d)
    thin = p.select("event", "runner_no", "measure", "going")
    facts = thin.select(
        "event", "runner_no", F.round(F.avg("measure").over(Window.partitionBy("event")), 6).alias("event_mean"),
        F.count("*").over(Window.partitionBy("event", "going")).alias("same_going"),
    )
    return p.select("event", "runner_no", "measure").join(facts, ["event", "runner_no"])


SUPPLIER_DAYS = "sd AS (SELECT rider, d_idx, count(*) AS n, sum(measure) AS total FROM pt GROUP BY 1, 2)"


def supplier_days(p):
    return p.groupBy("rider", "d_idx").agg(F.count("*").alias("n"), F.sum("measure").alias("total"))


def _asof(op):
    return with_pt(f"""SELECT p.event, p.runner_no, s.n, s.total FROM pt p
      ASOF LEFT JOIN sd s ON p.rider = s.rider AND p.d_idx {op} s.d_idx""", SUPPLIER_DAYS)


@query("J3_asof_strict", _asof(">"))
def asof_strict(spark, d):
    p = participations(spark, d).select("event", "runner_no", "rider", "d_idx")
    return asof.asof_join(p, supplier_days(participations(spark, d)), by=["rider"], left_on="d_idx", right_on="d_idx", take=["n", "total"]).drop("rider", "d_idx")


@query("J3_asof_inclusive", _asof(">="))
def asof_inclusive(spark, d):
    p = participations(spark, d).select("event", "runner_no", "rider", "d_idx")
    return asof.asof_join(p, supplier_days(participations(spark, d)), by=["rider"], left_on="d_idx", right_on="d_idx", take=["n", "total"], inclusive=True).drop("rider", "d_idx")


@query("J4_asof_counts", with_oh("""SELECT a.event, count(b.event) AS n_90, (a.d_idx - max(c.last))::INT AS days_since FROM oh a
  LEFT JOIN oh b ON a.entity = b.entity AND b.d_idx BETWEEN a.d_idx - 90 AND a.d_idx - 1
  LEFT JOIN (SELECT x.event, max(y.d_idx) AS last FROM oh x JOIN oh y ON x.entity = y.entity AND y.d_idx < x.d_idx GROUP BY 1) c ON c.event = a.event
  GROUP BY a.event, a.d_idx"""))
def asof_counts(spark, d):
    o = order_history(spark, d)
    days = asof.day_buckets(o, ["entity"], "d_idx", {"n": F.lit(1)})
    before = Window.partitionBy("entity").orderBy("d_idx")
    days = asof.window_sums(days, ["entity"], "d_idx", ["n"], 90).withColumn("last", F.lag("d_idx").over(before))
    out = o.join(days, ["entity", "d_idx"])
    return out.select("event", F.coalesce("n_before", F.lit(0)).cast("long").alias("n_90"), (F.col("d_idx") - F.col("last")).alias("days_since"))


@query("J5_band", with_oh("SELECT a.event, count(*) AS n, round(sum(b.price), 2) AS spent FROM oh a JOIN oh b ON a.entity = b.entity AND b.d_idx < a.d_idx AND b.d_idx >= a.d_idx - 60 GROUP BY 1"))
def band(spark, d):
    o = order_history(spark, d)
    left, right = o.select("entity", "event", "d_idx"), o.select("entity", F.col("d_idx").alias("at"), "price")
    near = asof.band_join(left, right, by=["entity"], left_on="d_idx", right_on="at", days=60)
    return near.groupBy("event").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("spent"))


LIFE = "life AS (SELECT entity AS id, sire AS name, min(d_idx) AS born, max(d_idx) AS ended FROM pt GROUP BY 1, 2)"


def lives(p):
    return p.groupBy(F.col("entity").alias("id"), F.col("sire").alias("name")).agg(F.min("d_idx").alias("born"), F.max("d_idx").alias("ended"))


@query("J6_overlap", with_pt("SELECT a.id, count(*) - 1 AS n FROM life a JOIN life b ON a.name = b.name AND a.born <= b.ended AND b.born <= a.ended GROUP BY 1", LIFE))
def overlap(spark, d):
    """Namesakes whose life overlaps, counted without forming pairs: births up to my end less ends before my birth."""
    return asof.overlap_counts(lives(participations(spark, d)), ["name"], "id", "born", "ended")


@query("J7_null_safe", with_pt("SELECT going, n, m FROM (SELECT nullif(going, 'A') AS going, count(*) AS n FROM pt GROUP BY 1) JOIN (SELECT nullif(going, 'A') AS g2, max(measure) AS m FROM pt GROUP BY 1) ON going IS NOT DISTINCT FROM g2"))
def null_safe(spark, d):
    p = participations(spark, d).withColumn("going", F.nullif(F.col("going"), F.lit("A")))
    a = p.groupBy("going").agg(F.count("*").alias("n"))
    b = p.groupBy(F.col("going").alias("g2")).agg(F.max("measure").alias("m"))
    return a.join(b, F.col("going").eqNullSafe(F.col("g2"))).select("going", "n", "m")


@query("J8_semi_anti", "SELECT c_custkey AS id, 'without' AS kind FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) UNION ALL SELECT c_custkey, 'urgent' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')")
def semi_anti(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    on = F.col("c_custkey") == F.col("o_custkey")
    kind = lambda df, k: df.select(F.col("c_custkey").alias("id"), F.lit(k).alias("kind"))
    return kind(c.join(o, on, "left_anti"), "without").unionByName(kind(c.join(o.filter(F.col("o_orderpriority").startswith("1")), on, "left_semi"), "urgent"))


@query("J9_tuple_equality", with_pt("SELECT a.event, a.runner_no, b.finish FROM pt a JOIN pt b ON (a.event, a.runner_no, a.day) = (b.event, b.popularity, b.day)"))
def tuple_equality(spark, d):
    p = participations(spark, d)
    b = p.select("event", F.col("popularity").alias("runner_no"), "day", "finish")
    return p.select("event", "runner_no", "day").join(b, ["event", "runner_no", "day"]).drop("day")


@query("J10_small_cross", "SELECT o_orderkey AS event, k FROM orders, (VALUES ('all'), ('year')) v(k) UNION ALL SELECT o_orderkey, 'urgent' FROM orders WHERE o_orderpriority LIKE '1%'")
def small_cross(spark, d):
    kinds = F.array_compact(F.array(F.lit("all"), F.lit("year"), F.when(F.col("o_orderpriority").startswith("1"), F.lit("urgent"))))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("event"), F.explode(kinds).alias("k"))


@query("J11_search", with_pt("""SELECT event, count(DISTINCT k) AS kinds, count(*) AS hits FROM (
  SELECT event, 'class' AS k FROM pt WHERE class ILIKE '%steel%' UNION ALL SELECT event, 'sire' FROM pt WHERE sire LIKE '%1%' UNION ALL SELECT event, 'going' FROM pt WHERE going = 'R')
  GROUP BY 1 HAVING count(DISTINCT k) = 3"""))
def search(spark, d):
    """All of several (kind, filter) conditions on an event's participants: one scan, an array of the kinds that a row meets."""
    tests = {"class": F.col("class").ilike("%steel%"), "sire": F.col("sire").like("%1%"), "going": F.col("going") == "R"}
    met = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in tests.items()])))
    rows = participations(spark, d).select("event", met.alias("k"))
    return rows.groupBy("event").agg(F.count_distinct("k").alias("kinds"), F.count("*").alias("hits")).filter(F.col("kinds") == len(tests))


@query("J12_next_events", with_oh("SELECT event, lead(event, 1) OVER w AS next1, lead(event, 2) OVER w AS next2, lead(event, 3) OVER w AS next3 FROM oh WHERE status <> 'P' WINDOW w AS (PARTITION BY entity ORDER BY d_idx, event)"))
def next_events(spark, d):
    w = Window.partitionBy("entity").orderBy("d_idx", "event")
    rows = order_history(spark, d).filter("status <> 'P'")
    return rows.select("event", *[F.lead("event", k).over(w).alias(f"next{k}") for k in (1, 2, 3)])


PAIRS = "pr AS (SELECT a.event, a.d_idx, a.rider AS one, b.rider AS two, a.finish < b.finish AS won, b.finish - a.finish AS gap FROM pt a JOIN pt b ON a.event = b.event AND a.rider < b.rider)"


def pairs(p):
    """All pairs of different participants that met in an event, the smaller id first; events are small, so the self-join is by event."""
    a = p.select("event", "d_idx", F.col("rider").alias("one"), "finish")
    b = p.select("event", F.col("rider").alias("two"), F.col("finish").alias("finish2"))
    met = a.join(b, "event").filter("one < two")
    return met.select("event", "d_idx", "one", "two", (F.col("finish") < F.col("finish2")).alias("won"), (F.col("finish2") - F.col("finish")).alias("gap"))


#: Days within which a next event counts.
SOON = 400


@query("J12_next_until", with_oh(f"SELECT event, CASE WHEN d1 <= d_idx + {SOON} THEN n1 END AS next1, CASE WHEN d2 <= d_idx + {SOON} THEN n2 END AS next2, CASE WHEN d3 <= d_idx + {SOON} THEN n3 END AS next3, (coalesce(d1 <= d_idx + {SOON}, false)::INT + coalesce(d2 <= d_idx + {SOON}, false)::INT + coalesce(d3 <= d_idx + {SOON}, false)::INT) AS within FROM (SELECT event, d_idx, " + ", ".join(f"lead(event, {k}) OVER w AS n{k}, lead(d_idx, {k}) OVER w AS d{k}" for k in (1, 2, 3)) + " FROM oh WHERE status <> 'P' WINDOW w AS (PARTITION BY entity ORDER BY d_idx, event))"))
def next_until(spark, d):
    """The next three events of an entity that lie within SOON days; withdrawn rows are left out."""
    w = Window.partitionBy("entity").orderBy("d_idx", "event")
    ahead = lambda k: F.lead(F.struct("event", "d_idx"), k).over(w).alias(f"n{k}")
    rows = order_history(spark, d).filter("status <> 'P'").select("event", "d_idx", *[ahead(k) for k in (1, 2, 3)])
    near = lambda k: F.coalesce(F.col(f"n{k}.d_idx") <= F.col("d_idx") + SOON, F.lit(False))
    nexts = [F.when(near(k), F.col(f"n{k}.event")).alias(f"next{k}") for k in (1, 2, 3)]
    return rows.select("event", *nexts, sum((near(k).cast("int") for k in (2, 3)), near(1).cast("int")).alias("within"))


@query("J13_pairs", with_pt("SELECT one, two, count(*) AS met, count(*) FILTER (WHERE won) AS won FROM pr GROUP BY 1, 2", PAIRS))
def met_pairs(spark, d):
    return pairs(participations(spark, d)).groupBy("one", "two").agg(F.count("*").alias("met"), F.count_if("won").alias("won"))


@query("J14_fallback", """WITH keyed AS (SELECT p_partkey AS id, p_brand AS name, p_size % 7 AS yr, p_type AS detail FROM part),
  exact AS (SELECT name, yr, detail, min(id) AS ref FROM keyed GROUP BY ALL HAVING count(*) = 1), yearly AS (SELECT name, yr, min(id) AS ref FROM keyed GROUP BY ALL HAVING count(*) < 12),
  named AS (SELECT name, min(id) AS ref FROM keyed GROUP BY ALL)
  SELECT k.id, coalesce(e.ref, y.ref, n.ref) AS ref, CASE WHEN e.ref IS NOT NULL THEN 'exact' WHEN y.ref IS NOT NULL THEN 'year' ELSE 'name' END AS level
  FROM keyed k LEFT JOIN exact e USING (name, yr, detail) LEFT JOIN yearly y USING (name, yr) LEFT JOIN named n USING (name)""")
def fallback(spark, d):
    k = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"), (F.col("p_size") % 7).alias("yr"), F.col("p_type").alias("detail"))
    level = lambda keys, most, name: k.groupBy(*keys).agg(F.min("id").alias(name), F.count("*").alias("n")).filter(F.col("n") <= most).drop("n")
    out = k.join(level(["name", "yr", "detail"], 1, "exact"), ["name", "yr", "detail"], "left").join(level(["name", "yr"], 11, "year"), ["name", "yr"], "left")
    out = out.join(level(["name"], 1 << 40, "named"), ["name"], "left")
    label = F.when(F.col("exact").isNotNull(), "exact").when(F.col("year").isNotNull(), "year").otherwise("name")
    return out.select("id", F.coalesce("exact", "year", "named").alias("ref"), label.alias("level"))


@query("J15_nearest", with_tk("""SELECT grp, day, m, id FROM (SELECT grp, day, m, id, row_number() OVER (PARTITION BY grp, day, m ORDER BY abs(date_sub('second', ts, deadline) - m * 60), id) AS k
  FROM tk, (VALUES (10), (60), (240)) v(m)) WHERE k = 1"""))
def nearest(spark, d):
    rows = ticks(spark, d).withColumn("m", F.explode(F.array(F.lit(10), F.lit(60), F.lit(240))))
    gap = F.abs(F.timestamp_diff("SECOND", F.col("ts"), F.col("deadline")) - F.col("m") * 60)
    best = rows.groupBy("grp", "day", "m").agg(F.min_by("id", F.struct(gap.alias("g"), "id")).alias("id"))
    return best


@query("J16_name_search", "SELECT c_custkey AS id, c_name AS name, o.last FROM customer JOIN (SELECT o_custkey, max(o_orderdate)::DATE AS last FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 GROUP BY 1) o ON o_custkey = c_custkey WHERE c_name ILIKE '%1%' ORDER BY o.last DESC, id LIMIT 50")
def name_search(spark, d):
    c = table(spark, d, "customer").filter(F.col("c_name").ilike("%1%"))
    o = table(spark, d, "orders").filter(F.col("o_totalprice").between(1000, 200000)).groupBy("o_custkey").agg(F.max(F.col("o_orderdate").cast("date")).alias("last"))
    out = c.join(o, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "last")
    return out.orderBy(F.desc("last"), "id").limit(50)  # the feature: the 50 newest


@query("O1_order", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY coalesce(nullif(l_linenumber, 7), 99), l_quantity DESC, l_orderkey, l_partkey")
def order(spark, d):
    keys = [F.coalesce(F.nullif(F.col("l_linenumber"), F.lit(7)), F.lit(99)), F.desc("l_quantity"), "l_orderkey", "l_partkey"]
    return table(spark, d, "lineitem").orderBy(*keys).select("l_orderkey", "l_linenumber", "l_quantity")


@query("O1_order_all", "SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER (ORDER BY coalesce(nullif(l_linenumber, 7), 99), l_quantity DESC, l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS place FROM lineitem")
def order_all(spark, d):
    """All rows of lineitem in order, with their place in it; every column breaks ties."""
    keys = [F.coalesce(F.nullif(F.col("l_linenumber"), F.lit(7)), F.lit(99)), F.desc("l_quantity"), "l_orderkey", "l_partkey", "l_suppkey"]
    keys += ["l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return stats.numbered(table(spark, d, "lineitem"), keys).select("l_orderkey", "l_linenumber", "l_quantity", "place").orderBy("place")


@query("O2_top_k", with_pt("SELECT venue, event, runner_no, price FROM (SELECT *, row_number() OVER (PARTITION BY venue ORDER BY price DESC, event, runner_no) AS k FROM pt) WHERE k <= 10"))
def top_k(spark, d):
    w = Window.partitionBy("venue").orderBy(F.desc("price"), "event", "runner_no")
    return participations(spark, d).withColumn("k", F.row_number().over(w)).filter("k <= 10").select("venue", "event", "runner_no", "price")


@query("O3_distinct_on", with_tk("SELECT key, grp, id, value FROM (SELECT *, row_number() OVER (PARTITION BY key, grp ORDER BY ts, id) AS k FROM tk) WHERE k = 1"))
def distinct_on(spark, d):
    first = F.min_by(F.struct("id", "value"), F.struct("ts", "id"))
    return ticks(spark, d).groupBy("key", "grp").agg(first.alias("s")).select("key", "grp", "s.*")


@query("O4_final_pick", with_tk("SELECT grp, day, id, value FROM (SELECT *, row_number() OVER (PARTITION BY grp, day ORDER BY (ts = deadline) DESC, ts DESC, id DESC) AS k FROM tk) WHERE k = 1"))
def final_pick(spark, d):
    best = F.max_by(F.struct("id", "value"), F.struct((F.col("ts") == F.col("deadline")).alias("f"), "ts", "id"))
    return ticks(spark, d).groupBy("grp", "day").agg(best.alias("s")).select("grp", "day", "s.*")


@query("U1_union_kinds", with_pt("SELECT 'entity' AS kind, entity AS key, count(*) AS n FROM pt GROUP BY 2 UNION ALL SELECT 'rider', rider, count(*) FROM pt GROUP BY 2 UNION ALL SELECT 'owner', owner, count(*) FROM pt GROUP BY 2"))
def union_kinds(spark, d):
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in ("entity", "rider", "owner")]))
    return participations(spark, d).select(kinds.alias("s")).groupBy("s.kind", "s.key").agg(F.count("*").alias("n"))


@query("U2_union_distinct", with_tk("SELECT id FROM tk WHERE ts = deadline UNION SELECT min(id) FROM tk GROUP BY grp, day UNION SELECT id FROM tk WHERE value > 90"))
def union_distinct(spark, d):
    t = ticks(spark, d)
    return t.filter("ts = deadline").select("id").union(t.groupBy("grp", "day").agg(F.min("id")).drop("grp", "day")).union(t.filter("value > 90").select("id")).distinct()


@query("U3_difference", with_snap("SELECT id, 'gone' AS kind FROM sa WHERE id NOT IN (SELECT id FROM sb) UNION ALL SELECT id, 'new' FROM sb WHERE id NOT IN (SELECT id FROM sa)"))
def difference(spark, d):
    a, b = snapshots(spark, d)
    return a.join(b, "id", "left_anti").select("id", F.lit("gone").alias("kind")).union(b.join(a, "id", "left_anti").select("id", F.lit("new")))


@query("U4_intersection", with_snap("SELECT id, status FROM sa INTERSECT SELECT id, status FROM sb"))
def intersection(spark, d):
    a, b = snapshots(spark, d)
    return a.select("id", "status").intersect(b.select("id", "status"))
