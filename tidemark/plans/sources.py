"""Queries of the S family: round trips through files in the shared folder, and table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import commits, io
from .demo import query, snapshots, table, with_snap


@query("S1_feed_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def feed_csv(spark, d):
    path = io.new_path(spark, "feed")
    table(spark, d, "customer").write.option("header", True).csv(path)
    return io.read_feed_csv(spark, path, "c_custkey long, c_name string, c_acctbal double", ["c_custkey", "c_name"])


@query("S2_copy_tsv", "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, o_totalprice FROM orders")
def copy_tsv(spark, d):
    path = io.new_path(spark, "dump")
    rows = table(spark, d, "orders").select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"), "o_totalprice")
    rows.write.option("sep", "\t").option("nullValue", "\\N").option("escape", "\\").option("quote", "").csv(path)
    return io.read_copy_tsv(spark, path, "o_orderkey long, o_orderpriority string, o_totalprice double")


@query("S3_csv_to_parquet", "SELECT p_partkey AS id, p_type AS kind, p_size AS size FROM part")
def csv_to_parquet(spark, d):
    path = io.new_path(spark, "legacy")
    table(spark, d, "part").write.option("header", True).csv(path)
    return io.csv_to_parquet(spark, path, path + "-typed", {"p_partkey": ("id", "bigint"), "p_type": ("kind", "string"), "p_size": ("size", "int")})


@query("S4_jsonl_latest", "SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1")
def jsonl_latest(spark, d):
    path = io.new_path(spark, "shards")
    e = table(spark, d, "events").select(F.to_json(F.struct("user_id", "event_id", "value")).alias("value"))
    broken = e.select(F.concat(F.lit("{"), F.substring("value", 3, 20)).alias("value"))
    e.union(broken).write.option("compression", "gzip").text(path)
    return io.read_jsonl_latest(spark, path, "user_id long, event_id long, value double", ["user_id"], ["event_id"])


@query("S5_flatten", "SELECT event_id AS id, key, try_cast(json_extract_string(props, '$.' || key) AS BIGINT) AS val FROM events, LATERAL (SELECT unnest(json_keys(props)) AS key)")
def flatten(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("id"), F.explode(F.from_json("props", "map<string,string>")).alias("key", "text"))
    return e.select("id", "key", F.col("text").try_cast("bigint").alias("val"))


SEEN = "sn AS (SELECT *, 1 AS seen FROM sa UNION ALL SELECT *, 2 FROM sb)"


@query("S6_merge_snapshots", with_snap("SELECT id, price, status, day, seen FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY (price IS NOT NULL) DESC, seen DESC) AS k FROM sn) WHERE k = 1", SEEN))
def merge_snapshots(spark, d):
    a, b = snapshots(spark, d)
    docs = a.withColumn("seen", F.lit(1)).unionByName(b.withColumn("seen", F.lit(2)))
    return io.merge_snapshots(docs, ["id"], F.col("price").isNotNull(), "seen")


@query("S7_merge_protect", with_snap("SELECT id, coalesce(b.price, a.price) AS price, CASE WHEN b.id IS NOT NULL THEN b.status ELSE a.status END AS status, CASE WHEN b.id IS NOT NULL THEN b.day ELSE a.day END AS day FROM sa a FULL JOIN sb b USING (id)"))
def merge_protect(spark, d):
    a, b = snapshots(spark, d)
    return io.merge_protect(a, b, ["id"], ["price"])


@query("S8_fill_missing", with_snap("SELECT b.id, b.status, b.day, coalesce(b.price, a.price) AS price, CASE WHEN b.price IS NOT NULL THEN 'own' WHEN a.price IS NOT NULL THEN 'alt' END AS price_source FROM sb b LEFT JOIN sa a ON a.id = b.id"))
def fill_missing(spark, d):
    a, b = snapshots(spark, d)
    return io.fill_missing(b, [("alt", a)], ["id"], "price")


DIFF = "SELECT id, CASE WHEN a.k IS NULL THEN 'insert' WHEN b.k IS NULL THEN 'delete' ELSE 'change' END AS kind FROM (SELECT *, 1 AS k FROM sa) a FULL JOIN (SELECT *, 1 AS k FROM sb) b USING (id) WHERE a.k IS NULL OR b.k IS NULL OR (a.price, a.status, a.day) IS DISTINCT FROM (b.price, b.status, b.day)"


@query("S9_diff", with_snap(DIFF))
def diff(spark, d):
    a, b = snapshots(spark, d)
    return io.diff_tables(a, b, ["id"], ["price", "status", "day"])


@query("S10_incremental", with_snap("SELECT id, coalesce(b.id, a.id) IS NOT NULL AND b.id IS NOT NULL AS fresh, CASE WHEN b.id IS NOT NULL THEN b.price ELSE a.price END AS price FROM sa a FULL JOIN sb b USING (id)").replace("coalesce(b.id, a.id) IS NOT NULL AND ", ""))
def incremental(spark, d):
    a, b = snapshots(spark, d)
    mark = lambda df, k: df.select("id", F.lit(k == 2).alias("fresh"), "price", F.lit(k).alias("at"))
    return io.incremental(mark(a, 1), mark(b, 2), ["id"], "at").drop("at")


@query("S11_day_version", "SELECT 'orders' AS name, o_orderdate::DATE AS day, count(*) AS n, max(o_orderkey) AS newest FROM orders GROUP BY 2 UNION ALL SELECT 'events', ts::DATE, count(*), max(event_id) FROM events GROUP BY 2")
def day_version(spark, d):
    v = lambda name, t, ts, key: table(spark, d, t).groupBy(F.lit(name).alias("name"), F.col(ts).cast("date").alias("day")).agg(F.count("*").alias("n"), F.max(key).alias("newest"))
    return v("orders", "orders", "o_orderdate", "o_orderkey").unionByName(v("events", "events", "ts", "event_id"))


@query("S12_day_bundles", "SELECT o_orderdate::DATE AS day, count(*) AS n, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS keys FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1")
def day_bundles(spark, d):
    path = io.new_path(spark, "bundles")
    o = table(spark, d, "orders").filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).withColumn("day", F.col("o_orderdate").cast("date"))
    bundle = o.groupBy("day").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("rows"))
    bundle.withColumn("year", F.year("day")).write.partitionBy("year").json(path)
    back = spark.read.schema("day date, rows array<struct<o_orderkey long, o_orderstatus string>>, year int").json(path)
    return back.select("day", F.size("rows").cast("long").alias("n"), F.array_join(F.col("rows.o_orderkey").cast("array<string>"), ",").alias("keys"))


@query("S13_split_by_size", "SELECT p_brand, part, count(*) AS n, sum(b)::BIGINT AS bytes, min(p_partkey) AS first, max(p_partkey) AS last FROM (SELECT *, floor((sum(b) OVER (PARTITION BY p_brand ORDER BY p_partkey) - b) / 600)::BIGINT AS part FROM (SELECT *, strlen(p_name) + strlen(p_type) + 8 AS b FROM part)) GROUP BY 1, 2")
def split_by_size(spark, d):
    size = (F.octet_length("p_name") + F.octet_length("p_type") + 8).cast("long")
    return io.split_by_size(table(spark, d, "part"), "p_brand", "p_partkey", size, 600)[1]


@query("S14_archive", "SELECT ts::DATE::VARCHAR AS day, count(*) AS n, true AS same FROM events GROUP BY 1")
def archive(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("day"))
    return io.archive_and_verify(e, io.new_path(spark, "archive"), "day")


@query("S15_year_partitions", "SELECT year(o_orderdate)::INT AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY 1")
def year_partitions(spark, d):
    path = io.new_path(spark, "years")
    io.write_partitions(table(spark, d, "orders").withColumn("year", F.year("o_orderdate")), path, "year", ["o_orderkey"])
    back = spark.read.parquet(path).filter(F.col("year").between(1996, 1998))
    return back.groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("S17_freeze_past", with_snap("SELECT id, day, price FROM sa WHERE day < DATE '1998-01-01' UNION ALL SELECT id, day, price FROM sb WHERE day >= DATE '1998-01-01' UNION ALL SELECT id, day, price FROM sa WHERE day >= DATE '1998-01-01' AND id NOT IN (SELECT id FROM sb WHERE day >= DATE '1998-01-01')"))
def freeze_past(spark, d):
    a, b = snapshots(spark, d)
    return io.freeze_past(a, b, ["id"], "day", F.lit("1998-01-01").cast("date")).select("id", "day", "price")


@query("S18_backfill_key", "WITH k AS (SELECT p_partkey AS id, p_brand AS name, p_size AS yr, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS born FROM part), u AS (SELECT name, yr, min(born) AS b FROM k GROUP BY 1, 2 HAVING count(DISTINCT born) = 1) SELECT id, coalesce(born, b) AS born FROM k LEFT JOIN u USING (name, yr)")
def backfill_key(spark, d):
    k = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"), F.col("p_size").alias("yr"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("born"))
    u = k.groupBy("name", "yr").agg(F.min("born").alias("b"), F.count_distinct("born").alias("n")).filter("n = 1")
    return k.join(u, ["name", "yr"], "left").select("id", F.coalesce("born", "b").alias("born"))


@query("S19_union_sources", "SELECT o_orderkey AS id, o_orderdate AS at, 'orders' AS origin, o_totalprice AS amount, NULL::VARCHAR AS kind FROM orders UNION ALL SELECT event_id, ts, 'events', NULL, event_type FROM events")
def union_sources(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"), F.lit("orders").alias("origin"), F.col("o_totalprice").alias("amount"))
    b = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("at"), F.lit("events").alias("origin"), F.col("event_type").alias("kind"))
    return a.unionByName(b, allowMissingColumns=True)


@query("S20_replace_sources", with_snap("SELECT status, count(*) AS n, bool_and(r) AS replaced FROM (SELECT status, false AS r FROM sa WHERE status = 'P' UNION ALL SELECT status, true FROM sb WHERE status <> 'P') GROUP BY 1"))
def replace_sources(spark, d):
    a, b = snapshots(spark, d)
    out = io.replace_sources(a, b.filter("status <> 'P'"), "status", ["id", "price"])
    return out.groupBy("status").agg(F.count("*").alias("n"), F.bool_and("replaced").alias("replaced"))


CHECKED = """og AS (SELECT o_custkey AS source, o_orderkey AS id, o_totalprice AS price FROM orders),
  ng AS (SELECT source, CASE WHEN source % 17 <> 0 THEN id END AS id, CASE WHEN source % 5 = 0 THEN price + 1 ELSE price END AS price FROM og WHERE source % 19 <> 0 UNION ALL SELECT source, id, price FROM og WHERE source % 11 = 0 AND id % 2 = 0),
  jd AS (SELECT source, CASE WHEN source % 13 = 0 THEN 'not asked' WHEN source % 7 = 0 THEN 'failed' WHEN source % 19 = 0 AND NOT (source % 11 = 0 AND any_even) THEN 'empty' WHEN source % 17 = 0 AND source % 19 <> 0 THEN 'missing ids'
     WHEN source % 11 = 0 AND source % 19 <> 0 AND any_even THEN 'repeated ids' WHEN source % 5 = 0 AND source % 19 <> 0 THEN 'replaced' WHEN source % 19 = 0 AND NOT all_even THEN 'replaced' ELSE 'same' END AS outcome
     FROM (SELECT source, bool_or(id % 2 = 0) AS any_even, bool_and(id % 2 = 0) AS all_even FROM og GROUP BY 1)),
  rs AS (SELECT og.source, price FROM og JOIN jd USING (source) WHERE outcome <> 'replaced' UNION ALL SELECT ng.source, price FROM ng JOIN jd USING (source) WHERE outcome = 'replaced')"""


@query("S20_checked_replace", f"WITH {CHECKED} SELECT source, outcome, CASE WHEN outcome = 'not asked' THEN source % 3 WHEN outcome IN ('same', 'replaced') THEN 0 ELSE source % 3 + 1 END AS failures, count(*) AS n, round(sum(price), 2) AS total FROM jd JOIN rs USING (source) GROUP BY 1, 2, 3")
def checked_replace(spark, d):
    """Customers as source documents: some not asked for, some failed, empty, without ids, with ids twice, some changed."""
    old = table(spark, d, "orders").select(F.col("o_custkey").alias("source"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    source = F.col("source")
    new = old.filter(source % 19 != 0).select("source", F.when(source % 17 != 0, F.col("id")).alias("id"), F.when(source % 5 == 0, F.col("price") + 1).otherwise(F.col("price")).alias("price"))
    new = new.unionByName(old.filter((source % 11 == 0) & (F.col("id") % 2 == 0)))
    each = old.select("source").distinct()
    fetched = each.filter(source % 13 != 0).select("source", F.when(source % 7 == 0, "timeout").otherwise("ok").alias("status"))
    rows, state = io.replace_checked(old, new, fetched, each.select("source", (source % 3).alias("failures")), "source", "id", ["id", "price"])
    totals = rows.groupBy("source").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total"))
    return state.join(totals, "source")


@query("S14_archived_days", "SELECT day::VARCHAR AS day, n, archived FROM (SELECT ts::DATE AS day, count(*) AS n, ts::DATE < DATE '2024-01-20' AS archived FROM events GROUP BY 1, 3)")
def archived_days(spark, d):
    """Events by day in a committed table; days before the 20th are archived, verified and dropped. Counts of both places."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("date").cast("string").alias("day"))
    path, out = io.new_path(spark, "days"), io.new_path(spark, "archive")
    commits.commit(e, path, by="day")
    commits.archive_before(spark, path, e.schema, "day", "2024-01-20", out)
    left = commits.read(spark, path, e.schema).withColumn("archived", F.lit(False))
    gone = spark.read.schema(e.schema).json(out).withColumn("archived", F.lit(True))
    return left.unionByName(gone).groupBy("day", "archived").agg(F.count("*").alias("n"))
