"""Adapters that give the driver's tables the shapes of FIXTURES.md section 3, in Spark and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EPOCH = "2000-01-01"


def hu(expression: str, digits: int = 4) -> str:
    """SQL of operators.stats.half_up."""
    return f"floor(({expression}) * 1e{digits} + 0.500001) / 1e{digits}"


#: name -> callable(spark, sf_dir); name -> SQL.
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under its inventory id, with its SQL where SQL can express it."""

    def add(f):
        assert name not in QUERIES, name
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def participations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-PART: one row for each participant of an event, with context, outcome, measure and ranks."""
    t = lambda n: table(spark, sf_dir, n)
    line = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    # Lines meet their part first and orders their customer before the lines, so that lines are dealt out twice, by part and
    # by order; as in the SQL, a line without a part, order or customer is in no event and has no number.
    orders = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = (
        t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("runner_no", F.row_number().over(line))
    )
    day = F.col("o_orderdate").cast("date")
    rows = rows.select(
        F.col("l_orderkey").alias("event"), day.alias("day"), F.datediff(day, F.lit(EPOCH).cast("date")).alias("d_idx"),
        "runner_no", F.col("l_partkey").alias("entity"), F.col("l_suppkey").alias("rider"), F.col("o_custkey").alias("owner"),
        F.col("p_brand").alias("sire"), F.col("c_nationkey").alias("venue"), (F.col("p_size") * 10).alias("distance"),
        F.col("l_returnflag").alias("going"), F.col("p_type").alias("class"), F.col("l_quantity").alias("measure"),
        F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"),
        F.col("l_linestatus").alias("status"), F.col("l_shipdate").cast("date").alias("available"),
    )
    by = lambda c: Window.partitionBy("event").orderBy(F.desc(c), "runner_no")
    return rows.select(
        "*",
        F.row_number().over(by("price")).alias("finish"),
        F.row_number().over(by("discount")).alias("popularity"),
        F.count("*").over(Window.partitionBy("event")).alias("field_size"),
    )


#: The same as common table expression `pt`.
PT = f"""
pt0 AS (
  SELECT o_orderkey AS event, o_orderdate::DATE AS day, date_diff('day', DATE '{EPOCH}', o_orderdate::DATE)::INT AS d_idx,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
           l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)::INT AS runner_no,
         l_partkey AS entity, l_suppkey AS rider, o_custkey AS owner, p_brand AS sire, c_nationkey AS venue,
         p_size * 10 AS distance, l_returnflag AS going, p_type AS class, l_quantity AS measure, l_extendedprice AS price,
         l_discount AS discount, l_linestatus AS status, l_shipdate::DATE AS available
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
), pt AS (
  SELECT *, row_number() OVER (PARTITION BY event ORDER BY price DESC, runner_no)::INT AS finish,
         row_number() OVER (PARTITION BY event ORDER BY discount DESC, runner_no)::INT AS popularity,
         count(*) OVER (PARTITION BY event) AS field_size
  FROM pt0
)"""


def with_pt(body: str, *more: str) -> str:
    return "WITH " + ", ".join([PT, *more]) + " " + body


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-LAG: each customer's orders as a dated sequence."""
    o = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_custkey").alias("entity"), F.col("o_orderkey").alias("event"), day.alias("day"),
        F.datediff(day, F.lit(EPOCH).cast("date")).alias("d_idx"), F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("grade"),
    )


OH = f"""
oh AS (
  SELECT o_custkey AS entity, o_orderkey AS event, o_orderdate::DATE AS day,
         date_diff('day', DATE '{EPOCH}', o_orderdate::DATE)::INT AS d_idx, o_totalprice AS price,
         o_orderpriority AS priority, o_orderstatus AS status, substr(o_orderpriority, 1, 1)::INT AS grade
  FROM orders
)"""


def with_oh(body: str, *more: str) -> str:
    return "WITH " + ", ".join([OH, *more]) + " " + body


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-TICK: events as value observations of a key within a group-day, whose last time is the deadline."""
    e = table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    return e.select(
        F.col("event_id").alias("id"), F.col("ts"), day.alias("day"), F.col("event_type").alias("grp"),
        F.col("user_id").alias("key"), "value",
        F.max("ts").over(Window.partitionBy("event_type", day)).alias("deadline"),
    )


TK = """
tk AS (
  SELECT event_id AS id, ts, ts::DATE AS day, event_type AS grp, user_id AS key, value,
         max(ts) OVER (PARTITION BY event_type, ts::DATE) AS deadline
  FROM events
)"""


def with_tk(body: str, *more: str) -> str:
    return "WITH " + ", ".join([TK, *more]) + " " + body


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """D-SNAP: two partly overlapping snapshots of orders; the second one misses some prices."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("date").alias("day")
    )
    a = o.filter(F.col("id") % 2 == 0)
    b = o.filter(F.col("id") % 3 != 0).withColumn("price", F.when(F.col("id") % 5 != 0, F.col("price")))
    return a, b


SNAP = """
so AS (SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status, o_orderdate::DATE AS day FROM orders),
sa AS (SELECT * FROM so WHERE id % 2 = 0),
sb AS (SELECT id, CASE WHEN id % 5 <> 0 THEN price END AS price, status, day FROM so WHERE id % 3 <> 0)"""


def with_snap(body: str, *more: str) -> str:
    return "WITH " + ", ".join([SNAP, *more]) + " " + body
