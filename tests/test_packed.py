"""Packed days: rows are computed once, arrays come back as they were, lines are dealt out twice; odd parts against SQL."""

import random
import statistics

import duckdb
import pytest

from tidemark.operators import daily, form
from tidemark.plans import demo

SF = "/root/testdata/sf0.001"


def counted(df, seen):
    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema)


@pytest.mark.parametrize("most", [200, 10_000])
def test_rows_are_computed_once(spark, most):
    r, seen = random.Random(1), spark.sparkContext.accumulator(0)
    rows = [(d, d * 100 + e, who, float(k)) for d in range(30) for e in range(3) for k, who in enumerate(r.sample(range(30), 6))]
    df = counted(spark.createDataFrame(rows, "day int, event long, who int, place double"), seen)
    out = daily.ratings_by_day(df, daily.Elo(), day="day", event="event", entity="who", rank="place", block_rows=most)
    assert out.count() == len({(d, w) for d, _, w, _ in rows}) and seen.value == len(rows)


def test_packed_and_unpacked(spark):
    rows = [(k, i, None if i % 3 == 0 else i / 7) for k in range(5) for i in range(k * 4)]
    df = spark.createDataFrame(rows, "k long, i long, x double").coalesce(1).sortWithinPartitions("k", "i")
    some = daily.packed(df, ["k"], ["i", "x"])
    assert [r.k for r in some.collect()] == [1, 2, 3, 4]
    back = daily.unpacked(some, [("i", ["i"], "long"), ("x", ["x"], "double")], "k")
    assert sorted((r.k, r.i, r.x) for r in back.collect()) == sorted(rows, key=lambda r: r[:2])


def test_lines_are_dealt_out_twice(spark):
    """Once by part and once by order; orders meet their customers by themselves."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = demo.participations(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(dealt) == 6 and not any("hashpartitioning(event" in line for line in dealt)
    assert all(sum(f"hashpartitioning({c}" in line for line in dealt) == 1 for c in ("l_partkey", "l_orderkey", "p_partkey", "o_orderkey", "o_custkey", "c_custkey"))


def test_parts_that_are_missing_or_twice(spark, tmp_path):
    """A line without its part or customer has no number, a part that is there twice gives two rows, as in the SQL."""
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "customer"):
        con.execute(f"CREATE VIEW s_{t} AS SELECT * FROM '{SF}/{t}.parquet'")
    con.execute(f"COPY (SELECT * FROM s_part WHERE p_partkey % 5 <> 0 UNION ALL SELECT * REPLACE ('twice' AS p_type, NULL AS p_brand) FROM s_part WHERE p_partkey % 7 = 1) TO '{tmp_path}/part.parquet'")
    con.execute(f"COPY (SELECT * FROM s_customer WHERE c_custkey % 4 <> 0) TO '{tmp_path}/customer.parquet'")
    con.execute(f"COPY (SELECT * FROM s_lineitem) TO '{tmp_path}/lineitem.parquet'")
    con.execute(f"COPY (SELECT * FROM s_orders) TO '{tmp_path}/orders.parquet'")
    for t in ("lineitem", "orders", "part", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    names = "event, runner_no, entity, rider, owner, venue, price, finish, field_size"
    want = con.execute(demo.with_pt(f"SELECT {names} FROM pt")).fetchall()
    got = [tuple(r) for r in demo.participations(spark, str(tmp_path)).select(*names.split(", ")).collect()]
    assert len(got) == len(want) > 0 and sorted(map(str, got)) == sorted(map(str, want))


def test_form_computes_its_rows_once(spark):
    r, seen = random.Random(2), spark.sparkContext.accumulator(0)
    rows = [(d * 10 + e, no, r.randint(1, 9), r.choice(["a", "b", None]), r.choice([None, 1.0, 5.0, 9.0]), d, d // 10) for d in range(20) for e in range(2) for no in range(5)]
    df = counted(spark.createDataFrame(rows, "event long, no int, who int, kind string, v double, d int, y int"), seen)
    out = form.form_by_day(df, day="d", year="y", event="event", no="no", entity="who", kind="kind", value="v")
    assert out.count() == len(rows) == seen.value


@pytest.mark.parametrize("values", [[], [None, 2.0], [float(i * 7 % 1000) for i in range(1001)], [3.0] * 600 + [4.0] * 600, [1.0] * 5 + [float(i) for i in range(9)]])
def test_median_between_approximate_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    known = [v for v in values if v is not None]
    assert form.median(df, "x", 50) == (statistics.median(known) if known else None)
