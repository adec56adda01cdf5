"""Queries and their SQL on rows at a bound of a rule."""

import random

import duckdb

from tidemark.plans import registry


def both(spark, folder, name, tables):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    sql = c.execute(registry.oracle_sql()[name])
    names = [x[0] for x in sql.description]
    got = registry.queries()[name](spark, str(folder)).select(*names).collect()
    return sorted(map(tuple, got), key=str), sorted(sql.fetchall(), key=str)


def test_runs_of_negated_words(spark, tmp_path):
    texts = ["of " * 40 + "in", "the " + "of " * 9 + "may. the of of", "de of in", "of  in. the of,", "the of1", "\u00e9the the of", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, want = both(spark, tmp_path, "X2_events", {"documents": docs})
    assert got == want and {r[0] for r in got} == {1, 3, 4, 5}


def test_an_expectation_at_its_bound(spark, tmp_path):
    at = "timestamp '1999-01-01'"
    discounts = [0.01, 0.01, 0.03, 0.04, 0.01, 0.07, 0.03, 0.07, 0.07]  # those of 0.01 have 0.15 each
    order = random.Random(1)
    line = spark.createDataFrame([(e, i, d) for e in range(1, 200) for i, d in enumerate(order.sample(discounts, 9))], "e long, i int, d double")
    line = line.selectExpr("e AS l_orderkey", "1L AS l_partkey", "1L AS l_suppkey", "i AS l_linenumber", "1.0D + i AS l_quantity", "100.0D + (e * 37 + i * 11) % 89 AS l_extendedprice", "d AS l_discount", "0.0D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", f"{at} AS l_shipdate")
    orders = spark.range(1, 200).selectExpr("id AS o_orderkey", "1L AS o_custkey", f"{at} AS o_orderdate")
    part = spark.sql("SELECT 1L AS p_partkey, 'B' AS p_brand, 'T' AS p_type, 1 AS p_size")
    customer = spark.sql("SELECT 1L AS c_custkey, 1 AS c_nationkey")
    got, want = both(spark, tmp_path, "E16_field_weights", {"lineitem": line, "orders": orders, "part": part, "customer": customer})
    assert got == want and {r[0] for r in got if r[-1]} == set(range(1, 200))
