"""Shared places and capped folds by hand."""

from pyspark.sql import functions as F

from tidemark.operators import stats


def test_tie_mean(spark):
    rows = [(1, 1), (1, 2), (1, 3), (4, 3), (5, 1), (5, 4), (6, 1), (9, 2), (None, 1)]
    got = spark.createDataFrame(rows, "p INT, t INT").select(stats.tie_mean(F.col("p"), F.col("t"), (30, 20, 12, 8, 5)).alias("a")).collect()
    assert [r.a for r in got] == [30, 25, 20, 4, 5, 1, 0, 0, 0]


def test_capped_fold(spark):
    df = spark.createDataFrame([(10, [(5, 40), (50, 40), (5, 20), (30, 90)]), (3, []), (70, [(1, 90)])], "s INT, r ARRAY<STRUCT<a: BIGINT, l: BIGINT>>")
    assert [r.x for r in df.select(stats.capped_fold(F.col("s"), F.col("r"), "a", "l", 60).alias("x")).collect()] == [60, 3, 60]
