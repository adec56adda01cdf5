"""As-of semantics on tiny inputs: strictness, both window forms, leaks, and a brute-force property."""

import random

from pyspark.sql import functions as F

from tidemark.operators import asof, quality


def facts(spark, n=200, seed=3):
    r = random.Random(seed)
    return [(r.randrange(5), r.randrange(60), r.randrange(1, 9)) for _ in range(n)]


def test_strict_and_inclusive_join(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 3), ("c", 9)], "k string, d int")
    right = spark.createDataFrame([("a", 1, 10), ("a", 4, 40), ("a", 5, 50), ("b", 3, 30)], "k string, at int, v int")
    strict = asof.asof_join(left, right, by=["k"], left_on="d", right_on="at", take=["v"])
    assert {(r.k, r.d): r.v for r in strict.collect()} == {("a", 5): 40, ("a", 1): None, ("b", 3): None, ("c", 9): None}
    upto = asof.asof_join(left, right, by=["k"], left_on="d", right_on="at", take=["v"], inclusive=True)
    assert {(r.k, r.d): r.v for r in upto.collect()} == {("a", 5): 50, ("a", 1): 10, ("b", 3): 30, ("c", 9): None}


def test_join_keeps_repeated_left_rows_and_empty_tables(spark):
    left = spark.createDataFrame([("a", 5), ("a", 5)], "k string, d int")
    right = spark.createDataFrame([], "k string, at int, v int")
    out = asof.asof_join(left, right, by=["k"], left_on="d", right_on="at", take=["v"]).collect()
    assert [r.v for r in out] == [None, None]


def test_frame_equals_prefix_equals_brute_force(spark):
    rows = facts(spark)
    df = spark.createDataFrame(rows, "k int, d int, v int")
    buckets = asof.day_buckets(df, ["k"], "d", {"n": F.lit(1), "s": F.col("v")})
    for days in (7, 30, None):
        want = {}
        for k, d, _ in rows:
            past = [v for kk, dd, v in rows if kk == k and dd < d and (days is None or dd >= d - days)]
            want[k, d] = (len(past) or None, sum(past) or None)
        for form in ("frame", "prefix"):
            got = asof.window_sums(buckets, ["k"], "d", ["n", "s"], days, form).collect()
            zero = lambda x: x or None
            assert {(r.k, r.d): (zero(r.n_before), zero(r.s_before)) for r in got} == want, (days, form)


def test_band_join_equals_brute_force(spark):
    rows = facts(spark, 120, 9)
    df = spark.createDataFrame(rows, "k int, d int, v int")
    right = df.select("k", F.col("d").alias("at"), F.col("v").alias("w"))
    got = asof.band_join(df, right, by=["k"], left_on="d", right_on="at", days=10)
    got = sorted((r.k, r.d, r.at, r.w) for r in got.collect())
    want = sorted((k, d, d2, v2) for k, d, _ in rows for k2, d2, v2 in rows if k == k2 and d - 10 <= d2 < d)
    assert got == want


def test_windows_do_not_leak(spark):
    df = spark.createDataFrame(facts(spark, 300, 5), "k int, d int, v int")

    def build(rows):
        b = asof.day_buckets(rows, ["k"], "d", {"s": F.col("v")})
        return asof.window_sums(b, ["k"], "d", ["s"], 20).select("k", "d", "s_before")

    assert quality.leak_rows(build, df, "d", 30, ["k", "d"]).count() == 0

    def leaky(rows):
        b = asof.day_buckets(rows, ["k"], "d", {"s": F.col("v")})
        total = b.groupBy("k").agg(F.sum("s").alias("t"))
        return b.join(total, "k").select("k", "d", "t")

    assert quality.leak_rows(leaky, df, "d", 30, ["k", "d"]).count() > 0
