"""Groups of names joined by hand: chains, names that are only in pairs, ties, nulls, no pairs."""

from tidemark.operators.graph import alias_groups


def run(spark, pairs):
    names = spark.createDataFrame([("a", 1, 1), ("b", 5, 2), ("c", 5, 9), ("d", 2, 3), ("e", 7, 1)], "name string, n int, newest int")
    return {r.name: (r.canonical, r.names) for r in alias_groups(names, spark.createDataFrame(pairs, "a string, b string")).collect()}


def test_chains(spark):
    got = run(spark, [("a", "b"), ("x", "b"), ("x", "y"), ("y", "c"), ("d", None), ("c", "a")])
    assert got == {"a": ("c", 3), "b": ("c", 3), "c": ("c", 3), "d": ("d", 1), "e": ("e", 1)}
    assert run(spark, []) == {n: (n, 1) for n in "abcde"}
