"""Selection against numpy: large and small groups, ties, outliers, null keys, all ranks."""

import numpy as np
import pytest

from tidemark.operators import baseline, selection


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(8)
    made = {
        "normal": rng.standard_normal(5001), "ties": rng.integers(0, 3, 4000).astype(float), "same": np.full(900, 7.5), "outliers": np.r_[rng.standard_normal(3000), 1e300, -1e300, 1e-300],
        "skewed": np.exp(30 * rng.standard_normal(2500)), "few": rng.standard_normal(20), "one": np.array([3.0]), None: rng.standard_normal(800),
    }
    return {k: [float(x) for x in v] for k, v in made.items()}


@pytest.mark.parametrize("q", [0.5, 0.1, 0.999, 0.0, 1.0])
def test_percentiles(spark, groups, q):
    rows = [(k, x) for k, v in groups.items() for x in v] + [("few", None), ("few", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    got = {r.g: r.percentile for r in selection.percentiles(df, ["g"], "x", q, small=50, bins=16).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        assert got[k] == pytest.approx(np.quantile(v, q), rel=1e-9, abs=1e-12), k
    assert {r.g: r.percentile for r in selection.percentiles(df, ["g"], "x", q).collect()} == pytest.approx(got, rel=1e-12)


def test_one_group_of_a_million_rows(spark):
    df = spark.range(1_000_001).selectExpr("1 AS g", "(id * 7919) % 1000001 / 3.0 AS x")
    assert selection.percentiles(df, ["g"], "x", small=1000, bins=64).first().percentile == pytest.approx(500_000 / 3)
    assert selection.percentiles(df.filter("false"), ["g"], "x").count() == 0
    whole = selection.percentiles(df, [], "x", small=1000, bins=64)
    assert whole.columns == ["percentile"] and whole.first().percentile == pytest.approx(500_000 / 3)


def test_alternating_medians_by_selection_are_the_same(spark):
    rng = np.random.default_rng(9)
    rows = [(int(a), int(b), float(10 * a - 3 * b + rng.standard_normal())) for a, b in rng.integers(0, 4, (1500, 2))]
    df = spark.createDataFrame(rows, "a int, b int, x double")
    moved = {}
    one, two = baseline.alternating_medians(df, ["a", "b"], "x", 4), baseline.alternating_medians(df, ["a", "b"], "x", 4, small=60, moved=moved)
    for f in "ab":
        assert {r[f]: r.effect for r in one[f].collect()} == pytest.approx({r[f]: r.effect for r in two[f].collect()}, rel=1e-12)
    assert set(moved) == {"a", "b"} and max(moved.values()) < 0.5
