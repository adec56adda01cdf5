"""Moving order statistics against all pairs: nulls, ties, repeated rows, block edges, days before 0, empty tables."""

import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import rolling
from tidemark.operators.rolling import Window

SCHEMA = "k string, d int, v double, d_idx string"


def rows_of(n, seed):
    r = random.Random(seed)
    return [(r.choice(["a", "a", "a", "b", None]), r.randint(-40, 40), r.choice([None, *map(float, range(12))]), "x") for _ in range(n)]


def fine_rows(n, seed):
    """Values of two digits, of which one is a third of all rows."""
    r = random.Random(seed)
    return [(r.choice(["a", "a", "a", "b", None]), r.randint(-40, 40), r.choice([None, 3.25, 3.25, *[round(r.gauss(0, 5), 2) for _ in range(3)]]), "x") for _ in range(n)]


HOT = {"small": 40, "cell_rows": 12}


@pytest.mark.parametrize("days", [1, 7, 30])
@pytest.mark.parametrize("stat", ["median", "share_below", "mode"])
@pytest.mark.parametrize(("limits", "make"), [({}, rows_of), (HOT, fine_rows)])
def test_against_pairs(spark, monkeypatch, days, stat, limits, make):
    monkeypatch.setattr(rolling, "_MANY", 3)
    nan = [("a", 3, float("nan"), "x")]
    probes, facts = make(60, 1) + make(5, 1), make(400, 2)
    got = rolling.rolling(spark.createDataFrame(probes, SCHEMA), spark.createDataFrame(facts + nan, SCHEMA), by=["k"], day="d", value="v", days=days, stat=stat, **limits).collect()
    want = []
    for k, d, v, x in probes:
        held = [w for k2, e, w, _ in facts if k2 == k and w is not None and d - days <= e < d]
        if stat == "median":
            out = median(held) if held else None
        elif stat == "mode":
            out = min(held, key=lambda w: (-held.count(w), w)) if held else None
        else:
            out = None if v is None or not held else (sum(w < v for w in held) + sum(w == v for w in held) / 2) / len(held)
        want.append((k, d, v, x, len(held), out and round(out, 9)))
    assert sorted(map(str, want)) == sorted(str((r.k, r.d, r.v, r.d_idx, r.window_n, r.window and round(r.window, 9))) for r in got)


def test_one_value_and_a_hot_block_are_cells(spark, monkeypatch):
    """No sorted list is longer than a cell, though one block holds all rows, and a value that repeats is in none."""
    facts = spark.range(30_000).select(F.lit("a").alias("k"), (F.col("id") % 9).cast("int").alias("d"), F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.col("id").cast("double")).alias("v"))
    known = facts.filter("d < 8")
    probes = spark.createDataFrame([("a", 8, 7.5), ("a", 8, 20_000.0), ("a", 8, None)], "k string, d int, v double")
    seen, plain = [], rolling._answers
    monkeypatch.setattr(rolling, "_answers", lambda asked, known, keys, *rest: (seen.append((keys, known.groupBy(*keys).count().agg(F.max("count")).first()[0])), plain(asked, known, keys, *rest))[1])
    limits = {"by": ["k"], "day": "d", "value": "v", "days": 9, "small": 5000, "cell_rows": 500}
    shares = {r.v: r.window for r in rolling.rolling(probes, known, stat="share_below", **limits).collect()}
    values = sorted(r.v for r in known.collect())
    assert shares == {v: None if v is None else (sum(w < v for w in values) + values.count(v) / 2) / len(values) for v in (7.5, 20_000.0, None)}
    for stat, want in (("median", median(values)), ("mode", 7.5)):
        assert {r.window for r in rolling.rolling(probes, known, stat=stat, **limits).collect()} == {want}
    assert max(n for keys, n in seen if "cell" in keys) <= 1000
    assert all(not n for keys, n in seen if "cell" not in keys)


def test_empty_tables(spark):
    some, none = spark.createDataFrame(rows_of(5, 3), SCHEMA), spark.createDataFrame([], SCHEMA)
    assert rolling.rolling(none, some, by=["k"], day="d", value="v", days=5).count() == 0
    assert [r.window_n for r in rolling.rolling(some, none, by=["k"], day="d", value="v", days=5).collect()] == [0] * 5


def test_a_large_window_is_held_in_an_array():
    """Growing and shrinking over the bound, with ties, against sorted lists."""
    r = random.Random(3)
    w, held, arrays = Window(20), [], 0
    for day in range(0, 240, 2):
        w.move(day)
        held = [(d, v) for d, v in held if d >= day - 20]
        want = sorted(x for _, v in held for x in v)
        assert list(w.values) == want
        arrays += isinstance(w.values, np.ndarray)
        if want:
            n, v = len(want), want[len(want) // 3]
            assert w.median() == (want[(n - 1) // 2] + want[n // 2]) / 2
            assert w.place(v) == sum(x < v for x in want) + want.count(v) / 2
        new = [float(r.randint(0, 300)) for _ in range(r.choice([3, 500]) if day % 80 < 40 else r.choice([0, 70]))]
        held.append((day, new))
        w.add(day, new)
    assert 0 < arrays < 120


def test_equal_values_are_held_once(spark, monkeypatch):
    """Copies of the facts change neither what tasks are given nor what a window holds; times stands for copies."""
    facts = spark.createDataFrame(rows_of(200, 5), SCHEMA).drop("d_idx")
    copies = facts.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("copy")
    probes = facts.select("k", "d").distinct()
    seen, plain = [], rolling._answers
    monkeypatch.setattr(rolling, "_answers", lambda asked, known, *rest: (seen.append(known.count()), plain(asked, known, *rest))[1])
    limits = {"by": ["k"], "day": "d", "value": "v", "days": 7}
    for stat in ("median", "mode"):
        one, many, told = (
            sorted(map(str, rolling.rolling(probes, f, stat=stat, times=t, **limits).collect()))
            for f, t in ((facts.withColumn("n", F.lit(50)), "n"), (copies, None), (facts.unionByName(facts).withColumn("n", F.lit(25)), "n"))
        )
        assert one == many == told
    assert len(set(seen)) == 1 and seen[0] < 2 * 200
    w = Window(5)
    for day in range(3):
        w.add(day, [1.0, 2.0], [1_000_000, 3])
    assert len(w.kinds) == 2 and w.n == 3_000_009 and w.median() == 1.0 and w.mode() == (1.0, 3_000_000)
    w.move(7)
    assert w.n == 1_000_003 and w.place(2.0) == 1_000_001.5
