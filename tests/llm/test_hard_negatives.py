"""Hard negatives against brute force: windows, ties, hot labels, nulls, repeated ids, negative and zero scores."""

import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, each):
    good = [(i, [max(-(2**24), min(2**24, math.floor(256 * x))) for x in v], y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, q, y in good:
        if i % each:
            continue
        scored = sorted((-dot(q, v), j, z == y) for j, v, z in good if j != i)
        for p, j, _ in [x for x in scored if x[2]][:5]:
            fits = [(s, k) for s, k, same in scored if not same and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, each):
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("id", "v", "x", "key", "block", "tree", "rank", "score")])
    return sorted(tuple(r) for r in hn.mine(df.repartition(3), F.col("vec_id") % each == 0, F.col("label")).collect())


def test_clusters_with_a_hot_label(spark, monkeypatch):
    rng = np.random.default_rng(1)
    middle = rng.standard_normal((8, 6))
    at = rng.integers(0, 8, 1500)
    v = middle[at] + 0.3 * rng.standard_normal((1500, 6))
    rows = [(i, [float(x) for x in u], 0 if i % 3 == 0 else int(c)) for i, (u, c) in enumerate(zip(v, at, strict=True))]
    for name, n in (("TREE_ROWS", 150), ("ANCHOR_ROWS", 8), ("LEAF", 8), ("FANOUT", 3)):
        monkeypatch.setattr(hn, name, n)
    assert mined(spark, rows, 25) == brute(rows, 25)


def test_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.5], i % 2) for i in range(40)]  # ties
    rows += [(i, [float(x) for x in rng.standard_normal(2)], i % 3) for i in range(40, 120)]
    rows += [(120, None, 1), (130, [], 1), (140, [0.0, 0.0], 2), (150, [1.0, None], 1), (160, [float("nan"), 1.0], 1), (170, [float("-inf"), 1.0], 1), (180, [1.0, 1.0], None)]
    rows += [(None, [1.0, 1.0], 1), (190, [-3.0], 7), (200, [-2.0, 0.0], 7), (210, [1e9, -1e9], 1), (10, [0.2, 0.9], 2), (10, [0.2, 0.9], 2), (211, [0.5, 0.4, 8.0], 0)]
    got, want = mined(spark, rows, 10), brute(rows, 10)
    assert got == want and want
    assert mined(spark, [], 10) == [] and mined(spark, rows[:1], 10) == []


def test_boxes_bound_scores_and_save_work():
    rng = np.random.default_rng(3)
    v = (256 * (rng.integers(-2, 3, (3000, 3)) + 0.05 * rng.standard_normal((3000, 3)))).astype(np.int64)
    tree = hn.Tree(v, np.arange(3000), np.zeros(3000, np.int64))
    q = v[:20]
    scores = q @ tree.v.T
    for (low, high), level in zip(tree.bounds(q), tree.levels, strict=True):
        assert low.shape == high.shape == (20, len(level[0]))
    low, high = tree.bounds(q)[0]
    for n in range(low.shape[1]):
        there = scores[:, n * hn.LEAF : (n + 1) * hn.LEAF]
        assert (there >= low[:, n : n + 1]).all() and (there <= high[:, n : n + 1]).all()
    best = [hn.Best(np.array([hn._NONE]), np.array([2**62]), 5) for _ in q]
    read = hn.walk(tree, q, np.arange(20), np.zeros(20, np.int64), best, same_label=True)
    assert 0 < read < 0.7 * 20 * low.shape[1]
    for i, b in enumerate(best):
        want = sorted((-int(s), int(j)) for s, j in zip(scores[i], tree.ids, strict=True) if j != i)[:5]
        assert b.held[0] == want
