"""Nearest vectors against brute force: random and clustered vectors, ties, copies, repeated ids, nulls, odd lengths."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import ann_search as ann

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, each):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    dot = lambda a, b: float((a[: len(b)] * b[: len(a)]).sum())
    out = []
    for i, q in good:
        if i % each == 0:
            best = sorted((-dot(q, v), j) for j, v in good if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def check(spark, rows, k, each):
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("id", "v", "cell", "code", "key", "block", "qb", "score")])
    got = sorted(tuple(r) for r in ann.nearest(df.repartition(3), F.col("vec_id") % each == 0, k).collect())
    want = brute(rows, k, each)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=1e-12)


def floats(a):
    return [float(x) for x in np.float32(a)]


def test_random_and_clustered(spark, monkeypatch):
    rng = np.random.default_rng(3)
    middle = rng.standard_normal((6, 20))
    v = np.concatenate([rng.standard_normal((900, 20)), middle[rng.integers(0, 6, 900)] + 0.05 * rng.standard_normal((900, 20))])
    monkeypatch.setattr(ann, "BLOCK_ROWS", 100)
    monkeypatch.setattr(ann, "QUERY_ROWS", 40)
    check(spark, [(i, floats(x)) for i, x in enumerate(v)], 10, 15)


def test_edges(spark):
    rng = np.random.default_rng(4)
    same = floats(rng.standard_normal(7))
    rows = [(i, same) for i in range(60)] + [(i, floats(10.0 ** (i % 9) * rng.standard_normal(7))) for i in range(60, 90)]
    rows += [(90, None), (91, []), (92, [0.0] * 7), (93, [1.0, None]), (94, [float("nan")] * 7), (95, [float("inf"), 1.0]), (None, same), (100, [1.0, 2.0]), (101, [0.0] * 6 + [3.0]), (100, [2.0, 2.0]), (20, same)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r)[:3] for r in ann.nearest(df, F.col("vec_id") % 10 == 0, 5).collect())
    assert got == [w[:3] for w in brute(rows, 5, 10)]


def test_fewer_candidates_one_row_and_empty(spark):
    check(spark, [(0, [1.0, 0.0]), (1, [-1.0, 0.5]), (2, [3.0, 0.0])], 20, 1)
    check(spark, [(0, [1.0, 0.0])], 20, 1)
    df = spark.createDataFrame([], SCHEMA)
    assert ann.nearest(df, F.col("vec_id") % 20 == 0, 20).count() == 0


def test_error_bound_holds_and_is_not_idle():
    rng = np.random.default_rng(5)
    v, q = rng.standard_normal((4000, 48)), rng.standard_normal((50, 48))
    turn, centre = ann.rotation(48), ann.centres(v[:500], 4)
    cell, bits, length, s = ann.encode(v, centre, turn)
    asked = ann.Queries(q, np.arange(50), turn, 5)
    code = bits.copy().view(np.uint64)
    signs = asked._signs(np.arange(50), code, np.bitwise_count(code).sum(1, dtype=np.int64))
    error = np.abs(q @ centre[cell].T.copy() + signs * (length / s) - q @ v.T)
    deviation = asked.length[:, None] * (length * np.sqrt((1 - s**2) / (s**2 * (asked.bits - 1))))
    rounding = asked.rounding[:, None] * (length / s)
    assert (error > ann.EPSILON * deviation + rounding).mean() < 1e-4
    assert 0.5 < np.sqrt((error**2).mean() / (deviation**2).mean()) < 1.2
    assert asked.bits == 192 and bits.shape[1] == 24


def test_most_rows_are_judged_by_their_codes_alone(monkeypatch):
    rng = np.random.default_rng(6)
    v = rng.standard_normal((5000, 64))
    turn, centre = ann.rotation(64), np.zeros((1, 64))
    _, bits, length, s = ann.encode(v, centre, turn)
    q = ann.Queries(v[:20], np.arange(20), turn, 10)
    exact = []
    real = np.nonzero
    monkeypatch.setattr(ann.np, "nonzero", lambda m: (exact.append(int(m.sum())), real(m))[1])
    q.meet(centre[0], np.arange(5000), v, bits.copy().view(np.uint64), length, s)
    assert 0 < sum(exact) < 0.25 * 20 * 5000
