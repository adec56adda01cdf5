"""Rows that stand for many, the Kalman filter row by row, and ridge rounds that don't move the cells."""

import random

from pyspark.sql import functions as F

from tidemark.operators import baseline, ratings, selection


def test_percentiles_of_counted_rows(spark):
    r = random.Random(4)
    rows = [(r.choice("ab"), float(r.randint(0, 60)), r.randint(1, 9)) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, x double, n int")
    each = df.withColumn("n", F.explode(F.sequence(F.lit(1), "n")))
    for limits in ({}, {"small": 20, "bins": 8}):
        one, two = (sorted(map(tuple, selection.percentiles(f, ["g"], "x", 0.3, times=t, **limits).collect())) for f, t in ((df, "n"), (each, None)))
        assert one == two


def test_alternating_rounds_hold_equal_rows_once(spark, monkeypatch):
    df = spark.createDataFrame([(i % 3, i % 4, float(i % 5)) for i in range(60)] * 20, "a int, b int, x double")
    seen, plain = [], selection.percentiles
    monkeypatch.setattr(selection, "percentiles", lambda rows, *rest, **more: (seen.append(rows.count()), plain(rows, *rest, **more))[1])
    baseline.alternating_medians(df, ["a", "b"], "x", 2)
    assert set(seen) == {60}


def test_kalman_by_rows(spark):
    rows = [(e, k, k, None if k == 3 else float(k * e)) for e in (1, 2, 3) for k in range(1, 40)]
    df = spark.createDataFrame(rows, "e int, d int, k int, v double").repartition(5)
    out = ratings.kalman(df, "e", "d", ["k"], "v", prior=10.0, var=4.0, noise=2.0, per_day=1.0)
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().toString()
    got = {(r.e, r.k): r.before for r in out.collect()}
    for e in (1, 2, 3):
        m, p = 10.0, 4.0
        for k in range(1, 40):
            p += 1.0 if k > 1 else 0.0
            assert got[e, k] == m
            if k != 3:
                g = p / (p + 2.0)
                m, p = m + g * (k * e - m), (1 - g) * p


def test_ridge_rounds_do_not_move_the_cells(spark, monkeypatch):
    plans, plain = [], ratings.written
    monkeypatch.setattr(ratings, "written", lambda df, name: (plans.append((name, df._jdf.queryExecution().executedPlan().toString())), plain(df, name))[1])
    r = random.Random(1)
    rows = [(r.randint(0, 40), r.randint(0, 6), r.random()) for _ in range(900)]
    ea, eb = ratings.two_way_ridge(spark.createDataFrame(rows, "p int, u int, x double"), "p", "u", "x", rounds=3)
    rounds = [p for name, p in plans if name == "ridge-b"]
    assert len(rounds) == 3 and all("hashpartitioning(p" not in p for p in rounds)
    mean = sum(x for *_, x in rows) / len(rows)
    b = dict.fromkeys(range(7), 0.0)
    rate = lambda own, at, other, pull: {k: sum(x[2] - mean - other[x[1 - at]] for x in rows if x[at] == k) / (sum(x[at] == k for x in rows) + pull) for k in own}
    for _ in range(3):
        a = rate({x[0] for x in rows}, 0, b, 5)
        b = rate(b, 1, a, 20)
    assert all(abs(x.eb - b[x.u]) < 1e-9 for x in eb.collect())
    a = rate(a, 0, b, 5)
    assert all(abs(x.ea - a[x.p]) < 1e-9 for x in ea.collect())
