"""Fitted models against plain versions."""

from pathlib import Path

import numpy as np
import pytest

from tidemark.plans import probabilities, registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def newton(x, y, classes, ridge=1.0):
    """Multinomial logistic regression by Newton's steps on standardised columns: probabilities of the rows as a function."""
    mean, sd = x.mean(0), np.where(x.std(0) > 1e-12, x.std(0), 1.0)
    design = lambda v: np.column_stack([np.ones(len(v)), (v - mean) / sd])
    z, k = design(x), classes - 1
    b, pull = np.zeros((k, z.shape[1])), np.tile([ridge / 100, *[ridge] * x.shape[1]], k)

    def p(v):
        s = np.column_stack([np.zeros(len(v)), design(v) @ b.T])
        e = np.exp(s - s.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    for _ in range(40):
        q = p(x)[:, 1:]
        gradient = ((np.arange(1, classes)[None, :] == y[:, None]) - q).T @ z
        hessian = np.block([[z.T @ (z * (q[:, a] * ((a == c) - q[:, c]))[:, None]) for c in range(k)] for a in range(k)])
        b = b + np.linalg.solve(hessian + np.diag(pull), (gradient.ravel() - pull * b.ravel())).reshape(b.shape)
    return p


def test_models_against_numpy(spark):
    rows = probabilities.model_rows(spark, SF, keep=("popularity", "finish", "venue")).toPandas()
    x = rows[probabilities.MODEL].to_numpy(float)
    won = newton(x, (rows.finish == 1).to_numpy(int), 2)(x)[:, 1]
    got = {(r.event, r.runner_no): r.p for r in registry.queries()["E19_model"](spark, SF).collect()}
    assert len(got) == len(rows) and all(abs(got[e, n] - p) < 2e-6 for e, n, p in zip(rows.event, rows.runner_no, won, strict=True))
    got = {(r.event, r.runner_no): (r.p_unplaced, r.p_placed, r.p_won) for r in registry.queries()["E19_venue_classes"](spark, SF).collect()}
    assert len(got) == len(rows)
    for _, g in rows.groupby("venue"):
        x, y = g[probabilities.MODEL].to_numpy(float), np.where(g.finish == 1, 2, np.where(g.finish <= 3, 1, 0))
        want = newton(x, y, 3)(x)
        assert np.allclose([got[k] for k in zip(g.event, g.runner_no, strict=True)], want, atol=2e-6)


def test_groups_without_a_class_and_odd_rows(spark):
    from tidemark.operators import models

    rows = [("a", float(i), 1.0, int(i % 3 == 0)) for i in range(60)] + [("b", float(i), 2.0, 0) for i in range(5)] + [("c", None, 1.0, 1), ("a", 1.0, 1.0, None), ("d", 3.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "g string, x double, same double, y int")
    got = {r.g: r for r in models.softmax_fit(df, ["g"], ["x", "same"], "y", 2).collect()}
    assert set(got) == {"a", "b", "d"} and got["a"].n == 60
    assert all(np.isfinite(r.coef).all() for r in got.values()) and abs(got["a"].coef[2]) < 1e-9
    assert models.softmax_fit(df.filter("false"), ["g"], ["x"], "y", 2).count() == 0


def test_refits_against_numpy(spark):
    rows = probabilities.refit_rows(spark, SF).toPandas()
    names = list(probabilities.PARTS)
    loss = {}
    for part, g in rows.groupby("part"):
        fit, later = g[g.yr <= probabilities.LEARN_UNTIL], g[g.yr > probabilities.LEARN_UNTIL].copy()
        later["p"] = newton(fit[names].to_numpy(float), fit.won.to_numpy(int), 2)(later[names].to_numpy(float))[:, 1]
        later["loss"] = -np.log(later.p / later.groupby("event").p.transform("sum"))
        loss[part] = later[later.won == 1].groupby("yr").loss.agg(["sum", "count"])
    got = {r.part: r for r in registry.queries()["E18_refits"](spark, SF).collect()}
    assert set(got) == set(names)
    for part, r in got.items():
        delta = loss[part]["sum"] - loss["none"]["sum"]
        assert r.n == loss[part]["count"].sum() and r.years == len(delta) and r.years_up == (delta > 0).sum()
        assert abs(r.delta - delta.sum() / r.n) < 2e-6


def test_logit_pool_by_plain_newton_steps(spark):
    rows = probabilities.probs(spark, SF).select("event", "p", "price", "won").toPandas()
    rows["x"], rows["y"] = np.log(rows.p), np.log(rows.price / rows.groupby("event").price.transform("sum"))
    b = np.array([1.0, 0.0])
    for _ in range(6):
        e = np.exp(rows[["x", "y"]].to_numpy() @ b)
        w = e / rows.assign(e=e).groupby("event").e.transform("sum").to_numpy()
        v = rows[["x", "y"]].to_numpy()
        mean = rows[["event"]].assign(mx=w * v[:, 0], my=w * v[:, 1]).groupby("event")[["mx", "my"]].transform("sum").to_numpy()
        gradient = ((rows.won.to_numpy(float) - w)[:, None] * v).sum(0)
        hessian = (w[:, None, None] * (v - mean)[:, :, None] * (v - mean)[:, None, :]).sum(0)
        b = b + np.linalg.solve(hessian, gradient)
    got = registry.queries()["E6_logit_pool"](spark, SF).first()
    assert got.n == len(rows) and abs(got.a - b[0]) < 2e-3 and abs(got.b - b[1]) < 2e-3


def test_isotonic_is_monotone_and_keeps_the_mean(spark):
    from tidemark.operators.probability import isotonic

    cells = spark.createDataFrame([("a", i, n, h, i / 10) for i, (n, h) in enumerate([(10, 1), (10, 5), (10, 3), (20, 4), (5, 5)])] + [("b", 3, 4, 1, 0.3)], "f string, cell long, n long, h long, x double")
    got = {(r.f, r.cell): r.y for r in isotonic(cells, "f", "cell").collect()}
    ys = [got["a", i] for i in range(5)]
    assert ys == sorted(ys) and ys[0] == 0.1 and ys[1] == ys[2] == ys[3] == 12 / 40 and ys[4] == 1.0 and got["b", 3] == 0.25
