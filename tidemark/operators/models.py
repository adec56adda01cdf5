"""Regressions of many groups at once: one aggregation a Newton step sums every group's gradient and Hessian, the small
systems are solved one row a group, and no group's rows are ever gathered."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .baseline import written

#: Groups whose coefficients are sent to every task; more are joined by a shuffle.
BROADCAST_GROUPS = 10_000


def _joined(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    return rows.join(F.broadcast(groups) if few else groups, list(by))


def chances(coef: Column, x: Sequence[Column], classes: int) -> list[Column]:
    """Softmax probabilities of all classes, the first one's score being 0. coef: array of the others' weights, one class
    after the other, in the order of x."""
    scores = [F.lit(0.0)]
    for k in range(classes - 1):
        scores.append(sum((F.get(coef, F.lit(k * len(x) + i)) * c for i, c in enumerate(x)), F.lit(0.0)))
    top = F.greatest(*scores)
    e = [F.exp(s - top) for s in scores]
    total = sum(e[1:], e[0])
    return [v / total for v in e]


def scales(rows: DataFrame, by: Sequence[str], features: Sequence[str]) -> DataFrame:
    """by, means, sds (arrays in the order of the features) and n; a feature that doesn't vary has sd 1."""
    sd = lambda c: F.when(F.stddev_pop(c) > 1e-12, F.stddev_pop(c)).otherwise(1.0)
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.array(*[F.avg(c) for c in features]).alias("means"), F.array(*[sd(c) for c in features]).alias("sds"))


def standard(features: Sequence[str]) -> list[Column]:
    """1 and the features less their group's mean in its deviations (columns means, sds)."""
    return [F.lit(1.0), *[(F.col(c) - F.get("means", F.lit(i))) / F.get("sds", F.lit(i)) for i, c in enumerate(features)]]


def softmax_fit(
    rows: DataFrame, by: Sequence[str], features: Sequence[str], label: str, classes: int, *, ridge: float = 1.0, steps: int = 30, tolerance: float = 1e-8
) -> DataFrame:
    """by, n, means, sds, coef: a multinomial logistic regression for each group, by Newton's steps.

    label: 0 to classes - 1; class 0 has score 0. Features are standardised within their group; ridge / 2 times the sum of
    squares is added to the loss, of intercepts a hundredth of it, so that a class that a group lacks has finite weights.
    Rows with a null label or feature take no part. `chances` of `standard` features gives the probabilities.
    """
    rows = rows.select(*by, *[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("int").alias("__y")).dropna(subset=[*features, "__y"])
    rows = written(rows, "model-rows")
    size = (classes - 1) * (len(features) + 1)
    pull = np.tile([ridge / 100, *[ridge] * len(features)], classes - 1)
    state = written(scales(rows, by, features).withColumn("coef", F.array(*[F.lit(0.0)] * size)), "model")
    x, upper = standard(features), np.triu_indices(size)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            g, h, b = (np.array(batch.column(c).to_pylist(), np.float64).reshape(batch.num_rows, -1) for c in ("__g", "__h", "coef"))
            full = np.zeros((len(g), size, size))
            full[:, upper[0], upper[1]] = h
            full[:, upper[1], upper[0]] = h
            move = np.linalg.solve(full + np.diag(pull), (g - pull * b)[:, :, None])[:, :, 0]
            keep = [batch.column(c) for c in (*by, "n", "means", "sds")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array((b + move).tolist(), pa.list_(pa.float64())), pa.array(np.abs(move).max(1))], [*by, "n", "means", "sds", "coef", "moved"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = ", ".join(f"{c} {kinds[c]}" for c in by) + ", n long, means array<double>, sds array<double>, coef array<double>, moved double"
    for _ in range(steps):
        p = chances(F.col("coef"), x, classes)
        told = _joined(rows, state.select(*by, "means", "sds", "coef"), by).select(*by, "__y", F.array(*x).alias("__x"), F.array(*p[1:]).alias("__p"))
        place = [(k, i) for k in range(classes - 1) for i in range(len(x))]
        at = lambda c, i: F.get(c, F.lit(i))
        g = [F.sum(((F.col("__y") == k + 1).cast("double") - at("__p", k)) * at("__x", i)) for k, i in place]
        h = [F.sum(at("__p", place[a][0]) * ((1.0 if place[a][0] == place[b][0] else 0.0) - at("__p", place[b][0])) * at("__x", place[a][1]) * at("__x", place[b][1])) for a, b in zip(*upper, strict=True)]
        sums = told.groupBy(*by).agg(F.array(*g).alias("__g"), F.array(*h).alias("__h"))
        moved = written(state.join(sums, list(by)).select(*by, "n", "means", "sds", "coef", "__g", "__h").mapInArrow(solve, out), "model")
        state = moved.drop("moved")
        if (moved.agg(F.max("moved")).first()[0] or 0.0) < tolerance:
            break
    return state


def score(rows: DataFrame, model: DataFrame, by: Sequence[str], features: Sequence[str], names: Sequence[str]) -> DataFrame:
    """rows with each class's probability under its group's model in the columns `names`; groups without a model go."""
    m = model.select(*by, "means", "sds", "coef")
    p = chances(F.col("coef"), standard(features), len(names))
    return _joined(rows, m, by).select(*rows.columns, *[c.alias(n) for c, n in zip(p, names, strict=True)])
