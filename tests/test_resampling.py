"""Resampled sums: weights against hashlib, sums against rows for every cluster and resample, plans without such rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import probability, resampling
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"


def test_weights_are_md5(monkeypatch):
    def plain(key, r):
        u = int(hashlib.md5(f"7:{key}:{r}".encode()).hexdigest()[:8], 16) / 2**32
        return sum(u >= c for c in probability.POISSON_ONE)

    keys = np.array([0, 9, 10, -1, -25, 4711, 123456, 54_000_000, 2**31, 10**12 + 7, 2**63 - 1, -(2**63), *range(995, 1010)])
    want = [[plain(int(k), r) for r in range(1001)] for k in keys]
    assert resampling.poisson_weights(keys, 1001).tolist() == want
    monkeypatch.setattr(resampling, "BLOCK", 4)  # keys of a length and resamples in several blocks
    assert resampling.poisson_weights(keys, 101).tolist() == [w[:101] for w in want]
    assert resampling.poisson_weights(keys[:0], 5).shape == (0, 5)


@pytest.mark.parametrize("bound", [resampling.BOUND, 50])
def test_sums_of_all_resamples(spark, bound):
    r = random.Random(2)
    rows = [(r.randint(-20, 150), r.choice([None, 1, 2]), r.choice(["a", "b", None]), r.randint(0, 3), float(r.randint(0, 50))) for _ in range(900)]
    df = spark.createDataFrame(rows, "c int, g int, h string, n int, x double").repartition(3)
    each = df.withColumn("r", F.explode(F.sequence(F.lit(-1), F.lit(11))))
    w = F.when(F.col("r") < 0, 1).otherwise(probability.poisson_weight(F.col("c"), F.col("r")))
    want = each.groupBy("g", "h", "r").agg(F.sum(w * F.col("n")).cast("double").alias("n"), F.sum(w * F.col("x")).alias("x"))
    got = resampling.resampled_sums(df, "c", ["g", "h"], ["n", "x"], 12, bound=bound)
    assert got.columns == want.columns
    tell = lambda f: sorted(map(str, f.collect()))
    assert tell(got) == tell(want) and got.count() == 9 * 13
    assert resampling.resampled_sums(df.filter("c > 999"), "c", ["g"], ["n"], 12).collect() == []


@pytest.mark.parametrize("name", ["B17_event_bootstrap", "E12_clusters"])
def test_no_row_for_each_cluster_and_resample(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert "md5(" not in plan and "sequence(" not in plan
