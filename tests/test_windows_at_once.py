"""Windows answered many at a time: waiting rows of any number, groups that go on, weights; facts are not doubled."""

import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import rolling
from tidemark.plans import baselines

SCHEMA = "k string, d int, v double"


def plain(stat, held, v):
    if not held or (stat != "median" and v is None):
        return None
    return median(held) if stat == "median" else (sum(w < v for w in held) + sum(w == v for w in held) / 2) / len(held)


@pytest.mark.parametrize("chunk", [3, 50, 10_000])
@pytest.mark.parametrize("stat", ["median", "share_below"])
def test_waiting_rows_of_any_number(spark, monkeypatch, chunk, stat):
    monkeypatch.setattr(rolling, "CHUNK", chunk)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    r = random.Random(chunk)
    make = lambda n: [(r.choice(["a", "b", "c", None]), r.randint(-30, 30), r.choice([None, -0.0, 0.0, float("inf"), *map(float, range(9))])) for _ in range(n)]
    probes, facts = make(80), make(300)
    try:
        got = rolling.rolling(spark.createDataFrame(probes, SCHEMA), spark.createDataFrame(facts, SCHEMA), by=["k"], day="d", value="v", days=8, stat=stat).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = []
    for k, d, v in probes:
        held = [w for q, e, w in facts if q == k and w is not None and d - 8 <= e < d]
        out = plain(stat, held, v)
        want.append((k, d, v, len(held), None if out is None else out + 0.0))
    assert sorted(map(str, want)) == sorted(str((x.k, x.d, x.v, x.window_n, None if x.window is None else x.window + 0.0)) for x in got)


@pytest.mark.parametrize("weights", [1, 9])
def test_ranks_and_places_of_runs(weights):
    r = np.random.default_rng(weights)
    codes, times = r.permutation(100), r.integers(1, weights + 1, 100)
    lo = r.integers(0, 100, 200)
    hi = lo + r.integers(1, 101 - lo)
    given = None if weights == 1 else times
    for a, b, got_low, got_high in zip(lo, hi, rolling.by_rank(codes, given, 7, lo, hi, np.zeros(200, int)), rolling.below(codes, given, 7, lo, hi, np.full(200, 40)), strict=True):
        assert got_low == codes[a:b].min() and got_high == times[a:b][codes[a:b] < 40].sum()


def test_facts_of_small_keys_are_not_doubled(spark, monkeypatch):
    rows = spark.range(500).select((F.col("id") % 5).alias("k"), (F.col("id") % 97).cast("int").alias("d"), F.col("id").cast("double").alias("v"))
    seen, real = [], rolling._answers
    monkeypatch.setattr(rolling, "_answers", lambda asked, known, *rest: (seen.append(known.count()), real(asked, known, *rest))[1])
    assert rolling.rolling(rows.select("k", "d").distinct(), rows, by=["k"], day="d", value="v", days=10).count() == 485
    assert seen == [500]


def test_baselines_compute_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(300).selectExpr("id AS event", "id % 3 AS venue", "id % 2 AS going", "id % 5 AS class", "cast(id % 50 AS int) AS d_idx", "double(id) AS price")
    out = baselines.bl.asof_medians(rows.mapInArrow(run, rows.schema), baselines.LEVELS, day="d_idx", value="price")
    assert out.count() == 300 == seen.value
