"""Alternating medians of packed groups against joins: nulls, ties, copies, one level; a step moves no rows."""

import random

import pytest

from tidemark.operators import baseline

SCHEMA = "a string, b int, c long, x double"


def rows_of(n, seed):
    r = random.Random(seed)
    return [(r.choice(["p", "q", "r", None]), r.choice([1, 2, 3, 4, 5, None]), r.randint(1, 2), r.choice([None, float("nan"), float(r.randint(0, 50)), 7.25])) for _ in range(n)]


@pytest.mark.parametrize("copies", [1, 3])
def test_equal_to_joins(spark, copies):
    rows = spark.createDataFrame(rows_of(300, copies) * copies + [("lone", 9, 1, None)], SCHEMA)
    moved = [{}, {}]
    packed, joined = (baseline.alternating_medians(rows, ["a", "b"], "x", 3, small=s, moved=m) for s, m in zip((40, 10_000), moved, strict=True))
    for f in ("a", "b"):
        assert packed[f].schema.names == joined[f].schema.names
        assert sorted(map(str, packed[f].collect())) == sorted(map(str, joined[f].collect()))
    assert moved[0] == pytest.approx(moved[1])


def test_rounds_write_nothing(spark, monkeypatch):
    """More rounds read the packed groups again and write no more tables."""
    seen, real = [], baseline.written
    monkeypatch.setattr(baseline, "written", lambda df, name: (seen.append(name), real(df, name))[1])
    rows = spark.createDataFrame(rows_of(50, 5), SCHEMA)
    for rounds in (1, 4):
        baseline.alternating_medians(rows, ["a", "b"], "x", rounds, small=5)
        seen.append("|")
    one, four = " ".join(seen).split("|")[:2]
    assert one.split() == four.split()
