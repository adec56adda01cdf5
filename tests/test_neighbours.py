"""Nearest rows of another group against all pairs: cells of any size, ties, one-group stretches, picks without any."""

import hashlib
import random

import pytest

from tidemark.operators.neighbours import nearest_other

SCHEMA = "ev long, r int, p double, ratio double, sel boolean"


def plain(rows):
    out = {}
    place = lambda x: (x[2], hashlib.md5(f"7:{x[0]}:{x[1]}".encode()).hexdigest(), x[0], x[1])
    rows = [x for x in rows if x[0] is not None and x[2] is not None]
    for x in (x for x in rows if x[4]):
        free = [y for y in rows if not y[4] and y[0] != x[0]]
        low = max((y for y in free if place(y) < place(x)), key=place, default=None)
        high = min((y for y in free if place(y) > place(x)), key=place, default=None)
        s = low if low and (not high or x[2] - low[2] <= high[2] - x[2]) else high
        out[x[0], x[1]] = s and s[:4]
    return out


@pytest.mark.parametrize("cell_rows", [5, 40, 10_000])
@pytest.mark.parametrize("hot", [False, True])
def test_against_pairs(spark, cell_rows, hot):
    r = random.Random(cell_rows)
    rows = [(1 if hot and r.random() < 0.8 else r.randint(1, 30), i, r.choice([r.random(), 0.25, 0.5]), float(i), r.random() < 0.2) for i in range(300)]
    rows += [(99, i, 0.6 + i / 1000, 0.0, i % 9 == 0) for i in range(60)]  # cells of a single group
    rows += [(None, 1, 0.3, 0.0, False), (5, 1000, None, 0.0, False), (6, 1001, 0.4, None, None)]
    got = nearest_other(spark.createDataFrame(rows, SCHEMA), key="p", group="ev", ids=["r"], pick="sel", carry=["ratio"], cell_rows=cell_rows).collect()
    assert {(x.ev, x.r): (x.s_ev, x.s_r, x.s_p, x.s_ratio) if x.s_ev is not None else None for x in got} == plain(rows) and len(got) == sum(bool(x[4]) for x in rows)


def test_none_to_find(spark):
    rows = [(1, 1, 0.5, 1.0, True), (1, 2, 0.5, 1.0, False), (2, 1, 0.5, 1.0, True)]
    got = {x.ev: x.s_ev for x in nearest_other(spark.createDataFrame(rows, SCHEMA), key="p", group="ev", ids=["r"], pick="sel").collect()}
    assert got == {1: None, 2: 1}
    assert nearest_other(spark.createDataFrame([], SCHEMA), key="p", group="ev", ids=["r"], pick="sel").count() == 0


def test_only_picks_and_edges_are_written(spark, monkeypatch):
    """Rows that are no picks are sorted once and not written: 4 a cell at most."""
    from tidemark.operators import neighbours

    seen, plain_written = [], neighbours.written
    monkeypatch.setattr(neighbours, "written", lambda df, name: (seen.append((out := plain_written(df, name)).count()), out)[1])
    rows = [(i, 0, i / 2000, float(i), i % 20 == 0) for i in range(2000)]
    assert nearest_other(spark.createDataFrame(rows, SCHEMA), key="p", group="ev", ids=["r"], pick="sel", cell_rows=500).count() == 100
    assert len(seen) == 1 and seen[0] <= 100 + 4 * 4
