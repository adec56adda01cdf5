"""Ratings by day against plain Python: blocks of any size, ties, single entrants, missing ranks, empty tables."""

import math
import random

import pytest

from tidemark.operators import daily

ROWS = [(d, d * 100 + e, who, rank) for d, e, who, rank in [(1, 1, 1, 1.0), (1, 1, 2, 2.0), (1, 1, 3, 2.0), (1, 2, 1, 2.0), (1, 2, 4, 1.0), (3, 1, 2, 1.0), (4, 1, 2, 1.0), (4, 1, 4, None), (9, 1, 3, 1.0), (9, 1, 1, 2.0), (9, 2, 5, 1.0), (9, 2, 2, 3.0), (9, 2, 1, 3.0)]]


def many(seed, n_days=40):
    r = random.Random(seed)
    return [(d, d * 100 + e, who, float(k)) for d in range(n_days) for e in range(r.randint(0, 4)) for k, who in enumerate(r.sample(range(30), r.randint(1, 9)))]


def plain(rows, glicko):
    rating, dev, since, out = {}, {}, {}, {}
    q = math.log(10) / 400
    rows = [x for x in rows if x[3] is not None]
    for day in sorted({x[0] for x in rows}):
        here = [x for x in rows if x[0] == day]
        r = {w: rating.get(w, 1500.0) for _, _, w, _ in here}
        v = {w: min(350.0, math.sqrt(dev.get(w, 350.0) ** 2 + 900 * (day - since.get(w, day)) / 30)) for w in r}
        move, up, info = dict.fromkeys(r, 0.0), dict.fromkeys(r, 0.0), dict.fromkeys(r, 0.0)
        for event in {x[1] for x in here}:
            field = [(x[2], x[3]) for x in here if x[1] == event]
            for a, i in field:
                for b, j in field:
                    if a != b:
                        move[a] += 32 / (len(field) - 1) * ((i < j) + 0.5 * (i == j) - 1 / (1 + 10 ** ((r[b] - r[a]) / 400)))
                        g = 1 / math.sqrt(1 + 3 * q * q * v[b] ** 2 / math.pi**2)
                        e = 1 / (1 + 10 ** (-g * (r[a] - r[b]) / 400))
                        up[a] += 3 / (len(field) - 1) * g * (0.5 + max(-3, min(3, j - i)) / 6 - e)
                        info[a] += 3 / (len(field) - 1) * q * q * g * g * e * (1 - e)
        for w in r:
            low = 1 / (1 / v[w] ** 2 + info[w])
            rating[w] = r[w] + (q * low * up[w] if glicko else move[w])
            out[w, day] = (r[w], rating[w], v[w], math.sqrt(low)) if glicko else (r[w], rating[w])
            dev[w], since[w] = math.sqrt(low), day
    return out


@pytest.mark.parametrize("most", [4, 20, 10_000])
@pytest.mark.parametrize("glicko", [False, True])
def test_by_day(spark, glicko, most):
    for rows in (ROWS, many(most)):
        df = spark.createDataFrame(rows, "day int, event long, who int, place double").repartition(3)
        got = daily.ratings_by_day(df, daily.Glicko() if glicko else daily.Elo(), day="day", event="event", entity="who", rank="place", block_rows=most).collect()
        names = ("before_rating", "rating", "before_dev", "dev") if glicko else ("before_rating", "rating")
        want = plain(rows, glicko)
        assert len(got) == len(want)
        for r in got:
            assert [r[c] for c in names] == pytest.approx(want[r.entity, r.day], abs=1e-8)


def test_empty_and_a_large_field(spark, monkeypatch):
    df = spark.createDataFrame([], "day int, event long, who int, place double")
    assert daily.ratings_by_day(df, daily.Elo(), day="day", event="event", entity="who", rank="place").count() == 0
    monkeypatch.setattr(daily, "CELLS", 50)
    rows = [(1, 1, w, float(w)) for w in range(40)]
    idx = next(daily.fields(daily.np.array([0]), daily.np.array([40])))
    (s,) = daily.opponents(idx, lambda i, j: [(i < j).astype(float)])
    assert s.tolist() == [[39.0 - w for w in range(40)]] and plain(rows, False)[0, 1][1] == pytest.approx(1516)


def test_a_block_reads_what_was_left_for_it(spark):
    """Each row knows the next block of its entity, so that a block's state is one folder, not all blocks before it."""
    rows = spark.createDataFrame([(d, d, who, 1.0, b) for d, who, b in [(1, 1, 0), (1, 2, 0), (2, 1, 0), (3, 2, 1), (4, 1, 2), (4, 3, 2)]], "day long, event long, entity long, rank double, block int")
    read, sizes = daily.dealt_out(rows, daily.new_path(spark, "t"), "day long, event long, entity long, rank double")
    got = {b: sorted({(r.entity, r.next) for r in read(b).collect()}) for b in sizes}
    assert sizes == {0: 3, 1: 1, 2: 2} and got == {0: [(1, 2), (2, 1)], 1: [(2, daily.NONE)], 2: [(1, daily.NONE), (3, daily.NONE)]}
