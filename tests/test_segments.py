"""Points around rows, time segments of ticks and payout coefficients, against plain Python."""

import random
from statistics import median

from pyspark.sql import functions as F

from tidemark.operators import asof, probability, ticks

POINTS = "k string, t long, v double"


def test_around_against_pairs(spark):
    r = random.Random(5)
    pick = lambda: r.choice(["a", "a", "b", None])
    points = [(pick(), r.choice([None, r.randint(-60, 60)]), r.choice([None, 0.5, 1.25, 7.0])) for _ in range(300)]
    rows = [(i, pick(), r.choice([None, r.randint(-80, 80)])) for i in range(80)]
    for before, after in ((5, 9), (0, 1), (30, 0)):
        out = asof.around(spark.createDataFrame(rows, "id int, k string, t long"), spark.createDataFrame(points, POINTS), by=["k"], key=["id"], at="t", value="v", before=before, after=after)
        got = {x.id: (x.n, x.total and float(x.total)) for x in out.collect()}
        want = {}
        for i, k, t in rows:
            near = [v for k2, u, v in points if None not in (k, t, u, v) and k == k2 and t - before <= u <= t + after]
            want[i] = (len(near), sum(near) if near else None)
        assert got == want


def test_around_without_rows_or_points(spark):
    none, some = spark.createDataFrame([], "id int, " + POINTS), spark.createDataFrame([(1, "a", 3, 2.0)], "id int, " + POINTS)
    args = {"by": ["k"], "key": ["id"], "at": "t", "value": "v", "before": 1, "after": 1}
    assert asof.around(none, some, **args).count() == 0
    assert [tuple(r) for r in asof.around(some, none, **args).collect()] == [(1, 0, None)]


def test_segments_take_the_last_tick_and_the_first(spark):
    rows = [("x", 1, 10, 5.0), ("x", 2, 20, 4.0), ("x", 3, 20, 3.0), ("x", 4, 90, None), ("x", 5, 95, 2.0), ("y", 6, 50, 9.0), ("z", 7, 1, None)]
    df = spark.createDataFrame(rows, "g string, id int, ts int, value double")
    got = ticks.segment_values(df, ["g"], F.when(F.col("ts") < 50, "early").otherwise("late"))
    assert sorted(map(tuple, got.collect())) == [("x", "early", 3.0), ("x", "first", 5.0), ("x", "late", 2.0), ("y", "first", 9.0), ("y", "late", 9.0)]


def test_coefficients_are_of_earlier_days_only(spark):
    r = random.Random(2)
    winners = [(r.choice("ab"), r.randint(1, 12), r.choice([0.0, 2.0, 3.0, 5.0]), r.choice([2.0, 4.0, None])) for _ in range(120)]
    prices = [(b, d, 1.0) for b in "abc" for d in range(1, 16)] * 2
    got = probability.payout_coefficients(spark.createDataFrame(prices, "b string, d int, price double"), spark.createDataFrame(winners, "b string, d int, price double, payout double"), by=["b"], day="d", days=4, least=3)
    want = set()
    for b, d, _ in prices:
        past = [w / p for b2, e, p, w in winners if b2 == b and d - 4 <= e < d and p and w is not None]
        if len(past) >= 3:
            want.add((b, d, len(past), round(median(past), 9)))
    rows = got.collect()
    assert {(x.b, x.d, x.n, round(x.coef, 9)) for x in rows} == want and len(rows) == len(want)
