"""Encounters against plain Python: every pair of different participants of an event, whatever their places or numbers."""

from tidemark.plans.joins import pairs


def test_all_encounters_are_kept(spark):
    events = {1: [(7, 3), (5, 1), (9, 2)], 2: [(5, 2), (7, 1)], 3: [(4, 1), (4, 2), (3, 3)]}  # (rider, finish), in the order of numbers
    rows = [(e, 10 * e, k, r, f) for e, field in events.items() for k, (r, f) in enumerate(field, 1)]
    df = spark.createDataFrame(rows, "event long, d_idx int, runner_no int, rider long, finish int")
    want = sorted((e, a, b, f < g, g - f) for e, field in events.items() for a, f in field for b, g in field if a < b)
    assert sorted((r.event, r.one, r.two, r.won, r.gap) for r in pairs(df).collect()) == want and len(want) == 6
