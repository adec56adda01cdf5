"""Unique candidates by elimination: chains, shared and taken abbreviations, zeros, nulls, repeats, empty tables."""

import random

from tidemark.operators.matching import unique_candidates


def run(spark, people, candidates, counted):
    p, c, n = spark.createDataFrame(people, "person int, official int"), spark.createDataFrame(candidates, "person int, short string"), spark.createDataFrame(counted, "short string, n long")
    got = unique_candidates(p, c, n).collect()
    assert len({r.person for r in got}) == len(got)
    return {r.person: (r.short, r.why, r["round"]) for r in got}


def test_chain_of_three(spark):
    people = [(1, 5), (2, 5), (3, 5), (4, 0), (5, None), (6, 9), (7, 2), (8, 2), (9, 5), (10, 3), (10, 3)]
    candidates = [(1, "a"), (2, "a"), (2, "b"), (3, "b"), (3, "c"), (4, "z"), (6, "a"), (6, None), (7, "s"), (8, "s"), (9, "a"), (9, "b"), (10, "m"), (10, "n"), (10, "m"), (11, "c")]
    counted = [("a", 5), ("b", 5), ("c", 5), ("s", 2), ("z", 0), ("m", 3), ("n", 3)]
    assert run(spark, people, candidates, counted) == {
        1: ("a", "accepted", 1), 2: (None, "shared", None), 9: (None, "shared", None), 3: (None, "many", None), 4: (None, "zero", None), 5: (None, "zero", None),
        6: (None, "nomatch", None), 7: (None, "shared", None), 8: (None, "shared", None), 10: (None, "many", None),
    }
    people, candidates = [p for p in people if p[0] != 9], [c for c in candidates if c[0] != 9]
    got = run(spark, people, [*candidates, (12, "a")], counted)
    assert [got[i] for i in (1, 2, 3)] == [("a", "accepted", 1), ("b", "accepted", 2), ("c", "accepted", 3)] and 12 not in got
    assert run(spark, [*people, (12, 5), (13, 5)], [*candidates, (13, "a"), (13, "b"), (12, "d")], counted)[13] == (None, "shared", None)
    assert run(spark, [(1, 5), (2, 5), (3, 5)], [(1, "a"), (2, "b"), (3, "a"), (3, "b")], counted)[3] == (None, "taken", None)


def test_against_plain(spark):
    r = random.Random(3)
    people = [(i, r.randint(1, 3)) for i in range(60)]
    counted = [(f"s{i}", r.randint(1, 3)) for i in range(60)]
    candidates = [(i, f"s{(i + r.choice([0, 0, 1, 2, 5])) % 60}") for i in range(60) for _ in range(3)]
    n, official = dict(counted), dict(people)
    left, want = {p: {s for q, s in candidates if q == p and n[s] == official[p]} for p in official}, {}
    for number in range(1, 100):
        only = [(p, next(iter(s))) for p, s in left.items() if len(s) == 1]
        sure = [(p, s) for p, s in only if sum(t == s for _, t in only) == 1]
        if not sure:
            break
        want |= {p: (s, number) for p, s in sure}
        left = {p: s - {t for _, t in sure} for p, s in left.items() if p not in want}
    assert max(k for _, k in want.values()) >= 2
    got = run(spark, people, candidates, counted)
    assert {p: (s, k) for p, (s, why, k) in got.items() if why == "accepted"} == want


def test_empty(spark):
    assert run(spark, [], [], []) == {} and run(spark, [(1, 2)], [], []) == {1: (None, "nomatch", None)}
