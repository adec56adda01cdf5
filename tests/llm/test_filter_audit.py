"""The filter audit against plain Python: words, symbols, ties, nulls, empties, repeats, clashing columns, empty tables."""

from itertools import permutations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import filter_audit as fa

LONG = "Aß " * 60_000 + "x" * 100_000


def words_of(text):
    cut = [""]
    for c in text.encode():
        if c == 0x20 or 9 <= c <= 13:
            cut.append("")
        else:
            cut[-1] += chr(c)
    return [w for w in cut if w]


def plain(text):
    w = words_of(text)
    return [len(w), len(set(w)), sum("A" <= c <= "Z" for c in text), len(text), sum(c in "#$%&*|" for c in text)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aAbB \t\n\u000b ß€\U0001f600#$|", max_size=60), max_size=8))
def test_counts_are_those_of_plain_python(texts):
    got = fa.count_texts(pa.array(texts, pa.string()))
    assert [list(map(int, x)) for x in zip(*got, strict=True)] == [plain(t or "") for t in texts]


def test_a_slice_of_an_array_and_long_texts():
    texts = ["one one", LONG, None, "", "two words " * 3, "ends in space "]
    got = fa.count_texts(pa.array(texts, pa.string()).slice(1, 5))
    assert [list(map(int, x)) for x in zip(*got, strict=True)] == [plain(t or "") for t in texts[1:]]


def test_equal_hashes_are_told_apart_by_their_bytes():
    data = np.frombuffer(b"abcdefghij abcdefghik abcdefghij", np.uint8)
    t = fa.SpanTable(data, np.array([0, 11, 22]), np.array([10, 10, 10]), np.zeros(3, np.int64))
    t.hashes = np.zeros(3, np.uint64)
    assert t.firsts().sum() == 2


def brute(rows, labels):
    first, good, toxic = {}, {}, {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    for i, q, t in labels:
        if i is not None:
            good[i], toxic[i] = good.get(i, False) or q == 1, toxic.get(i, False) or t == 1
    fails = []
    for i, text, part in rows:
        n, d, caps, points, symbols = plain(text or "")
        bad = {"A": n < 200, "B": 100 * d < 50 * n, "C": 100 * caps > 2 * points, "D": symbols > 0, "E": i is not None and i > first[text or ""]}
        fails.append((part or "", {x for x in bad if bad[x]}, good.get(i, False), toxic.get(i, False)))
    out = {}
    for part in {f[0] for f in fails}:
        mine, shapley = [f for f in fails if f[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            gone = [False] * len(mine)
            for step, x in enumerate(order, 1):
                now = [not g and x in f[1] for g, f in zip(gone, mine, strict=True)]
                out[part, "".join(order), step] = [
                    sum(not g and not n for g, n in zip(gone, now, strict=True)), sum(now), sum(g and x in f[1] for g, f in zip(gone, mine, strict=True)),
                    sum(f[1] == {x} for f in mine), sum(n and f[2] for n, f in zip(now, mine, strict=True)), sum(n and f[3] for n, f in zip(now, mine, strict=True)),
                ]
                shapley[x] += sum(now)
                gone = [g or n for g, n in zip(gone, now, strict=True)]
        for order in permutations("ABCDE"):
            for step, x in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[x])
    return out


def test_audit_against_brute_force(spark):
    many = " ".join(f"w{i}" for i in range(250))
    rows = [
        (1, many, "a"), (2, many, "a"), (3, many + " $", "a"), (4, "same " * 300, "a"), (5, None, "a"), (6, "", "b"), (7, "SHOUT " * 300, "b"), (8, LONG, "b"), (8, LONG, None),
        (None, many, "a"), (None, "", None), (9, "  \n", ""), (10, "A#" * 5, None), (2, many, "a"), (1, many, "b"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (3, None, 1), (3, 1, None), (None, 1, 1), (7, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.select("*", *[F.lit(1).alias(c) for c in ("id", "part", "sha", "mask", "n", "words", "cells", "quality", "__id")])
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = fa.audit(docs, said).collect()
    cols = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r.part, r.filter_order, r.step): [r[c] for c in cols] for r in got} == brute(rows, labels)
    assert fa.audit(docs.filter("false"), said).count() == 0
    assert fa.audit(docs.filter("doc_id = 1"), said.filter("false")).count() == 1200
