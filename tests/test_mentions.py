"""Mentions by a dated roster against plain Python: forms, role words, versions, names of several words, slices."""

import random

from tidemark.operators import mentions

ROSTER = [(10, "rider", "an bo"), (10, "trainer", "an bo"), (10, "rider", "cad"), (20, "rider", "cad"), (20, "rider", "cade"), (20, "trainer", "éa b"), (20, "rider", "x"), (20, None, "cadx"), (20, "rider", None), (20, "rider", "cad"), (None, "rider", "zzz")]
ROLES = {"rider": "R", "trainer": "T"}


def places(text, roster, gap, near):
    out = set()
    for kind, name in roster:
        if kind is None or name is None or len(name) < 2:
            continue
        spans = [(i, i + len(name)) for i in range(len(text)) if text.startswith(name, i)]
        if not spans:
            for i in range(len(text)):
                if text.startswith(name[:-1], i):
                    rest = text[i + len(name) - 1 :][:gap]
                    if name[-1] in rest:
                        spans.append((i, i + len(name) + rest.index(name[-1])))
        for a, b in spans:
            out.add((kind, name, a, ROLES[kind] in text[max(0, a - near) : a] or ROLES[kind] in text[b : b + near]))
    return out


def test_against_plain_python(spark):
    r = random.Random(4)
    bits = ["an bo", "an b.o", "cad", "ca-d", "cade", "ca", "éa b", "éa x", "T", "R", " ", "...", "caca", "an ban bo"]
    texts = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 9))), r.choice([5, 10, 15, 20, 30])) for i in range(150)] + [(900, None, 20), (901, "cad", None), (902, "cad" * 5000, 20)]
    df, roster = spark.createDataFrame(texts, "id int, body string, day int"), spark.createDataFrame(ROSTER, "since int, kind string, name string")
    want = set()
    for i, t, d in texts:
        version = None if t is None or d is None or d < 10 else 20 if d >= 20 else 10
        want |= {(i, *p) for p in places(t or "", [(k, n) for s, k, n in ROSTER if s == version and s], 4, 3)}
    args = {"key": "id", "text": "body", "day": "day", "since": "since", "roles": ROLES, "gap": 4, "near": 3}
    for names in (100, 2):
        got = [tuple(x) for x in mentions.mentions(df, roster, **args, names=names).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    sole = {x.id: x for x in mentions.one_person(mentions.mentions(df, roster, **args), "id").collect()}
    for i in {w[0] for w in want}:
        mine = [w for w in want if w[0] == i]
        best = [w for w in mine if w[4] == max(m[4] for m in mine)]
        people = {w[1:3] for w in best}
        assert sole[i].persons == len(people) and sole[i].near == best[0][4]
        assert (sole[i].kind, sole[i].name, sole[i].at) == ((*best[0][1:3], min(w[3] for w in best)) if len(people) == 1 else (None, None, None))
    assert set(sole) == {w[0] for w in want}


def test_empty_tables(spark):
    texts, roster = spark.createDataFrame([(1, "cad", 20)], "id int, body string, day int"), spark.createDataFrame(ROSTER, "since int, kind string, name string")
    args = {"key": "id", "text": "body", "day": "day", "since": "since", "roles": ROLES}
    assert mentions.mentions(texts.limit(0), roster, **args).count() == 0
    assert mentions.mentions(texts, roster.limit(0), **args).count() == 0
