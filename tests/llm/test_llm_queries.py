"""The registered queries on the smallest tables, against DuckDB, the library or a brute-force version."""

import hashlib
import math
import zlib
from pathlib import Path

import numpy as np
import pytest

from tidemark import llm
from tidemark.llm import bpe, language_id, mixing

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    return f"{v:.12g}" if isinstance(v, float) else str(v)


def rows_of(df):
    return sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_against_duckdb(spark, duck, name):
    got = llm.QUERIES[name](spark, SF)
    want = duck.execute(llm.ORACLES[name])
    names = [c[0] for c in want.description]
    order = [names.index(c) for c in sorted(names)]
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got) == sorted(tuple(plain(r[i]) for i in order) for r in want.fetchall())


def documents(duck):
    return duck.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path())
    return t, [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_op2_and_op9_against_the_library(spark, duck):
    docs = documents(duck)
    t, coded = library([x[1] or "" for x in docs])
    two = {r.doc_id: r for r in llm.QUERIES["op2_bpe"](spark, SF).collect()}
    nine = {r.doc_id: r for r in llm.QUERIES["op9_token_store"](spark, SF).collect()}
    at = 0
    for (i, *_), ids in zip(docs, coded, strict=True):
        text = t.decode(ids, skip_special_tokens=False)
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (two[i].n_tokens, two[i].ids_sha256, two[i].decoded_sha256) == (len(ids), sha, hashlib.sha256(text.encode()).hexdigest())
        assert (nine[i].start, nine[i].n_tokens, nine[i].ids_crc32) == (at, len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes()))
        at += len(ids) + 1


def test_op3_on_held_out_documents(spark, duck):
    lang = {i: x for i, _, x, _ in documents(duck)}
    rows = llm.QUERIES["op3_language_id"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_op4_round_trip(spark, duck):
    text = {i: (x or "").encode() for i, x, *_ in documents(duck)}
    for r in llm.QUERIES["op4_media"](spark, SF).collect():
        data = text[r.doc_id] + bytes(max(64, math.ceil(len(text[r.doc_id]) / 64) * 64) - len(text[r.doc_id]))
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(text[r.doc_id]), len(data), zlib.crc32(data[-64:]))
        assert r.payload_sha256 == hashlib.sha256(data).hexdigest()


def near(docs, width):
    """(size of each set, smallest id reachable) by comparing all pairs."""
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    comp = {i: i for i in sets}
    ids = sorted(i for i in sets if sets[i])
    changed = True
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            changed |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    return {i: (len(sets[i]), comp[i]) for i in sets}


def test_op10_against_all_pairs(spark, duck):
    want = near([(i, x) for i, x, *_ in documents(duck)], 2)
    rows = llm.QUERIES["op10_near_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_pipeline_against_brute_force(spark, duck):
    import corpus_pipeline

    docs = documents(duck)
    model = language_id.Classifier(language_id.train(spark.read.parquet(f"{SF}/documents.parquet").filter(~language_id.held_out())))
    judged = [(x, *model.predict(x[1])) for x in docs]
    docs = [x for x, lang, score in judged if lang != "und" and score >= language_id.MIN_MARGIN]
    last = {"".join(c.lower() if "A" <= c <= "Z" else c for c in x[1]): x for x in docs}
    docs = sorted(last.values())
    comp = near([(i, x) for i, x, *_ in docs], 5)
    docs = [x for x in docs if comp[x[0]][1] == x[0]]
    import duckdb
    import pandas as pd

    c = duckdb.connect()
    c.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "lang", "source"]))
    chosen = {r[0] for r in c.execute(f"SELECT doc_id FROM ({mixing._sql(mixing.ONCE)})").fetchall()}
    docs = [x for x in docs if x[0] in chosen]
    _, coded = library([x[1] for x in docs])
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {x[0]: ids for x, ids in zip(docs, coded, strict=True)}
    assert [s[0] for s in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "bpe"]
