"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat_format, exact_dedup, language_id, line_dedup, media, mixing, near_dedup, token_store, url_filter

LONG = "word" * 40_000 + " the end " * 3_000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away.", "en", "s1"), (2, None, "en", "s2"), (3, "", None, None), (4, LONG, "en", "s1"),
    (5, "THE quick brown fox jumps over the lazy dog and runs away.", "en", None), (5, "THE quick brown fox jumps over the lazy dog and runs away.", "en", None),
    (None, "Der schnelle Fuchs springt \u00fcber den faulen Hund und l\u00e4uft weg.", "de", "s2"), (7, "  \n\t ", "de", "s3"), (8, "a\n\nb  c <|endoftext|> d\u00a0e", "fr", "s1"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    # Names that operators use inside.
    return df.select("*", *[F.lit(9).alias(c) for c in ("id", "n", "size", "old", "h64", "sha", "ids", "score", "n_chars", "node", "band", "keep_id", "__sha", "gone_id", "__id", "c0", "h")])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe(docs, empty):
    path, t = bpe.vocabulary_path(), library()
    rows = bpe.encode(docs, path, decoded_col="decoded").collect()
    assert len(rows) == len(TEXTS) and bpe.encode(empty, path).count() == 0
    want = sorted((t.encode(x[1] or "", add_special_tokens=False).ids, x[1] or "") for x in TEXTS)
    assert sorted((list(r.ids), r.decoded) for r in rows) == want
    again = bpe.decode(bpe.encode(docs, path), path).collect()
    assert sorted(r.decoded for r in again) == sorted(x[1] or "" for x in TEXTS)


def test_token_store(spark, docs, empty):
    path, t = token_store.vocabulary_path(), library()
    store = token_store.write_store(docs, path, segment_tokens=64)
    rows = sorted(token_store.read_documents(store, want=("tokens", "ids_crc32")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 7, 8]
    at, flat = 0, []
    by_id = {i: x for i, x, *_ in TEXTS}
    for r in rows:
        ids = [*t.encode(by_id[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, list(r.tokens)) == (at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at, flat = at + len(ids), flat + ids
    wanted = spark.createDataFrame([(i,) for i in range(0, at, 997)], "position long")
    assert {r.position: r.token for r in token_store.tokens_at(store, wanted).collect()} == {i: flat[i] for i in range(0, at, 997)}
    assert token_store.read_documents(token_store.write_store(empty, path)).count() == 0


def test_language_id(spark, docs, empty):
    learned = language_id.train(docs)
    rows = language_id.predict(docs, learned).collect()
    assert len(rows) == len(TEXTS) and set(docs.columns) < set(rows[0].asDict())
    by = {r.doc_id: r for r in rows if r.lang_pred}
    assert by[1].lang_pred == "en" and by[None].lang_pred == "de" and by[2].lang_pred == by[3].lang_pred == by[7].lang_pred == "und"
    assert language_id.train(empty) == [] and language_id.predict(docs, []).filter("lang_pred <> 'und'").count() == 0
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.filter("text IS NULL OR trim(text) = ''").count() == 0
    assert language_id.keep_identified(empty).count() == 0


def test_language_id_keeps_very_long_texts(spark):
    """Texts of megabytes, made of the rows that train() doesn't see, with a label that says nothing."""
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    unseen = known.filter(language_id.held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull()).orderBy("doc_id").collect()
    ids = iter(r.doc_id for r in known.select((F.col("doc_id") + 10_000_000).alias("doc_id")).filter(language_id.held_out()).limit(99).collect())
    texts = {lang: " ".join(r.text for r in unseen if r.lang == lang) for lang in {r.lang for r in unseen}}
    long = {next(ids): (lang, (t + " ") * (3_000_000 // len(t) + 1)) for lang, t in texts.items()}
    assert len(long) == 4 and all(len(t) > 3_000_000 for _, t in long.values())
    rows = known.unionByName(spark.createDataFrame([(i, t, None) for i, (_, t) in long.items()], known.schema))
    kept = {r.doc_id for r in language_id.keep_identified(rows).filter("doc_id >= 10000000").select("doc_id").collect()}
    assert kept == set(long)
    model = language_id.Classifier(language_id.train(known.filter(~language_id.held_out())))
    for lang, text in long.values():
        found, score = model.predict(text)
        part = model.predict(text[:30_000])
        assert (found, part[0]) == (lang, lang) and score > 0.3 * part[1]


def test_language_dictionaries_keep_to_their_bytes(spark):
    rows = [(i, f"word{i} " * 10, "en") for i in range(50)] + [(100, "tall " * 2_000, "en"), (101, "lang " * 2_000, "de"), (102, "lang " * 3_000, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = dict(language_id.learned(df, dictionary_bytes=1_000))
    assert len(found["en"]) <= 1_000 and b"tall" not in found["en"] and found["en"].count(b"word") >= 90
    assert len(found["de"]) == 1_000 and set(found["de"].split()) == {b"lang"}
    assert len(dict(language_id.learned(df))["en"]) > 10_000


def chunks_of(data):
    at, out = 8, []
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        out.append((data[at + 4 : at + 8], data[at + 8 : at + 8 + n]))
        at += 12 + n
    return out


def png(chunks):
    body = b"".join(len(d).to_bytes(4, "big") + k + d + zlib.crc32(k + d).to_bytes(4, "big") for k, d in chunks)
    return b"\x89PNG\r\n\x1a\n" + body


def test_media_damage():
    data = media.encode_png(b"some payload " * 900)
    at = data.index(b"IDAT") + 10
    for bad, why in ((data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :], "checksum"), (data[:-20], "ends|checksum"), (data[:at], "ends|checksum"), (data[:8], "ends"), (b"x" + data, "signature")):
        with pytest.raises(ValueError, match=why):
            media.decode_png(bad)
    short = [(k, zlib.compress(zlib.decompress(d)[:-5]) if k == b"IDAT" else d) for k, d in chunks_of(data)]
    with pytest.raises(ValueError, match="inflated length"):
        media.decode_png(png(short))


@pytest.mark.parametrize("kind", range(5))
def test_media_filters(kind):
    """Pictures filtered here by the definition of each filter, sample by sample, read back whole."""
    image = np.random.default_rng(kind).integers(0, 256, (9, media.WIDTH), dtype=np.uint8)
    rows = bytearray()
    for y in range(9):
        rows.append(kind)
        for x in range(media.WIDTH):
            a, b, c = (int(image[y, x - 1]) if x else 0), (int(image[y - 1, x]) if y else 0), (int(image[y - 1, x - 1]) if x and y else 0)
            near = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
            rows.append((int(image[y, x]) - (0, a, b, (a + b) // 2, near)[kind]) & 255)
    head = media.WIDTH.to_bytes(4, "big") + (9).to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])
    back, n = media.decode_png(png([(b"IHDR", head), (b"IDAT", zlib.compress(bytes(rows))), (b"IEND", b"")]))
    assert (back == image).all() and n == image.size


def test_media_hash_by_definition():
    rng = np.random.default_rng(1)
    for height in (1, 31, 32, 77):
        image = rng.integers(0, 256, (height, media.WIDTH), dtype=np.uint8)
        cells = np.zeros((32, 32))
        for y in range(32):
            for x in range(32):
                top, left = y * height // 32, x * media.WIDTH // 32
                cells[y, x] = image[top : max((y + 1) * height // 32, top + 1), left : max((x + 1) * media.WIDTH // 32, left + 1)].mean()
        low = [sum(cells[y, x] * np.cos(np.pi * u * (2 * y + 1) / 64) * np.cos(np.pi * v * (2 * x + 1) / 64) for y in range(32) for x in range(32)) for u in range(8) for v in range(8)]
        low = np.round(low, 6)  # frequencies that a flat picture lacks are exactly 0
        bits = low > np.median(low[1:])
        got = np.unpackbits(np.frombuffer(bytes.fromhex(media.dct_hash(image)), np.uint8)).astype(bool)
        assert (bits != got).sum() <= 1  # a tie with the median in the last digit
        brighter = np.clip(image.astype(int) + 2, 0, 255).astype(np.uint8)
        far = np.unpackbits(np.frombuffer(bytes.fromhex(media.dct_hash(brighter)), np.uint8)) != got
        assert far.sum() <= 6


def test_language_id_in_rounds(spark, docs, monkeypatch):
    """Many rounds of dictionaries give what one gives, and no language is left out."""
    words = {f"l{k}": " ".join(f"{chr(97 + k)}{i % 7}{'xyz'[i % 3]}word{chr(97 + k)}" for i in range(40)) for k in range(9)}
    rows = [(i, t + f" {i}", lang, "s") for i, (lang, t) in enumerate(sorted(words.items()) * 2)]
    df = spark.createDataFrame(rows, SCHEMA).unionByName(docs.select("doc_id", "text", "lang", "source"))
    once = language_id.predict(df, language_id.learned(df)).collect()
    monkeypatch.setattr(language_id, "ROUND_LANGUAGES", 2)
    assert sorted(map(str, language_id.predict(df, language_id.learned(df)).collect())) == sorted(map(str, once))
    assert {r.lang_pred for r in once} >= set(words)
    held = dict(language_id.train(df))
    assert held["l3"].count(b"wordd") == 80  # whole texts of all sampled rows


def test_language_id_against_plain_zstandard(spark):
    """Sizes worked out again for each text and language with the library alone."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = language_id.train(docs.filter(~language_id.held_out()))
    best = {}
    for r in docs.collect():
        words = " ".join("".join(c if c.isalpha() else " " for c in (r.text or "").lower()).split()).encode()
        sizes = []
        for lang, content in known:
            params = zstandard.ZstdCompressionParameters.from_level(5, min_match=3, dict_size=len(content), source_size=4096, window_log=max(17, (len(content) + 32 * 1024 - 1).bit_length()), write_content_size=False)
            coder = zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            sizes.append((sum(len(coder.compress(words[i : i + 32 * 1024])) for i in range(0, len(words), 32 * 1024)), lang))
        best[r.doc_id] = (sorted(s for s, _ in sizes)[:2], {x for s, x in sizes if s == min(sizes)[0]}, bool(words))
    for r in language_id.predict(docs, known).collect():
        (size, second), langs, some = best[r.doc_id]
        assert (r.lang_pred in langs and abs(r.score - (second - size) / second) < 0.01) if some else r.lang_pred == "und"


def test_media(spark, docs, empty):
    rows = media.read_media(media.write_media(docs)).collect()
    assert len(rows) == len(TEXTS) and media.write_media(empty).count() == 0
    want = sorted(media.pad((x[1] or "").encode()) for x in TEXTS)
    assert sorted(bytes(r.payload) for r in rows) == want
    assert {r.n_bytes for r in rows if r.doc_id in (2, 3)} == {0}
    bad = spark.createDataFrame([(1, None), (2, bytearray(b"junk"))], "doc_id long, media binary")
    assert [r.payload for r in media.read_media(bad, on_error="null").collect()] == [None, None]
    with pytest.raises(Exception, match="PNG"):
        media.read_media(bad).collect()


def test_url_filter(spark):
    urls = [(1, None), (2, "no scheme"), (3, "http://WWW.Example.com/en/a"), (4, "http://example.com/en/x?q#f"), (5, "https://a.net/es/"), (5, "https://a.net/es/"), (6, "x://example.com"), (None, "http://b.net/fr"), (7, "h://com/" + "a/" * 50_000)]
    df = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("x")).withColumn("rule", F.lit("y"))
    got = {(r.page_id, r.rule): (r.host, r.path[:6], r.verdict) for r in url_filter.filter_urls(df, url_filter.RULES).collect()}
    assert got[1, None] == ("", "", "allow") and got[2, None] == ("", "", "allow")
    assert got[3, "www.example.com/en/"] == ("www.example.com", "/en/a", "allow")
    assert got[4, "example.com/en/"][2] == "block" and got[5, "net/es/"][2] == "block"
    assert got[6, None] == ("example.com", "", "allow") and got[None, None] == ("b.net", "/fr", "allow") and got[7, "com/"][2] == "allow"
    assert url_filter.filter_urls(df.filter("false"), url_filter.RULES).count() == 0
    trie = url_filter.build_trie([url_filter.Rule("a.b", "/x", "block"), url_filter.Rule("a.b", "/x", "allow"), url_filter.Rule("b", "/xyz/", "allow")])
    assert url_filter.match(trie, "q.a.b", "/xyz/1").verdict == "block"  # more labels come before a longer path
    assert url_filter.match(trie, "c.b", "/xyz/1").path == "/xyz/" and url_filter.match(trie, "c.b", "/xyz") is None


def test_url_rules_beyond_the_bound(spark):
    """Sub-tries by host suffix judge as the broadcast trie does; a table of rules as tuples do."""
    hosts = ["example.com", "www.example.com", "a.www.example.com", "other.com", "com", "net", "shop.net", "X.Net", "org", ""]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/en", "/en/", "/en/x?q", "/es/1#f", "/EN/", "/en/deep/er")] + [None, "none", "://", "a\nb://net/es/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls * 3)] + [(None, "http://net/es/")], "page_id long, url string")
    rules = [*url_filter.RULES, url_filter.Rule("NET", "/es/1", "allow"), url_filter.Rule("www.example.com", "/en/deep", "block"), url_filter.Rule("com", "/en/deep/er", "block")]
    want = sorted(map(str, url_filter.filter_urls(df, rules).collect()))
    assert len(want) == 3 * len(urls) + 1
    of_table = spark.createDataFrame(rules, "host string, path string, verdict string")
    assert sorted(map(str, url_filter.filter_urls(df, of_table).collect())) == want
    for given in (rules, of_table):
        assert sorted(map(str, url_filter.filter_urls(df, given, trie_bytes=100).collect())) == want
    with pytest.raises(OverflowError):
        url_filter.build_trie(rules, 2_000)


def test_url_groups_of_a_hot_host(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "GROUP_URLS", 7)
    df = spark.createDataFrame([(i, f"http://h{i % 3}.hot.net/es/{i}") for i in range(100)], "page_id long, url string")
    got = url_filter.filter_urls(df, [url_filter.Rule("hot.net", "/es/", "block")], trie_bytes=0).collect()
    assert len({r.page_id for r in got}) == len(got) == 100 and {r.rule for r in got} == {"hot.net/es/"}


def test_chat_format(spark):
    turns = [(1, 0, "user", "hi <b>"), (1, 1, "user", None), (1, 2, "assistant", "\\l </turn>\n<next>"), (1, 2, "assistant", "\\l </turn>\n<next>"), (2, None, None, "x"), (None, 1, "a>b", "y"), (3, 1, "assistant", "z" * 200_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("conv", F.lit(2))
    made = chat_format.format_chats(df)
    rows = {r.conv_id: r for r in chat_format.read_chats(made).collect()}
    assert [(t.role, t.text) for t in rows[1].turns] == [("user", "hi <b>"), ("user", ""), ("assistant", "\\l </turn>\n<next>"), ("assistant", "\\l </turn>\n<next>")]
    assert rows[1].loss_text == "\\l </turn>\n<next>" * 2 and rows[1].formatted.count("<turn:") == 2
    assert [(t.role, t.text) for t in rows[2].turns] == [("", "x")] and rows[None].turns[0].role == "a>b" and len(rows[3].loss_text) == 200_000
    for r in made.collect():
        for s in r.loss_mask:
            assert r.formatted[s.start - 1] == ">" and r.formatted[s.start + s.chars] == "<"
    assert chat_format.format_chats(df.filter("false")).count() == 0


def norm(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_dedup(docs, empty):
    rows = exact_dedup.find_duplicates(docs, exact_dedup.older_half()).collect()
    assert len(rows) == len(TEXTS)
    groups = {}
    for i, x, *_ in TEXTS:
        groups.setdefault(norm(x), []).append(i)
    for r in rows:
        ids = next(v for k, v in groups.items() if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
        known = [i for i in ids if i is not None]
        assert (r.keep_id, r.group_size) == (max(known, default=None), len(ids))
    assert sum(r.kept for r in rows) == len(groups)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.drop_duplicates(empty).count() == 0


def test_near_dedup(spark, docs, empty):
    base = [f"w{i}" for i in range(60)]
    near = [*base[:-1], "other"]
    more = spark.createDataFrame([(100 + i, " ".join(t), "en", "s1") for i, t in enumerate([base, near, base[::-1]])], SCHEMA)
    all_ = docs.unionByName(more, allowMissingColumns=True)
    rows = near_dedup.near_duplicates(all_).collect()
    comp = {r.doc_id: (r.component_id, r.kept, r.n_shingles) for r in rows}
    assert comp[101] == (100, False, 56) and comp[100][:2] == (100, True) and comp[102][:2] == (102, True)
    assert comp[5][0] == 1 and comp[2] == (2, True, 0) and comp[3] == (3, True, 0) and comp[None][:2] == (None, True)
    out = near_dedup.drop_near_duplicates(all_)
    assert out.columns == all_.columns and sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 3, 4, 7, 8, 100, 102]
    assert near_dedup.drop_near_duplicates(empty).count() == 0


def test_near_dedup_of_rows_without_id(spark, docs):
    base = " ".join(f"w{i}" for i in range(60))
    unique = " ".join(f"v{i}" for i in range(60))
    near = base.replace("w59", "other")
    rows = [(100, base, "en", "s1"), (101, near, "en", "s1"), (None, base.upper(), "en", "s1"), (None, near, "en", "s1"), (None, unique, "en", "s2"), (None, None, "en", "s3")]
    for first in (docs, docs.filter("false")):
        out = near_dedup.drop_near_duplicates(first.unionByName(spark.createDataFrame(rows, SCHEMA), allowMissingColumns=True))
        assert out.columns == docs.columns
        kept = [(r.doc_id, r.text) for r in out.collect()]
        want = {(100, base), (None, unique), (None, None)}
        assert want <= set(kept) and not {(None, base.upper()), (None, near), (101, near)} & set(kept)
        assert len(kept) == 3 + (7 if first is docs else 0)


def test_near_dedup_of_repeated_ids(spark):
    """The rows that go are those that near_duplicates doesn't keep, even where an id has rows of both kinds."""
    base, unique, alone = (" ".join(f"{c}{i}" for i in range(60)) for c in "wvu")
    near = base.replace("w59", "other")
    rows = [(1, base), (5, near), (5, unique), (5, unique), (5, base), (6, None), (6, near), (6, ""), (None, near), (None, alone), (None, alone.replace("u59", "x"))]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, h1 string")
    judged = near_dedup.near_duplicates(df).collect()
    assert len(judged) == len(rows)
    out = near_dedup.drop_near_duplicates(df)
    got = [(r.doc_id, r.text) for r in out.collect()]
    want = [(1, base), (5, unique), (5, unique), (6, None), (6, ""), (None, alone), (None, alone.replace("u59", "x"))]
    assert sorted(map(str, got)) == sorted(map(str, want)) and out.columns == df.columns
    assert len(got) == sum(r.kept for r in judged)


def linked(rows, width):
    """doc_id -> smallest id reachable, all pairs compared."""
    sets = {i: {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} for i, t in rows for w in [t.split()]}
    comp = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return comp


@pytest.mark.parametrize(("chunk", "rounds"), [(2048, 3), (4, 3), (4, 0)])
def test_near_dedup_in_blocks(spark, monkeypatch, chunk, rounds):
    """Chains, chunks smaller than a bucket, and all pairs at once; similarities on both sides of 0.8; sets beyond 5,120."""
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    monkeypatch.setattr(near_dedup, "ROUNDS", rounds)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):  # a family whose members differ in 2 to 24 places of 200
        words = base.copy()
        for k in rng.choice(200, 2 + i % 23, replace=False):
            words[k] = f"x{i}_{k}"
        rows.append((10 + i, " ".join(words)))
    long = [f"l{i}" for i in range(6_000)]
    rows += [(100, " ".join(long)), (101, " ".join(long[:-500])), (102, " ".join(long[:4_000] + [f"m{i}" for i in range(2_000)])), (103, " ".join(long[400:]))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert {r.doc_id: r.component_id for r in got} == linked(rows, 2)


def test_near_dedup_folds_samples_and_keeps_recall():
    """The screen lets pairs of 0.8 and more pass, and its estimate is close, for sets of all sizes."""
    rng = np.random.default_rng(3)
    salts = near_dedup.sh.seeds(2 * near_dedup.SAMPLES)
    passed = asked = 0
    for n in (1, 5, 40, 400, 9_000):
        for share in (0.8, 0.9, 1.0):
            both = int(np.ceil(n * share * 2 / (1 + share)))
            for _ in range(20):
                values = rng.integers(0, 2**63, 2 * n - both, dtype=np.int64).astype(np.uint64)
                a, b = np.sort(values[:n]), np.sort(np.concatenate([values[:both], values[n:]]))
                with np.errstate(over="ignore"):
                    s = [np.frombuffer(near_dedup.sh.odd_sketch(near_dedup._spread(near_dedup.sh.sample(x, near_dedup.SAMPLES, salts))), np.uint64) for x in (a, b)]
                flips = near_dedup.sh.popcounts(*s)
                true = both / len(values)
                asked, passed = asked + 1, passed + bool(near_dedup.passes(np.int64(n), np.int64(n), flips))
                assert abs(near_dedup._similar(flips) - true) < 0.09
    assert passed == asked


def test_mixing_by_hand(spark, monkeypatch):
    """Null ids, repeated rows and two epochs, against a plain walk over each leaf's rows; ranges split to their ends."""
    monkeypatch.setattr(mixing, "SORTED_ROWS", 1)
    rows = [(i if i % 9 else None, "w " * (1 + i % 4) + "x", "en" if i % 3 else None, f"s{i % 2}") for i in range(120)] + [(7, "w x", "en", "s1")] * 5
    df = spark.createDataFrame(rows, SCHEMA)
    spec = mixing.MixSpec(share=1.4, max_epochs=2, lang_weights={"en": 3, "?": 1})
    got = mixing.mix(df, spec, domain=F.lit("d"), tokens=mixing.token_count(F.col("text"))).collect()
    leaves = {}
    for i, t, lang, source in rows:
        leaves.setdefault((lang or "?", source), []).append((i, len(t.split())))
    for leaf, held in leaves.items():
        here = [r for r in got if (r.lang, r.source) == leaf]
        budget, total = here[0].leaf_budget, sum(n for _, n in held)
        last, rest, at = budget // total, budget % total, 0
        want = sorted((e, i or -1, n) for e in range(last) for i, n in held)
        key = lambda r: (hashlib.md5(f"{spec.seed}:{last}".encode() + (b"" if r[0] is None else f":{r[0]}".encode())).hexdigest(), r[0] or -1)  # noqa: B023, E731
        tail = []
        for i, n in sorted(held, key=key):
            at += n
            if at > rest:
                break
            tail.append((last, i or -1, n))
        found = [(r.epoch, r.doc_id or -1, r.n_tokens) for r in here]
        assert sorted(x for x in found if x[0] < last) == want
        # Rows without id tie: any of them may come first.
        assert sum(x[2] for x in found) <= budget and abs(len(found) - len(want) - len(tail)) <= 4
        if None not in [i for i, _ in held]:
            assert sorted(x for x in found if x[0] == last) == sorted(tail)


def test_mixing(spark, docs, empty):
    tokens = mixing.token_count(F.col("text"))
    spec = mixing.MixSpec(share=1.0, max_epochs=1)
    rows = mixing.mix(docs, spec, domain=mixing.domain_of(F.col("source")), tokens=tokens).collect()
    assert len(rows) == len([t for t in TEXTS if t[1]])  # rows of leaves that have tokens
    assert mixing.mixed_documents(docs).columns == docs.columns and mixing.mixed_documents(empty).count() == 0
    none = mixing.MixSpec(lang_weights={"en": 0, "de": 0, "fr": 0, "?": 0})
    assert mixing.mix(docs, none, domain=mixing.domain_of(F.col("source")), tokens=tokens).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    leaves = [("a", "x", "1", 100), ("a", "x", "2", 900), ("a", "y", "3", 1000), ("b", "x", "4", 1000)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    got = {r.source: r.budget for r in mixing.budgets(df, mixing.MixSpec(share=0.4)).collect()}
    # 1200 tokens: 600 a domain, 300 a language of a; source 1 has 100 of its 150, source 2 takes the rest.
    assert got == {"1": 100, "2": 200, "3": 300, "4": 600}


def test_pipeline_stages(spark, docs, empty):
    """Every stage on nulls, empty texts, repeated rows, clashing columns and an empty table; kept rows are whole rows of docs."""
    import corpus_pipeline

    more = docs.unionByName(docs.filter("doc_id IN (1, 8)"))
    for name, stage in corpus_pipeline.STAGES:
        out, none = stage(spark, more, "/root/testdata/sf0.001"), stage(spark, empty, "/root/testdata/sf0.001")
        assert none.count() == 0
        if name != "bpe":
            assert out.columns == none.columns == docs.columns
            assert out.exceptAll(more).count() == 0
    assert stage(spark, more, "").count() == more.count()


def test_line_dedup(spark, docs, empty):
    line = [(i, f"keep {i}\n shared line \n\nshared line", "en", f"s{i % 4}") for i in range(8)]
    df = spark.createDataFrame(line, SCHEMA).unionByName(docs, allowMissingColumns=True)
    for most, few in ((1_000, 1_000), (0, 1_000), (0, 0)):
        rows = {r.doc_id: r for r in line_dedup.remove_boilerplate(df, min_sites=4, broadcast_lines=most, few=few).collect() if (r.text or "").startswith("keep")}
        assert len(rows) == 8 and all(r.text == f"keep {i}\n" and (r.n_lines, r.n_removed) == (4, 2) for i, r in rows.items())
    assert line_dedup.remove_boilerplate(df, min_sites=5).filter("n_removed > 0").count() == 0
    assert line_dedup.remove_boilerplate(docs, min_sites=2).count() == len(TEXTS) and line_dedup.remove_boilerplate(empty).count() == 0
