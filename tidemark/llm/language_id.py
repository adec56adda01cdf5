"""Language identification by compression: the language whose dictionary gives the smallest zstandard frame.

Texts are reduced to lower-case words with one space between. For each language a raw-content dictionary holds the
whole texts of SAMPLE_ROWS labelled training rows and of DICTIONARY_BYTES at most, the sample's only bounds. A text is compressed once with each
dictionary, whole, in blocks that fit the compressor's window beside it; the smallest sum of sizes
wins and the gap to the next one, in proportion, is the score, whatever the text's length. A narrow gap is a rejection.
All languages of the labels take part: dictionaries are broadcast ROUND_BYTES at a time, and where that takes more than
one round, rows carry the best and second size from one to the next.

Defined results: null texts and texts without letters are `und`, score 0, rejected; equal sizes (mostly texts of
a word or two) go to the language with more training rows, then by name, with score 0, and are rejected; copies of
a text get equal results; an empty table gives no rows; with no training rows every text is `und`. Only text is
read to predict; columns that are not named are kept by `keep_identified`.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import materialise, small, table
from ._segments import slices

#: Training rows of a language at most, and bytes of their texts: the bounds of the sample that dictionaries are made of.
SAMPLE_ROWS, DICTIONARY_BYTES = 200, 2_000_000
#: Bytes of dictionaries that are broadcast at a time, one dictionary at least, and languages at a time.
ROUND_BYTES, ROUND_LANGUAGES = 64_000_000, 256
#: Bytes of a text that are compressed at a time. Block and dictionary fit the window: beyond the window no dictionary
#: is reachable, all languages compress alike and the score would fall with the text's length.
BLOCK_BYTES = 32 * 1024
#: Scores below are rejected: less than one byte in 250 between the best two languages.
MIN_MARGIN = 0.004
UNDETERMINED = "und"
_LEVEL, _MIN_MATCH, _LEAST_WINDOW = 5, 3, 17
_NO_LETTER = re.compile(r"[\W\d_]+")


def words_only(text: str) -> bytes:
    return _NO_LETTER.sub(" ", text.lower()).strip().encode()


def learned(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS, dictionary_bytes: int = DICTIONARY_BYTES,
) -> Iterator[tuple[str, bytes]]:
    """(language, dictionary) in the order that ties are decided: more labelled rows first. One round's texts at a time.

    The first scan reads labels, ids and the texts' sizes and picks, for each language, the sample_rows rows whose id's
    hash is smallest, as far as their whole texts fit dictionary_bytes; longer texts than that come last, and a language
    that has nothing else is learned from one of them, cut there. The second scan reads just the picked texts.
    """
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = labelled.groupBy(F.col(lang_col).alias("picked_lang")).agg(F.count("*").alias("n"))
    order = Window.partitionBy("picked_lang").orderBy("long", "order", "picked")
    size = F.octet_length(text_col).cast("long")
    picked = (
        labelled.select(F.col(id_col).alias("picked"), F.col(lang_col).alias("picked_lang"), size.alias("bytes"), (size > dictionary_bytes).alias("long"))
        .withColumn("order", F.xxhash64("picked"))
        .withColumn("k", F.row_number().over(order))
        .filter(F.col("k") <= sample_rows)
        .withColumn("total", F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .filter((F.col("total") <= dictionary_bytes) | (F.col("k") == 1))
        .select("picked", "picked_lang", "k")
    )
    picked = small(materialise(picked, "language-sample"))
    same = F.col(id_col).eqNullSafe(F.col("picked")) & (F.col(lang_col) == F.col("picked_lang"))
    texts = labelled.join(picked, same).select("picked_lang", "k", F.col(text_col).alias("text"))
    texts = materialise(texts.groupBy("picked_lang", "k").agg(F.min("text").alias("text")), "language-texts")
    sizes = texts.groupBy("picked_lang").agg(F.sum(F.octet_length("text")).alias("bytes")).join(counts, "picked_lang")
    for langs in _rounds(((r["picked_lang"], r["bytes"]) for r in sizes.orderBy(F.desc("n"), "picked_lang").collect()), lambda size: size):
        held: dict[str, list[tuple[int, str]]] = {lang: [] for lang, _ in langs}
        for r in texts.filter(F.col("picked_lang").isin(list(held))).collect():
            held[r["picked_lang"]].append((r["k"], r["text"]))
        for lang, rows in held.items():
            if words := b" ".join(words_only(t) for _, t in sorted(rows)):
                yield lang, words[:dictionary_bytes]


def train(docs: DataFrame, **columns: str) -> list[tuple[str, bytes]]:
    """All of `learned` at once."""
    return list(learned(docs, **columns))


def _rounds(languages: Iterable[tuple], size: object = len) -> Iterator[list[tuple]]:
    """(language, value) in groups of at most ROUND_BYTES, one language at least."""
    group: list[tuple] = []
    total = 0
    for lang, value in languages:
        if group and (total + size(value) > ROUND_BYTES or len(group) == ROUND_LANGUAGES):
            yield group
            group, total = [], 0
        group.append((lang, value))
        total += size(value)
    if group:
        yield group


class Classifier:
    """Compressors with one language's dictionary each."""

    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        self.langs = [lang for lang, _ in dictionaries]
        self.coders = []
        for _, content in dictionaries:
            window = max(_LEAST_WINDOW, (len(content) + BLOCK_BYTES - 1).bit_length())
            params = zstandard.ZstdCompressionParameters.from_level(
                _LEVEL, min_match=_MIN_MATCH, dict_size=len(content), source_size=4096, window_log=min(window, zstandard.WINDOWLOG_MAX),
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=params)
            self.coders.append(zstandard.ZstdCompressor(compression_params=params, dict_data=held))

    def best(self, text: str | None) -> tuple[str | None, int | None, int | None]:
        """(language, its size, the next size) of these dictionaries; nulls where there is nothing to tell."""
        words = words_only(text or "")
        if not self.coders or not any(c.isalpha() for c in words.decode()):
            return None, None, None
        blocks = [words[i : i + BLOCK_BYTES] for i in range(0, len(words), BLOCK_BYTES)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.coders]
        best = int(np.argmin(sizes))
        return self.langs[best], sizes[best], min((s for i, s in enumerate(sizes) if i != best), default=None)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score from 0 to 1)."""
        return _verdict(*self.best(text))


#: A worker's compressors, by the name of the round whose dictionaries they hold.
_models: dict[str, Classifier] = {}


def _model(name: str, dictionaries: list[tuple[str, bytes]]) -> Classifier:
    """The compressors of a round, made once in each worker; those of other rounds go."""
    if name not in _models:
        _models.clear()
        _models[name] = Classifier(dictionaries)
    return _models[name]


def _verdict(lang: str | None, size: int | None, second: int | None) -> tuple[str, float]:
    if lang is None:
        return UNDETERMINED, 0.0
    return lang, 1.0 if second is None else (second - size) / second


def _better(old: tuple, new: tuple) -> tuple:
    """The best of an earlier round and of this one; of equal sizes the earlier language stands."""
    if old[0] is None or new[0] is None:
        return new if old[0] is None else old
    won, lost = (new, old) if new[1] < old[1] else (old, new)
    return won[0], won[1], min(lost[1], won[2]) if won[2] is not None else lost[1]


def predict(
    docs: DataFrame, dictionaries: Iterable[tuple[str, bytes]], *, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` (default: all) with lang_pred string, score double, rejected boolean. No shuffle.

    One scan; with more rounds of dictionaries than one, each but the last is written and read again, so that a task
    never holds two of them.
    """
    names = docs.columns if keep is None else keep
    marks = [f"__keep{i}" for i in range(len(names))]
    rows = docs.select(*[F.col(c).alias(m) for c, m in zip(names, marks, strict=True)], F.col(text_col).alias("__text"))
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema)
    state = ["__lang", "__size", "__second"]
    groups = _rounds(dictionaries)
    group: list | None = next(groups, [])
    first = True
    while group is not None:
        if not first:
            rows = materialise(rows, "language-round")
        held, later = docs.sparkSession.sparkContext.broadcast(group), not first

        def run(batches: Iterator[pa.RecordBatch], held=held, later=later, name=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            model = _model(name, held.value)
            for batch in batches:
                for a, b in slices(batch.column("__text")):
                    part = batch.slice(a, b - a)
                    found = [model.best(t) for t in part.column("__text").to_pylist()]
                    if later:
                        old = zip(*(part.column(c).to_pylist() for c in state), strict=True)
                        found = [_better(o, f) for o, f in zip(old, found, strict=True)]
                    made = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
                    kept = part.columns[:-3] if later else part.columns
                    yield pa.RecordBatch.from_arrays([*kept, *made], [*marks, "__text", *state])

        rows = rows.mapInArrow(run, f"{fields}__lang string, __size long, __second long")
        group, first = next(groups, None), False
    second, size = F.col("__second"), F.col("__size")
    score = F.when(F.col("__lang").isNull(), 0.0).when(second.isNull(), 1.0).otherwise((second - size) / second)
    rejected = F.col("__lang").isNull() | (score < MIN_MARGIN)
    lang = F.coalesce("__lang", F.lit(UNDETERMINED))
    kept = [F.col(m).alias(c) for c, m in zip(names, marks, strict=True)]
    return rows.select(*kept, lang.alias("lang_pred"), score.alias("score"), rejected.alias("rejected"))


def held_out(id_col: str = "doc_id") -> Column:
    """A fifth of all ids: their labels are for measuring only."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def keep_identified(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs, with just their columns, whose language is identified."""
    known = learned(docs.filter(~held_out(id_col)), id_col=id_col, text_col=text_col, lang_col=lang_col)
    names = docs.columns
    safe = docs.toDF(*[f"c{i}" for i in range(len(names))])  # a column may be called score
    judged = predict(safe, known, text_col=f"c{names.index(text_col)}")
    return judged.filter(~F.col("rejected")).drop("lang_pred", "score", "rejected").toDF(*names)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = learned(docs.filter(~held_out()))
    return predict(docs.withColumn("held_out", held_out()), known, keep=["doc_id", "held_out"])


QUERIES = {"op3_language_id": op3_language_id}
ORACLES: dict = {}
