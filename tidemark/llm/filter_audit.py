"""How quality filters interact: what each one removes in every order of application, from one pass over the bytes.

1. A table-driven transducer reads the UTF-8 bytes of whole texts: STEP gives, for its two states (between words, in a
   word) and each byte, what the byte says: a word starts, a word has ended, a capital, a code point, a symbol. The state
   after a byte is the same from either state, so all states are known at once and the pass is numpy lookups.
2. Word spans go into a hash table with open addressing, 64-bit hashes and linear probing. Where a slot is taken, length
   and all bytes are compared with the span that holds it, so that a hash never decides alone.
3. Every text gives the filters A to D that it fails, and its SHA-256. Rows are counted by (digest, id, part, filters);
   the smallest id of each digest passes E, all others fail it.
4. Counts by part and set of failed filters, 32 at most for each part, give every figure of all 120 orders.

Defined results: a null text is the empty one, which fails A only (and E where a smaller id has it); a null source is the
part ''. A row without an id fails E never and makes no other row fail it, and has no labels; rows that repeat an id and
a text are counted as rows and fail E alike. Of several labels of an id, one that says 1 is enough. Very long texts are
read whole. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import discard, materialise, table
from ._fuse import mix64
from ._segments import slices

FILTERS = "ABCDE"
STARTS, ENDS, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8, 16
#: Word spans that are inserted at a time.
BLOCK = 1 << 18
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(NEXT, STEP): the state after each byte, and what each (state, byte) says. State 1: in a word."""
    byte = np.arange(256)
    space = (byte == 0x20) | ((byte >= 9) & (byte <= 13))
    says = CAPITAL * ((byte >= ord("A")) & (byte <= ord("Z"))) + POINT * ((byte & 0xC0) != 0x80) + SYMBOL * np.isin(byte, list(b"#$%&*|"))
    return (~space).astype(np.uint8), np.stack([says + STARTS * ~space, says + ENDS * space]).astype(np.uint8)


NEXT, STEP = _tables()


def spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(what each byte says, where words start, where they end, each word's text). ends: where the texts end in data."""
    state = np.zeros(len(data), np.uint8)
    state[1:] = NEXT[data[:-1]]
    begin = np.concatenate([[0], ends[:-1]])
    state[begin[begin < ends]] = 0
    said = STEP[state, data]
    starts = np.flatnonzero(said & STARTS)
    # A word ends where the transducer says so, or with its text.
    last = ends[(ends > begin) & (NEXT[data[np.maximum(ends, 1) - 1]] == 1)] if len(data) else ends[:0]
    stops = np.sort(np.concatenate([np.flatnonzero(said & ENDS), last]))
    return said, starts, stops, np.searchsorted(ends, starts, "right")


class SpanTable:
    """Distinct spans of bytes within each owner: open addressing, linear probing, matches verified byte by byte."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, owners: np.ndarray):
        held = np.concatenate([data, np.zeros(8, np.uint8)])
        self.eight = np.ndarray((len(data) + 1,), "<u8", buffer=held, strides=(1,))  # eight bytes from every place
        self.starts, self.sizes, self.owners = starts, sizes, owners
        with np.errstate(over="ignore"):
            h = mix64(owners.astype(np.uint64) * _SPREAD + sizes.astype(np.uint64))
            at = np.arange(len(starts))
            k = 0
            while len(at):
                h[at] = mix64(h[at] * _SPREAD + self._part(at, k))
                k += 8
                at = at[sizes[at] > k]
        self.hashes = h

    def _part(self, at: np.ndarray, k: int) -> np.ndarray:
        """Bytes k to k + 8 of the spans, those behind a span's end as 0."""
        left = np.minimum(self.sizes[at] - k, 8).astype(np.uint64)
        return self.eight[self.starts[at] + k] & (np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * left))

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans a and b have the same owner and the same bytes."""
        same = (self.hashes[a] == self.hashes[b]) & (self.sizes[a] == self.sizes[b]) & (self.owners[a] == self.owners[b])
        at, k = np.flatnonzero(same), 0
        while len(at):
            same[at] = self._part(a[at], k) == self._part(b[at], k)
            k += 8
            at = at[same[at] & (self.sizes[a[at]] > k)]
        return same

    def firsts(self) -> np.ndarray:
        """Which spans were inserted: one of each distinct (owner, bytes)."""
        n = len(self.starts)
        size = 1 << max(4, (2 * n).bit_length())
        slots, inserted = np.full(size, -1, np.int64), np.zeros(n, bool)
        for first in range(0, n, BLOCK):
            todo = np.arange(first, min(n, first + BLOCK))
            at = (self.hashes[todo] & np.uint64(size - 1)).astype(np.int64)
            while len(todo):
                free = slots[at] < 0
                slots[at[free]] = todo[free]  # of several, the last one takes the slot and the others meet it
                held = slots[at]
                own = held == todo
                inserted[todo[own]] = True
                other = ~own
                other[other] = ~self._equal(held[other], todo[other])
                todo, at = todo[other], (at[other] + 1) & (size - 1)
        return inserted


def count_texts(texts: pa.Array) -> list[np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of each text (Arrow binary or string, null: empty)."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    if not len(texts) or not ends[-1]:
        return [np.zeros(len(texts), np.int64) for _ in range(5)]
    first = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first : first + ends[-1]]
    said, starts, stops, owners = spans(data, ends)
    distinct = SpanTable(data, starts, stops - starts, owners).firsts()
    inner = lambda bit: np.diff(np.searchsorted(np.flatnonzero(said & bit), np.concatenate([[0], ends])))
    per = lambda x: np.bincount(x, minlength=len(texts))
    points = np.diff(np.concatenate([[0], ends])) - np.diff(np.searchsorted(np.flatnonzero((said & POINT) == 0), np.concatenate([[0], ends])))
    return [per(owners), per(owners[distinct]), inner(CAPITAL), points, inner(SYMBOL)]


def measured(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """id, part string, sha binary, words, distinct, capitals, points, symbols (long): one row for each row of docs."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text")
    )
    names = ["words", "distinct", "capitals", "points", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(3)):
                part = batch.slice(a, b - a)
                counts = [pa.array(x, pa.int64()) for x in count_texts(part.column(3))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *counts], ["id", "part", "sha", *names])

    return rows.mapInArrow(run, f"id {kind}, part string, sha binary, " + ", ".join(f"{c} long" for c in names))


def failures() -> Column:
    """The filters A to D that a measured row fails, as bits 0 to 3."""
    fails = ["words < 200", "100 * distinct < 50 * words", "100 * capitals > 2 * points", "symbols > 0"]
    return F.expr(" + ".join(f"IF({x}, {1 << i}, 0)" for i, x in enumerate(fails))).cast("int")


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: one row for each
    part, order of the five filters and step. labels: id_col, quality, toxic."""
    rows = measured(docs, id_col=id_col, text_col=text_col, part_col=part_col).select("id", "part", "sha", failures().alias("mask"))
    # Rows that repeat are one from here on; a text that a third of the rows share is spread by id.
    rows = materialise(rows.groupBy("id", "part", "sha", "mask").agg(F.count("*").alias("n")), "audit-rows")
    firsts = rows.filter("id IS NOT NULL").groupBy("sha").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    says = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    named = rows.filter("id IS NOT NULL").join(firsts, ["sha", "id"], "left").join(says, "id", "left")
    named = named.select("part", "n", F.expr("mask + IF(first IS NULL, 16, 0)").alias("mask"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    bare = rows.filter("id IS NULL").select("part", "n", "mask", *[F.lit(False).alias(c) for c in ("good", "toxic")])
    cells = named.unionByName(bare).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")
    )
    cells = materialise(cells, "audit-cells")
    discard(rows)
    return orders(cells)


def orders(cells: DataFrame) -> DataFrame:
    """The audit's rows from cells (part, mask, n, good, toxic), one for each set of failed filters that a part has."""
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    all_orders = F.split(F.lit(",".join("".join(p) for p in permutations(FILTERS))), ",")
    rows = parts.withColumn("filter_order", F.explode(all_orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = " + ".join(f"IF(substring(filter_order, step, 1) = '{x}', {1 << i}, 0)" for i, x in enumerate(FILTERS))
    before = " + ".join(f"IF(instr(substring(filter_order, 1, step - 1), '{x}') > 0, {1 << i}, 0)" for i, x in enumerate(FILTERS))
    rows = rows.withColumn("bit", F.expr(bit)).withColumn("before", F.expr(before))
    total = lambda when, what="c.n": F.expr(f"aggregate(cells, 0L, (a, c) -> a + IF({when}, {what}, 0L))")
    here = "(c.mask & before) = 0 AND (c.mask & bit) > 0"
    return rows.select(
        "part", "filter_order", "step",
        total("(c.mask & (before | bit)) = 0").alias("kept"),
        total(here).alias("removed"),
        total("(c.mask & before) > 0 AND (c.mask & bit) > 0").alias("redundant"),
        total("c.mask = bit").alias("unique_fails"),
        total(here, "c.good").alias("good_lost"),
        total(here, "c.toxic").alias("toxic_lost"),
        # A filter comes first of the k that a text fails in 120 / k orders.
        total("(c.mask & bit) > 0", "c.n * CAST(120 / bit_count(c.mask) AS LONG)").alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (SELECT text, min(doc_id) AS first FROM words GROUP BY text),
said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
          100 * length(regexp_replace(words.text, '[^A-Z]', '', 'g')) > 2 * length(words.text),
          regexp_matches(words.text, '[#$%&*|]'), coalesce(doc_id > first, false)] AS f
  FROM words LEFT JOIN firsts USING (text) LEFT JOIN said USING (doc_id)
), cells AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY part, f
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step::INT AS step, instr('ABCDE', substr(filter_order, step::INT, 1)) AS nth,
         list_transform(range(1, step), lambda i: instr('ABCDE', substr(filter_order, i::INT, 1))) AS before
  FROM orders, range(1, 6) r(step)
), counted AS (
  SELECT part, filter_order, step, nth, n, good, toxic, f[nth] AS fails,
         len(list_filter(before, lambda i: f[i])) > 0 AS gone, len(list_filter(f, lambda x: x)) AS failed
  FROM cells, steps
), per AS (
  SELECT part, filter_order, step, any_value(nth) AS nth, sum(n) FILTER (NOT gone AND NOT fails) AS kept,
         sum(n) FILTER (NOT gone AND fails) AS removed, sum(n) FILTER (gone AND fails) AS redundant,
         sum(n) FILTER (fails AND failed = 1) AS unique_fails, sum(good) FILTER (NOT gone AND fails) AS good_lost,
         sum(toxic) FILTER (NOT gone AND fails) AS toxic_lost
  FROM counted GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, nth), 0)::BIGINT AS shapley
FROM per
"""
QUERIES = {"op13_filter_audit": op13_filter_audit}
ORACLES = {"op13_filter_audit": OP13_SQL}
