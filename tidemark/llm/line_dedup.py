"""Line dedup by distinct-site spread: lines that stand on many sites are boilerplate and are taken out.

1. Each line (trimmed of spaces, blank lines aside) gives a 96-bit hash. Of the lines with enough rows to reach the
   threshold, HyperLogLog sketches of the sites are aggregated for each hash, partly before the shuffle, so that a
   line of millions of rows is a sketch by then. Where these lines are too many to be broadcast, rows are first reduced
   to distinct (hash, site), again partly before the shuffle: a line then has a row for each of its sites at most.
2. A line whose estimate lies clearly beyond the threshold is boilerplate, one clearly below is not. For the lines
   near it, and only for them, sites are counted exactly.
3. A document loses all its boilerplate lines. Up to BROADCAST_LINES of them, counted first, go to every task as two
   arrays, and texts don't move; beyond that lines meet them in a shuffled join, the most frequent ones by broadcast.

Defined results: a null text is the empty one; a null site counts for no line; blank lines stay and are never
boilerplate; a document that repeats a line loses each of them; rows that repeat an id are handled each by itself; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import BROADCAST_ROWS, discard, join_groups, materialise, table
from ._segments import slices

#: Sites from which on a line is boilerplate.
MIN_SITES = 12
#: Of a sketch: 2^LG_K registers, about 1.04 / sqrt(2^LG_K) relative error; lines within BAND errors are recounted.
LG_K = 9
BAND = 6
#: Boilerplate lines at most that are broadcast, 12 bytes each.
BROADCAST_LINES = 1_000_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hash(line: Column) -> Column:
    line = F.btrim(line)
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def boilerplate(docs: DataFrame, *, site_col: str, text_col: str, min_sites: int = MIN_SITES, few: int = BROADCAST_ROWS) -> DataFrame:
    """h struct<a long, b int>, sites long, n long (documents): hashes of the lines that stand on at least min_sites sites.

    few: lines at most that are joined by broadcast."""
    line = F.explode(F.array_distinct(F.transform(F.filter(_lines(F.col(text_col)), lambda x: F.btrim(x) != ""), _hash)))
    rows = docs.select(F.col(site_col).alias("site"), line.alias("h")).filter("site IS NOT NULL")
    # A line with fewer rows than min_sites has fewer sites: just the others get a sketch, whose buffers are large.
    often = materialise(rows.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= min_sites), "frequent-lines")

    def of(lines: DataFrame) -> DataFrame:
        """site, h, n of the lines' rows; each site of a line once where the lines are many."""
        if lines.limit(few + 1).count() <= few:
            return rows.join(F.broadcast(lines), "h")
        return rows.distinct().join(lines, "h")

    spread = of(often).groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("est"), F.max("n").alias("n"))
    error = BAND * 1.04 / 2 ** (LG_K / 2)
    spread = materialise(spread.filter(F.col("est") >= min_sites * (1 - error)), "line-spread")
    near = F.col("est") <= min_sites * (1 + error)
    exact = of(spread.filter(near).select("h", "n")).groupBy("h").agg(F.count_distinct("site").alias("sites"), F.max("n").alias("n"))
    exact = exact.filter(F.col("sites") >= min_sites)
    out = materialise(spread.filter(~near).select("h", F.col("est").alias("sites"), "n").unionByName(exact), "boilerplate")
    discard(often, spread)
    return out


def remove_boilerplate(
    docs: DataFrame, *, id_col: str = "doc_id", site_col: str = "source", text_col: str = "text",
    min_sites: int = MIN_SITES, broadcast_lines: int = BROADCAST_LINES, few: int = BROADCAST_ROWS,
) -> DataFrame:
    """id, text string without boilerplate lines, n_lines long, n_removed long."""
    found = boilerplate(docs, site_col=site_col, text_col=text_col, min_sites=min_sites, few=few)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    if found.count() <= broadcast_lines:
        return _remove_in_place(rows, found).withColumnRenamed("id", id_col)
    return _remove_by_join(rows, found).withColumnRenamed("id", id_col)


def _remove_in_place(rows: DataFrame, found: DataFrame) -> DataFrame:
    hashes = found.select("h.a", "h.b").toArrow()
    a, b = (hashes.column(c).to_numpy() for c in ("a", "b"))
    order = np.lexsort((b, a))
    held = rows.sparkSession.sparkContext.broadcast((a[order], b[order]))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = held.value
        for batch in batches:
            for x, y in slices(batch.column("text")):
                part = batch.slice(x, y - x)
                a, b = (part.column(c).flatten().to_numpy() for c in ("a", "b"))
                offsets = part.column("a").offsets.to_numpy() - part.column("a").offsets[0].as_py()
                gone = np.zeros(len(a), bool)
                at = np.searchsorted(first, a)
                while (live := np.flatnonzero((at < len(first)) & ~gone)).size:  # hashes may share their first part
                    live = live[first[at[live]] == a[live]]
                    if not live.size:
                        break
                    gone[live] = second[at[live]] == b[live]
                    at = np.where(np.isin(np.arange(len(at)), live), at + 1, len(first))
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[offsets])
                texts = part.column("text").to_pylist()
                for k in np.flatnonzero(removed).tolist():
                    bad = gone[offsets[k] : offsets[k + 1]].tolist()
                    texts[k] = "\n".join(line for line, drop in zip(texts[k].split("\n"), bad, strict=True) if not drop)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(texts, pa.string()), pa.array(np.diff(offsets).astype(np.int64)), pa.array(removed.astype(np.int64))],
                    ["id", "text", "n_lines", "n_removed"],
                )

    lines = F.transform(_lines(F.col("text")), _hash)
    hashed = rows.select("id", "text", lines.alias("h")).select("id", "text", F.col("h.a").alias("a"), F.col("h.b").alias("b"))
    return hashed.mapInArrow(run, f"id {kind}, text string, n_lines long, n_removed long")


def _remove_by_join(rows: DataFrame, found: DataFrame) -> DataFrame:
    line = F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _hash)))
    hits = rows.select(F.col("id").alias("hit_id"), line.alias("h"))
    hits = join_groups(hits, found.select("h", "n"), ["h"], "n").filter("n IS NOT NULL")
    bad = materialise(hits.groupBy("hit_id").agg(F.collect_set("h").alias("bad")), "boilerplate-of-rows")
    rows = rows.select("id", _lines(F.col("text")).alias("lines"))
    rows = rows.join(bad, F.col("id").eqNullSafe(F.col("hit_id")), "left")
    good = F.filter("lines", lambda x: (F.btrim(x) == "") | ~F.array_contains(F.col("bad"), _hash(x)))
    kept = F.when(F.col("bad").isNull(), F.col("lines")).otherwise(good)
    return rows.withColumn("kept", kept).select(
        "id",
        F.array_join("kept", "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_boilerplate(table(spark, sf_dir, "documents"))


OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k
  FROM documents
), bad AS (
  SELECT trim(line, ' ') AS line FROM lines WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}
), judged AS (SELECT l.*, b.line IS NOT NULL AS gone FROM lines l LEFT JOIN bad b ON trim(l.line, ' ') = b.line)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
FROM judged GROUP BY doc_id
"""
QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLES = {"op1_line_dedup": OP1_SQL}
