"""Exact dedup: fuse filters of an immutable snapshot screen a new batch's digests, exact buckets confirm by bytes.

1. Every row gets digests of its normalised text (A-Z lower-cased, null is empty): 64 bits to screen and SHA-256.
2. Rows are grouped by digest within the snapshot and within the new batch, with partial sums before the shuffle,
   so that a text that a third of all rows share is a few rows by then.
3. The snapshot's distinct 64-bit digests, split by hash range into buckets of bounded size, each give a static
   binary-fuse filter. The filters are a table of the snapshot, built once for as long as it stands.
4. The batch's distinct digests are screened bucket by bucket. Only positives join the snapshot's exact buckets,
   where whole texts are compared byte by byte; negatives are new for certain.
5. Groups that the bytes confirm are merged; the row with the largest id stays in each.

Defined results: a null text equals an empty one; a null id is smaller than any other; rows that repeat an id and
a text are one row for the choice, and just one of them stays; an empty table gives no rows; further columns are
not read by `find_duplicates` and are kept by `drop_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _fuse
from ._common import ascii_lower, discard, join_groups, materialise, small, table

#: Keys in a filter on average: a bucket's keys are one task's row of half a megabyte.
KEYS_PER_FILTER = 65_536


def _bucket(h64: Column, buckets: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h64, 20), F.lit(buckets))


def _by_bucket(keys: DataFrame, buckets: int, name: str) -> DataFrame:
    return keys.groupBy(_bucket(F.col("h64"), buckets).alias("bucket")).agg(F.collect_list("h64").alias(name))


def build_filters(keys: DataFrame, buckets: int) -> DataFrame:
    """(bucket, filter): a binary-fuse filter for each bucket of distinct h64 keys."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = _fuse.build(batch.column(1)[i].values.to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([made], pa.binary())], ["bucket", "filter"]
                )

    return _by_bucket(keys, buckets, "keys").mapInArrow(build, "bucket long, filter binary")


def screen(keys: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The distinct h64 keys that the filters may hold."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked = batch.column(0)[i].values.to_numpy()
                found = asked[_fuse.contains(batch.column(1)[i].as_py(), asked.view(np.uint64))]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["h64"])

    asked = _by_bucket(keys, buckets, "asked").join(filters, "bucket").select("asked", "filter")
    return asked.mapInArrow(probe, "h64 long")


def _digests(docs: DataFrame, in_snapshot: Column, id_col: str, text_col: str) -> DataFrame:
    text = docs.select(F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("norm"), in_snapshot.alias("old"))
    return text.select("id", "old", "norm", F.xxhash64("norm").alias("h64"), F.unhex(F.sha2("norm", 256)).alias("sha"))


def find_duplicates(
    docs: DataFrame, in_snapshot: Column, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size long, kept boolean, text_sha256 string.

    in_snapshot says which rows belong to the published snapshot; the others are the new batch.
    """
    texts = _digests(docs, F.coalesce(in_snapshot, F.lit(False)), id_col, text_col)
    rows = materialise(
        texts.groupBy("id", "old", "h64", "sha").agg(F.count("*").alias("times")), "digests"
    )
    groups = materialise(
        rows.groupBy("old", "h64", "sha").agg(F.max("id").alias("top"), F.sum("times").alias("n")), "digest-groups"
    )
    old, new = groups.filter("old"), groups.filter("NOT old")
    old_keys = old.select("h64").distinct()
    buckets = max(1, -(-groups.count() // KEYS_PER_FILTER))
    filters = materialise(build_filters(old_keys, buckets), "fuse-filters")
    maybe = screen(new.select("h64").distinct(), filters, buckets)
    # The bytes of one text for each group that passed, of both sides.
    asked = materialise(
        new.join(maybe, "h64", "left_semi").unionByName(
            old.join(maybe, "h64", "left_semi").join(new.select("h64", "sha"), ["h64", "sha"], "left_semi")
        ).select("top", F.col("old").alias("side"), F.col("sha").alias("asked_sha")),
        "asked",
    )
    bytes_of = texts.join(
        small(asked), F.col("id").eqNullSafe(F.col("top")) & (F.col("old") == F.col("side")) & (F.col("sha") == F.col("asked_sha"))
    ).select("h64", "sha", "norm", "old")
    left = bytes_of.filter("NOT old").select("h64", "norm", "sha")
    right = bytes_of.filter("old").select("h64", "norm")
    same = left.join(right, ["h64", "norm"]).select("sha").distinct().withColumn("same", F.lit(True))
    # One group where the bytes agree, else one for each side.
    flagged = groups.join(same, "sha", "left").withColumn(
        "part", F.when(F.col("same"), 0).when(F.col("old"), 1).otherwise(2)
    )
    merged = flagged.groupBy("sha", "part").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))
    sides = F.explode(F.when(F.col("part") == 0, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.col("part") == 1)))
    several = materialise(
        merged.filter("group_size > 1").select("sha", sides.alias("old"), "keep_id", "group_size"), "copies"
    )
    out = join_groups(rows, several, ["sha", "old"], "group_size")
    alone = F.col("group_size").isNull()
    stays = alone | F.col("id").eqNullSafe(F.col("keep_id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        stays.alias("stays"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"),
    ).select(id_col, "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def older_half(id_col: str = "doc_id") -> Column:
    """A fixed half of all ids stands for the published snapshot; the other half arrives as the new batch."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")) % 2 == 0


def drop_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with all their columns, without the rows that `find_duplicates` does not keep."""
    found = materialise(find_duplicates(docs, older_half(id_col), id_col=id_col, text_col=text_col), "duplicates")
    gone = found.groupBy(F.col(id_col).alias("gone_id"), F.col("text_sha256").alias("gone_sha")).agg(
        F.max("kept").alias("one_stays"), F.count("*").alias("times")
    )
    gone = materialise(gone.filter("NOT one_stays OR times > 1"), "gone")
    dropped = small(gone.filter("NOT one_stays"))
    # Columns go by their places here: whatever name they have, none is overwritten.
    names = docs.columns
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    out = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("sha", F.sha2(ascii_lower(F.col(text)), 256))
    same = out[key].eqNullSafe(dropped["gone_id"]) & (out["sha"] == dropped["gone_sha"])
    out = out.join(dropped, same, "left_anti")
    repeated = gone.filter("one_stays")
    if repeated.limit(1).count():  # rows that repeat an id and its text: one of them; the others don't move
        repeated = small(repeated)
        same = out[key].eqNullSafe(repeated["gone_id"]) & (out["sha"] == repeated["gone_sha"])
        one = out.join(repeated, same, "left_semi").dropDuplicates([key, "sha"])
        out = out.join(repeated, same, "left_anti").unionByName(one)
    discard(found)
    return out.drop("sha").toDF(*names)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), older_half())


OP7_SQL = """
WITH norm AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS sha
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha AS text_sha256
FROM norm WINDOW g AS (PARTITION BY sha)
"""
QUERIES = {"op7_exact_dedup": op7_exact_dedup}
ORACLES = {"op7_exact_dedup": OP7_SQL}
