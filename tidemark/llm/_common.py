"""Helpers that the training-data operators share: shared storage, skew-safe joins, reading tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that hold at least this share of all rows are joined by broadcast: there can be at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 2000
#: Rows of (long, long) at most in a broadcast whose size is counted first: about 16 MB.
BROADCAST_ROWS = 250_000

_own_dir: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in spark.checkpoint.dir.

    A local session (tests) that names none gets a temporary folder, removed at exit; a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/tidemark"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="tidemark-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return _own_dir[0]


def materialise(df: DataFrame, name: str = "t") -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts the lineage and survives lost executors."""
    path = os.path.join(shared_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*written: DataFrame) -> None:
    """Removes the folders of DataFrames that `materialise` returned and that no result reads any more."""
    for df in written:
        if path := getattr(df, "_written_at", None):
            context = df.sparkSession.sparkContext
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has few rows (counted), else df as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """rows left-joined with groups (one row for each key, `size` its number of rows), safe for hot keys.

    Groups with at least HOT_SHARE of all rows are few by arithmetic, so they are broadcast and their rows
    never move; the others are shuffled and none of them can fill a task. groups must be materialised.
    Keys compare null-safe. Groups that are missing leave nulls.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    least = max(1000, int(total * HOT_SHARE))
    hot, rest = groups.filter(F.col(size) >= least), groups.filter(F.col(size) < least)
    if not hot.limit(1).count():
        return _left(rows, rest, keys, broadcast=False)
    others = [c for c in groups.columns if c not in keys]
    both = _left(rows, hot, keys, broadcast=True)
    found = both.filter(F.col(size).isNotNull())
    return found.unionByName(_left(both.filter(F.col(size).isNull()).drop(*others), rest, keys, broadcast=False))


def _left(rows: DataFrame, groups: DataFrame, keys: list[str], *, broadcast: bool) -> DataFrame:
    right = groups.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    on = None
    for k in keys:
        same = rows[k].eqNullSafe(right[f"__{k}"])
        on = same if on is None else on & same
    out = rows.join(F.broadcast(right) if broadcast else right, on, "left")
    return out.drop(*[f"__{k}" for k in keys])


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null counts as empty. Texts that are all ASCII take the fast path."""
    text = F.coalesce(text, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )
