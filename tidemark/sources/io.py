"""Sources and sinks: checked feeds, dumps, latest-per-key shards, snapshots, protected upserts, diffs and archives."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_own: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); a temporary one in a local session without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/tidemark-io"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tidemark-io-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def new_path(spark: SparkSession, name: str) -> str:
    return os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage of iterations."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_feed_csv(spark: SparkSession, path: str, schema: StructType | str, required: Sequence[str]) -> DataFrame:
    """A CSV feed with a header by a fixed schema; fails if a required column is not in the files. Bad cells become null."""
    head = spark.read.option("header", True).csv(path)
    missing = [c for c in required if c not in head.columns]
    if missing:
        raise ValueError(f"the feed lacks {missing}")
    typed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return head.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in typed if f.name in head.columns])


def read_copy_tsv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    r"""A database dump: tabs, \N for null, backslash escapes."""
    return spark.read.schema(schema).option("sep", "\t").option("nullValue", "\\N").option("escape", "\\").option("quote", "").csv(path)


def csv_to_parquet(spark: SparkSession, path: str, out: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """A legacy CSV to typed Parquet: {old name: (new name, type)}."""
    raw = spark.read.option("header", True).csv(path)
    raw.select(*[F.col(a).try_cast(t).alias(b) for a, (b, t) in columns.items()]).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def read_jsonl_latest(spark: SparkSession, path: str, schema: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """JSON lines in many shards: broken lines are skipped, of each key the last row by order stays."""
    raw = spark.read.schema(schema + ", _broken string").option("columnNameOfCorruptRecord", "_broken").json(path)
    names = [c for c in raw.columns if c not in (*key, "_broken")]
    good = raw.filter(F.col("_broken").isNull() & F.col(key[0]).isNotNull())
    return good.groupBy(*key).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("s")).select(*key, "s.*")


def merge_snapshots(docs: DataFrame, key: Sequence[str], has_result: Column, observed: str) -> DataFrame:
    """The newest observation of each key, unless an older one has results and the newer does not."""
    w = Window.partitionBy(*key).orderBy(has_result.desc(), F.desc(observed))
    return docs.withColumn("__k", F.row_number().over(w)).filter("__k = 1").drop("__k")


def merge_protect(target: DataFrame, updates: DataFrame, key: Sequence[str], protected: Sequence[str]) -> DataFrame:
    """Upsert in which a null never overwrites a protected column's value."""
    new = updates.select(*key, *[F.col(c).alias(f"__{c}") for c in updates.columns if c not in key], F.lit(True).alias("__new"))
    both = target.join(new, list(key), "full_outer")
    col = lambda c: F.coalesce(f"__{c}", c) if c in protected else F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c))
    return both.select(*key, *[col(c).alias(c) for c in target.columns if c not in key])


def fill_missing(target: DataFrame, sources: Sequence[tuple[str, DataFrame]], key: Sequence[str], col: str) -> DataFrame:
    """Empty cells of col from ranked sources (name, key and col), with the name of the one that was used."""
    out = target
    names = ["own", *[n for n, _ in sources]]
    for name, df in sources:
        out = out.join(df.select(*key, F.col(col).alias(f"__{name}")), list(key), "left")
    values = [F.col(col), *[F.col(f"__{n}") for n, _ in sources]]
    label = F.coalesce(*[F.when(v.isNotNull(), F.lit(n)) for n, v in zip(names, values, strict=True)])
    rest = [c for c in target.columns if c not in (*key, col)]
    return out.select(*key, *rest, F.coalesce(*values).alias(col), label.alias(f"{col}_source"))


def diff_tables(old: DataFrame, new: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Keys with kind: insert, change or delete. Rows that are the same are left out, so that an update writes no more."""
    a = old.select(*key, F.struct(*cols).alias("__a"), F.lit(True).alias("__old"))
    b = new.select(*key, F.struct(*cols).alias("__b"), F.lit(True).alias("__new"))
    j = a.join(b, list(key), "full_outer")
    kind = F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "delete").when(~F.col("__a").eqNullSafe(F.col("__b")), "change")
    return j.select(*key, kind.alias("kind")).filter("kind IS NOT NULL")


def refuse_large_delete(diff: DataFrame, old: DataFrame, share: float = 0.1) -> DataFrame:
    """diff, unless it deletes more than this share of the old rows."""
    gone, all_ = diff.filter("kind = 'delete'").count(), old.count()
    if gone > share * all_:
        raise ValueError(f"{gone} of {all_} rows would be deleted")
    return diff


def incremental(base: DataFrame, delta: DataFrame, key: Sequence[str], updated: str) -> DataFrame:
    """A cached base and the rows changed since: the newest row of each key, as a full read would give."""
    names = [c for c in base.columns if c not in key]
    both = base.unionByName(delta)
    return both.groupBy(*key).agg(F.max_by(F.struct(*names), F.col(updated)).alias("s")).select(*key, "s.*")


def freeze_past(target: DataFrame, updates: DataFrame, key: Sequence[str], day: str, today: Column) -> DataFrame:
    """Rows of days before today stay as they are; of today and later, updates win and the target fills in."""
    past = target.filter(F.col(day) < today)
    live = updates.filter(F.col(day) >= today)
    rest = target.filter(F.col(day) >= today).join(live, list(key), "left_anti")
    return past.unionByName(live).unionByName(rest)


def split_by_size(rows: DataFrame, key: str, order: str, size: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their part, index of key, part, n, bytes, first, last): a key's rows in order, cut every `most` bytes."""
    upto = F.sum("__bytes").over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    parts = rows.withColumn("__bytes", size).withColumn("part", F.floor((upto - F.col("__bytes")) / most))
    index = parts.groupBy(key, "part").agg(F.count("*").alias("n"), F.sum("__bytes").alias("bytes"), F.min(order).alias("first"), F.max(order).alias("last"))
    return parts.drop("__bytes"), index


def row_digests(cols: Sequence[str]) -> list[Column]:
    """Count, sum and xor of a hash of whole rows: equal for equal bags of rows, whatever their order; sums keep repeats."""
    h = F.xxhash64(*cols)
    return [F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")]


def archive_and_verify(rows: DataFrame, out: str, day: str) -> DataFrame:
    """One folder of gzip JSON for each day, read again; (day, n, same): whether counts and digests agree."""
    rows.write.mode("overwrite").partitionBy(day).option("compression", "gzip").json(out)
    back = rows.sparkSession.read.schema(rows.schema).json(out)
    cols = sorted(rows.columns)
    stats = lambda df, n: df.groupBy(F.col(day).cast("string").alias("day")).agg(F.struct(*row_digests(cols)).alias(n))
    j = stats(rows, "a").join(stats(back, "b"), "day", "full_outer")
    return j.select("day", F.col("a.n").alias("n"), F.col("a").eqNullSafe(F.col("b")).alias("same"))


def replace_sources(old: DataFrame, new: DataFrame, source: str, cols: Sequence[str]) -> DataFrame:
    """All rows of a source are replaced only if their digest changed; sources that new lacks keep their old rows."""
    digest = lambda df, n: df.groupBy(source).agg(F.struct(*row_digests(cols)).alias(n))
    changed = digest(new, "d2").join(digest(old, "d1"), source, "left").filter(~F.col("d1").eqNullSafe(F.col("d2"))).select(source)
    kept = old.join(changed, source, "left_anti").withColumn("replaced", F.lit(False))
    return kept.unionByName(new.join(changed, source, "left_semi").withColumn("replaced", F.lit(True)))


def write_partitions(rows: DataFrame, path: str, part: str, key: Sequence[str], rows_a_file: int = 5_000_000) -> int:
    """rows in a folder for each value of part; returns the files that the largest one may have.

    A value's rows are spread by a hash of key over as many tasks as its size asks for, so that no task writes many more
    than rows_a_file rows unless they share a key; a small value is one file.
    """
    sizes = written(rows.groupBy(part).agg(F.ceil(F.count("*") / rows_a_file).alias("__files")), "sizes")
    files = sizes.agg(F.max("__files")).first()[0] or 1
    own = sizes.select(F.col(part).alias("__part"), "__files")
    spread = rows.join(own, F.col(part).eqNullSafe(F.col("__part")), "left").withColumn("__file", F.pmod(F.xxhash64(*key), F.col("__files")))
    spread.repartition(part, "__file").drop("__part", "__files", "__file").write.partitionBy(part).parquet(path)
    return files


#: Outcomes of replace_checked that keep the old rows and count as a failure.
REFUSED = ("failed", "empty", "missing ids", "repeated ids")


def replace_checked(old: DataFrame, new: DataFrame, fetched: DataFrame, state: DataFrame, source: str, key: str, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, state): rows of a source are replaced only by a document that was fetched, is sound and has changed.

    fetched: source and status, "ok" or an error, once for each source that was asked for; state: source and failures in
    a row so far. A failed fetch, a document without rows, with a null id or with an id twice is refused: the old rows stay
    and the source's failures go up by one; any other document sets them to 0. Sources that weren't asked for keep rows
    and failures. The new state has source, outcome (same, replaced, not asked or one of REFUSED) and failures.
    """
    digest = lambda df, n: df.groupBy(source).agg(F.struct(*row_digests(cols)).alias(n))
    ids = new.groupBy(source, key).agg(F.count("*").alias("n")).groupBy(source)
    sound = ids.agg(F.max(F.when(F.col(key).isNotNull(), F.col("n"))).alias("most"), F.bool_or(F.col(key).isNull()).alias("blank"))
    sides = fetched.select(source, "status").join(digest(new, "d2"), source, "left").join(digest(old, "d1"), source, "left").join(sound, source, "left")
    outcome = (
        F.when(F.coalesce(F.col("status") != "ok", F.lit(True)), "failed").when(F.col("d2").isNull(), "empty").when(F.col("blank"), "missing ids")
        .when(F.col("most") > 1, "repeated ids").when(F.col("d1").eqNullSafe(F.col("d2")), "same").otherwise("replaced")
    )
    judged = written(sides.select(source, outcome.alias("outcome")), "judged")
    taken = judged.filter("outcome = 'replaced'").select(source)
    rows = old.join(taken, source, "left_anti").unionByName(new.join(taken, source, "left_semi"))
    before = F.coalesce("failures", F.lit(0))
    after = F.when(F.col("outcome").isNull(), before).when(F.col("outcome").isin(*REFUSED), before + 1).otherwise(0)
    both = state.select(source, "failures").join(judged, source, "full_outer")
    return rows, both.select(source, F.coalesce("outcome", F.lit("not asked")).alias("outcome"), after.alias("failures"))
