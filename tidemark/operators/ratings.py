"""Entity models as Spark jobs: a filter that goes through each entity's rows, and alternating effects of two factors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import new_path
from .baseline import written


def kalman(rows: DataFrame, entity: str, day: str, order: Sequence[str], value: str, *, prior: float, var: float, noise: float, per_day: float) -> DataFrame:
    """rows with the filtered mean before each row: a scalar Kalman filter for each entity.

    Rows are dealt by entity and sorted, and a task goes through them once with three numbers of the entity at hand, so
    that neither many small entities nor one with many rows take more memory or time than their rows.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, entity).sortWithinPartitions(entity, F.asc_nulls_last(day), *[F.asc_nulls_last(c) for c in order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        who, m, p, last = none, prior, var, None
        for batch in batches:
            out = []
            for e, d, v in zip(*(batch.column(c).to_pylist() for c in (entity, day, value)), strict=True):
                if e != who:
                    who, m, p = e, prior, var
                elif d is not None and last is not None:
                    p += per_day * (d - last)
                last = d
                out.append(m)
                if v is not None and v == v:
                    k = p / (p + noise)
                    m, p = m + k * (v - m), (1 - k) * p
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "before"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", before double"
    return dealt.mapInArrow(run, schema)


#: Effects that are sent to every task; more of them meet their rows by a join.
SENT_EFFECTS = 5_000_000
#: Rows of a file of the first factor, about, and files at least.
BUCKET_ROWS, BUCKETS = 5_000_000, 32


def two_way_ridge(rows: DataFrame, a: str, b: str, value: str, *, l_a: float = 5.0, l_b: float = 20.0, rounds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Shrunk additive effects of two factors by alternating means sum / (n + lambda).

    Cells of the two factors are written once, dealt by a in buckets that Spark reads without a shuffle. In a round the
    effects of b are sent to them, those of a come from a window inside a bucket, and what moves are sums by bucket and b.
    """
    spark = rows.sparkSession
    mean = rows.agg(F.avg(value).alias("m")).first()["m"] or 0.0
    base = written(rows.groupBy(a, b).agg(F.count("*").alias("n"), F.sum(F.col(value) - mean).alias("s")), "ridge")
    buckets = max(BUCKETS, -(-base.count() // BUCKET_ROWS))
    name = f"ridge_{uuid.uuid4().hex}"
    base.repartition(buckets, a).write.option("path", new_path(spark, "ridge-dealt")).bucketBy(buckets, a).sortBy(a).saveAsTable(name)
    base = spark.table(name)
    of_a = Window.partitionBy(a)
    eb: DataFrame | None = None

    def with_effects() -> DataFrame:
        """Cells with ea, which the effects of b so far leave."""
        left = base.withColumn("eb", F.lit(0.0))
        if eb is not None:
            left = base.join(F.broadcast(eb) if few else eb, b)
        return left.withColumn("ea", F.sum(F.col("s") - F.col("n") * F.col("eb")).over(of_a) / (F.sum("n").over(of_a) + l_a))

    few = base.select(b).distinct().limit(SENT_EFFECTS + 1).count() <= SENT_EFFECTS
    for _ in range(rounds):
        eb = written(with_effects().groupBy(b).agg((F.sum(F.col("s") - F.col("n") * F.col("ea")) / (F.sum("n") + l_b)).alias("eb")), "ridge-b")
    ea = written(with_effects().groupBy(a).agg(F.first("ea").alias("ea")), "ridge-a")
    spark.sql(f"DROP TABLE {name}")  # its files stay, as those of other rounds do
    return ea, eb
