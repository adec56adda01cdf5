"""Robust baselines: as-of medians with fallback levels, day values, alternating-median effects, pooled percentiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import written
from .rolling import rolling

#: Levels of all factors together whose effects are sent to every task.
LEVELS_SENT = 1_000_000


def asof_medians(rows: DataFrame, levels: Sequence[tuple[str, Sequence[str], int]], *, day: str, value: str, least: int = 8) -> DataFrame:
    """rows with baseline and level: the median of value over the days before, at the first level with `least` rows.

    levels: (name, keys, days), finest first. Each level is one rolling pass for its distinct (keys, day). Rows are written
    once, and the columns that levels need are counted once; levels meet on the distinct keys, and rows are joined once.
    """
    rows = written(rows, "rows")
    every = list(dict.fromkeys(k for _, keys, _ in levels for k in keys))
    known = written(rows.groupBy(*dict.fromkeys([*every, day, value])).agg(F.count("*").alias("__times")), "levels")
    cells = known.select(*every, day).distinct()
    for name, keys, days in levels:
        med = rolling(known.select(*keys, day).distinct(), known, by=list(keys), day=day, value=value, days=days, times="__times", counted=set(keys) == set(every))
        med = med.filter(F.col("window_n") >= least).select(*keys, day, F.col("window").alias(f"__{name}"))
        cells = cells.join(med, [*keys, day], "left")
    names = [n for n, _, _ in levels]
    label = F.coalesce(*[F.when(F.col(f"__{n}").isNotNull(), F.lit(n)) for n in names])
    found = written(cells.select(*every, day, F.coalesce(*[F.col(f"__{n}") for n in names]).alias("baseline"), label.alias("level")), "baselines")
    return rows.join(found, [*every, day], "left").select(*rows.columns, "baseline", "level")


def median_of_others(rows: DataFrame, by: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """rows with others double: the median of the group's values without the row's own (taken out by place, not by value).

    A row's place among its group's values and the three values around the middle tell it, so no row holds its group.
    Nulls are no values; a row with a null has the median of all; a group without other values gives null. order breaks
    ties and must tell a group's rows apart.
    """
    group = Window.partitionBy(*by)
    n, place = F.count(value).over(group), F.row_number().over(group.orderBy(F.asc_nulls_last(value), *order))
    ranked = rows.withColumn("__n", n).withColumn("__k", place - 1).withColumn("__lo", F.floor((F.col("__n") - 2) / 2))
    near = lambda i: F.max(F.when(F.col("__k") == F.col("__lo") + i, F.col(value))).over(group)
    ranked = ranked.select("*", *[near(i).alias(f"__v{i}") for i in range(3)])
    own, lo, hi = F.col(value).isNotNull(), F.col("__lo"), F.floor((F.col("__n") - 1) / 2)
    low = F.when(lo < F.col("__k"), F.col("__v0")).otherwise(F.col("__v1"))
    high = F.when(hi == lo, low).otherwise(F.when(hi < F.col("__k"), F.col("__v1")).otherwise(F.col("__v2")))
    whole = (F.when(hi == lo, F.col("__v0")).otherwise(F.col("__v1")) + F.col("__v1")) / 2
    others = F.when(own, F.when(F.col("__n") > 1, (low + high) / 2)).otherwise(whole)
    return ranked.select(*rows.columns, others.alias("others"))


def alternating_medians(rows: DataFrame, factors: Sequence[str], value: str, rounds: int = 3, *, small: int = 100_000, moved: dict[str, float] | None = None, times: str | None = None) -> dict[str, DataFrame]:
    """Additive effects of the factors: each in turn is the median of what the others leave, a fixed number of times.

    Rows with the same factors and value are counted once and stand for all their copies in every round. Where no group has
    more than 20 `small` such rows and levels are LEVELS_SENT at most, each factor's groups lie packed in arrays, so that a step
    moves no rows; else steps are joins, and groups of more than `small` rows are medians by selection. moved, if given, gets the largest change that each factor's
    effects had in the last round, so that a caller sees how far they are from standing still. times: how many rows each
    row stands for, if not one.
    """
    from .selection import largest_group, percentiles

    rows = written(rows.groupBy(*factors, value).agg((F.sum(times) if times else F.count("*")).alias("__times")), "alternating")
    largest = {f: largest_group(rows, [f], value) for f in factors}
    if max(largest.values()) <= 20 * small and rows.count() > small:
        levels = {f: written(rows.select(f).distinct(), "factor") for f in factors}
        if sum(x.count() for x in levels.values()) <= LEVELS_SENT:
            return _packed_medians(rows, levels, value, rounds, moved)
    effects: dict[str, DataFrame] = {}
    for turn in range(rounds):
        for f in factors:
            left = rows
            rest = F.col(value)
            for g in factors:
                if g != f and g in effects:
                    left = left.join(effects[g].select(g, F.col("effect").alias(f"__{g}")), g)
                    rest = rest - F.col(f"__{g}")
            found = percentiles(left.select(f, rest.alias("__rest"), "__times"), [f], "__rest", small=small, largest=largest[f], times="__times")
            before = effects.get(f)
            effects[f] = written(found.withColumnRenamed("percentile", "effect"), "effect")
            if moved is not None and turn == rounds - 1 and before is not None:
                change = effects[f].join(before.withColumnRenamed("effect", "__old"), f).agg(F.max(F.abs(F.col("effect") - F.col("__old"))).alias("m"))
                moved[f] = change.first()["m"] or 0.0
    return effects


def _weighted_median(values: np.ndarray, times: np.ndarray) -> float:
    """The median of the values that are numbers, each there so many times; NaN if there is none."""
    known = ~np.isnan(values)
    values, times = values[known], times[known]
    if not len(values):
        return np.nan
    if times.max() == 1:
        ranks = [(len(values) - 1) // 2, len(values) // 2]
        low, high = np.partition(values, ranks)[ranks]
    else:
        order = np.argsort(values)
        upto = np.cumsum(times[order])
        low, high = values[order][np.searchsorted(upto, [(upto[-1] - 1) // 2, upto[-1] // 2], "right")]
    return float(low) if low == high else 0.5 * low + 0.5 * high


def _packed_medians(rows: DataFrame, levels: dict[str, DataFrame], value: str, rounds: int, moved: dict[str, float] | None) -> dict[str, DataFrame]:
    """`alternating_medians` of rows with __times: levels are numbered, each factor has the rows of its levels as arrays, and a
    step goes over them with the effects of the other factors, one number for each level."""
    from .daily import packed, wide

    spark, factors = rows.sparkSession, list(levels)
    names = [f"c{i}" for i in range(len(factors))]
    coded, known, effects, nulls = rows.select(*factors, F.col(value).cast("double").alias("v"), F.col("__times").cast("long").alias("t")), {}, {}, {}
    for f, c in zip(factors, names, strict=True):
        known[f] = written(levels[f].withColumn(c, F.row_number().over(Window.orderBy(f)) - 1), "levels")  # levels, not rows
        nulls[f] = [r[0] for r in known[f].filter(F.col(f).isNull()).select(c).collect()]  # none or one
        own = known[f].select(F.col(f).alias("__level"), c)
        coded = coded.join(F.broadcast(own), F.col(f).eqNullSafe(F.col("__level"))).drop("__level")
    coded = written(coded.select(*names, "v", "t"), "coded")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = {f: known[f].count() for f in factors}
    groups = {}
    for f, c in zip(factors, names, strict=True):
        others = [x for x in names if x != c]
        groups[f] = written(packed(coded.repartition(parts, c).sortWithinPartitions(c), [c], [*others, "v", "t"]), "groups")

    def step(c: str, sent: dict[str, np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for i in range(batch.num_rows):
                    rest = wide(batch.column("v")[i])[0]
                    for other, effect in sent.items():
                        rest = rest - effect[wide(batch.column(other)[i], kind=np.int32)[0]]
                    found.append(_weighted_median(rest, wide(batch.column("t")[i], kind=np.int64)[0]))
                yield pa.RecordBatch.from_arrays([batch.column(c), pa.array(found, pa.float64())], ["code", "effect"])

        return run

    for turn in range(rounds):
        for f, c in zip(factors, names, strict=True):
            sent = {}
            for g, other in zip(factors, names, strict=True):
                if g != f and g in effects:
                    sent[other] = effects[g].copy()
                    sent[other][nulls[g]] = np.nan  # a level without a name has an effect that no row of the others meets
            before, effects[f] = effects.get(f), np.full(size[f], np.nan)
            for code, effect in groups[f].mapInArrow(step(c, sent), "code long, effect double").collect():  # one row a level
                effects[f][code] = effect
            if moved is not None and turn == rounds - 1 and before is not None:
                change = np.abs(effects[f] - before)
                change[nulls[f]] = np.nan
                moved[f] = float(np.nanmax(change)) if (~np.isnan(change)).any() else 0.0
    out = {}
    for f, c in zip(factors, names, strict=True):
        found = spark.createDataFrame([(i, float(x)) for i, x in enumerate(effects[f]) if not np.isnan(x)], "code int, effect double") if f in effects else None
        if found is not None:
            out[f] = known[f].join(found, F.col(c) == F.col("code")).select(f, "effect")
    return out


def pooled_percentile(rows: DataFrame, pool: DataFrame, *, by: Sequence[str], day: str, value: str, days: int = 365, least: int = 20) -> DataFrame:
    """rows with the share of pool values of the days before that are smaller, ties counting half; null below `least`."""
    out = rolling(rows, pool.select(*by, day, value), by=list(by), day=day, value=value, days=days, stat="share_below").filter("window_n > 0")
    return out.select(*rows.columns, F.col("window_n").alias("pool_n"), F.when(F.col("window_n") >= least, F.col("window")).alias("pct"))


def quartile_label(value: Column, by: Sequence[str], labels: Sequence[str]) -> Column:
    w = Window.partitionBy(*by)
    cuts = [F.percentile(value, q).over(w) for q in (0.25, 0.5, 0.75)]
    out = F.lit(labels[3])
    for cut, label in reversed(list(zip(cuts, labels, strict=False))):
        out = F.when(value < cut, F.lit(label)).otherwise(out)
    return F.when(value.isNotNull(), out)
