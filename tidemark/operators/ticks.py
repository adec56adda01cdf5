"""Tick analytics: time-stamped observations before a deadline. Batch functions that also run on streams where marked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def before_deadline(ticks: DataFrame, ts: str = "ts", deadline: str = "deadline") -> DataFrame:
    """Ticks up to the deadline with minutes_left (double)."""
    left = F.timestamp_diff("SECOND", F.col(ts), F.col(deadline)) / 60
    return ticks.filter(F.col(ts) <= F.col(deadline)).withColumn("minutes_left", left)


def base_values(ticks: DataFrame, by: Sequence[str], minutes: Sequence[int], value: str = "value", order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """by, m, base: for each m, the value of the latest tick at least m minutes before the deadline. One grouping for all m."""
    rows = ticks.withColumn("m", F.explode(F.array(*map(F.lit, minutes)))).filter("minutes_left >= m")
    return rows.groupBy(*by, "m").agg(F.max_by(value, F.struct(*order)).alias("base"))


def final_values(ticks: DataFrame, by: Sequence[str], value: str = "value", order: Sequence[str] = ("ts", "id")) -> DataFrame:
    return ticks.groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias("final"))


def drop_ratio(base: Column, final: Column) -> Column:
    return 1 - F.try_divide(final, base)


def thin(ticks: DataFrame, by: Sequence[str], minutes: Sequence[int], order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """The first and last tick of each group and those nearest to the given minutes before the deadline."""
    w = Window.partitionBy(*by)
    up, down = w.orderBy(*order), w.orderBy(*[F.desc(c) for c in order])
    near = lambda m: F.row_number().over(w.orderBy(F.abs(F.col("minutes_left") - m), *order)) == 1
    marks = {"first": F.row_number().over(up) == 1, "last": F.row_number().over(down) == 1} | {f"near{m}": near(m) for m in minutes}
    keep = ticks.select("*", *[c.alias(f"__{n}") for n, c in marks.items()])
    some = None
    for n in marks:
        some = F.col(f"__{n}") if some is None else some | F.col(f"__{n}")
    return keep.filter(some).drop(*[f"__{n}" for n in marks])


def collapses(ticks: DataFrame, by: Sequence[str], most: float = 0.5, order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """Ticks whose value is at most `most` of the one before in the same group, with that one."""
    prev = F.lag("value").over(Window.partitionBy(*by).orderBy(*order))
    return ticks.withColumn("previous", prev).filter((F.col("previous") > 0) & (F.col("value") <= most * F.col("previous")))


def segment_values(ticks: DataFrame, by: Sequence[str], segment: Column, first: str = "first", value: str = "value", order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """by, segment, o: the last value in each time segment and, as the segment named `first`, the very first one.

    A tick without a value counts as none. One grouping by segment, whose rows are one for each segment of a group.
    """
    known = ticks.filter(F.col(value).isNotNull()).withColumn("__segment", segment)
    parts = known.groupBy(*by, "__segment").agg(F.max_by(value, F.struct(*order)).alias("o"), F.min(F.struct(*order, F.col(value).alias("o"))).alias("__first"))
    item = F.struct(F.col("__segment").alias("segment"), "o")
    whole = parts.groupBy(*by).agg(F.collect_list(item).alias("__all"), F.min("__first").alias("__first"))
    start = F.array(F.struct(F.lit(first).alias("segment"), F.col("__first.o").alias("o")))
    return whole.select(*by, F.inline(F.concat(start, "__all")))


def slots(ticks: DataFrame, by: Sequence[str], key: str, slot: Column, order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """by, key, i, o, r: each key's last value in every slot, the slot's number within the group, the value's rank in it."""
    last = ticks.withColumn("__slot", slot).groupBy(*by, key, "__slot").agg(F.max_by("value", F.struct(*order)).alias("o"))
    i = F.dense_rank().over(Window.partitionBy(*by).orderBy("__slot"))
    r = F.rank().over(Window.partitionBy(*by, "__slot").orderBy("o"))
    return last.select(*by, key, i.alias("i"), "o", r.alias("r"))


def ranked_collapses(slots: DataFrame, by: Sequence[str], key: str, most: float = 0.5, best: int = 5) -> DataFrame:
    """Rows among the `best` of a slot that fell to `most` of the slot right before it, with that value and rank."""
    w = Window.partitionBy(*by, key).orderBy("i")
    prev = slots.select("*", F.lag("i").over(w).alias("pi"), F.lag("o").over(w).alias("o0"), F.lag("r").over(w).alias("r0"))
    fell = (F.col("o0") > 0) & (F.col("o") > 0) & (F.col("o") <= most * F.col("o0") + 1e-9)
    return prev.filter((F.col("pi") == F.col("i") - 1) & (F.col("r") <= best) & fell).drop("pi")


def latest(ticks: DataFrame, by: Sequence[str], cols: Sequence[str], order: Sequence[str] = ("ts", "id")) -> DataFrame:
    """The latest row of each key: an upsert state (update mode on a stream)."""
    best = F.max_by(F.struct(*cols), F.struct(*order))
    return ticks.groupBy(*by).agg(best.alias("s")).select(*by, "s.*")


def tumbling(ticks: DataFrame, width: str, by: Sequence[str], ts: str = "ts", slide: str | None = None) -> DataFrame:
    """Counts and sums by event-time window; on a stream set a watermark first."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return ticks.groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *by, "n", "total")


def sessions(ticks: DataFrame, gap: str, by: Sequence[str], ts: str = "ts") -> DataFrame:
    g = ticks.groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")
