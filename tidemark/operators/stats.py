"""Statistics over dated participations: records, periods, kinds, roll-ups, nested breakdowns, lifts and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def half_up(x: Column, digits: int = 4) -> Column:
    """x rounded half up by plain arithmetic; a millionth of the last digit more, so that sums whose last bits differ agree."""
    return F.floor(x * 10**digits + 0.500001) / 10**digits


def record(finish: str = "finish", returns: str = "price", stake: str = "measure", day: str = "day") -> list[Column]:
    """Aggregates of one group: n, wins, second and third places, rates in percent, return on stake, first and last day."""
    place = lambda k: F.count_if(F.col(finish) <= k)
    pct = lambda c: F.round(F.try_divide(100 * c, F.count("*")), 4)
    # Money is summed in whole hundredths, so that the order of rows can't show in the last digit.
    paid = F.sum(F.when(F.col(finish) == 1, F.round(F.col(returns) * 100).cast("long")).otherwise(0)) / 100
    return [
        F.count("*").alias("n"), F.count_if(F.col(finish) == 1).alias("w1"), F.count_if(F.col(finish) == 2).alias("w2"),
        F.count_if(F.col(finish) == 3).alias("w3"), pct(place(1)).alias("win_pct"), pct(place(2)).alias("top2_pct"),
        pct(place(3)).alias("top3_pct"), half_up(F.try_divide(paid, F.sum(stake))).alias("roi"),
        F.min(day).alias("since"), F.max(day).alias("until"),
    ]


def by_kinds(rows: DataFrame, kinds: dict[str, Sequence[str]]) -> DataFrame:
    """Long form: a row for each kind, with up to two keys k1 and k2. One scan for all kinds; rows without a key are left out."""
    made = [
        F.struct(F.lit(k).alias("kind"), F.col(c[0]).cast("string").alias("k1"), (F.col(c[1]).cast("string") if len(c) > 1 else F.lit("")).alias("k2"))
        for k, c in kinds.items()
    ]
    return rows.withColumn("__k", F.explode(F.array(*made))).select("__k.*", *rows.columns).filter("k1 IS NOT NULL AND k2 IS NOT NULL")


def in_periods(rows: DataFrame, periods: Sequence[tuple[str, str, str]], day: str = "day") -> DataFrame:
    """Each row once for each period (name, first day, last day) that holds its day. Periods are a handful of literals."""
    made = [F.when(F.col(day).between(F.lit(a).cast("date"), F.lit(b).cast("date")), F.lit(n)) for n, a, b in periods]
    return rows.withColumn("period", F.explode(F.array_compact(F.array(*made))))


def breakdown(rows: DataFrame, keys: Sequence[str], part: str, least: int, aggregates: Sequence[Column]) -> DataFrame:
    """Parent rows with an array of one struct for each value of part with at least `least` rows, most rows first."""
    inner = rows.groupBy(*keys, part).agg(F.count("*").alias("n"), *aggregates).filter(F.col("n") >= least)
    names = [c for c in inner.columns if c not in keys and c not in (part, "n")]
    item = F.struct((-F.col("n")).alias("o"), F.col(part).alias("part"), F.col("n"), *names)
    return inner.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("parts"))


def top_with_ties(rows: DataFrame, by: Sequence[str], value: str, n: int, cap: int, then: Sequence[str]) -> DataFrame:
    """The n best of each group and all that tie with the n-th, up to cap rows."""
    w = Window.partitionBy(*by).orderBy(F.desc(value))
    out = rows.withColumn("place", F.rank().over(w)).withColumn("__row", F.row_number().over(w.orderBy(F.desc(value), *then)))
    return out.filter((F.col("place") <= n) & (F.col("__row") <= cap)).drop("__row")


def lift(rows: DataFrame, cell: Sequence[str], base: Sequence[str], hit: Column, least: int = 20) -> DataFrame:
    """Hit rate of a cell over the rate of its base group; null below `least` rows."""
    part = rows.groupBy(*cell).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))
    whole = rows.groupBy(*base).agg(F.count("*").alias("base_n"), F.count_if(hit).alias("base_hits"))
    ratio = F.try_divide(F.col("hits") / F.col("n"), F.col("base_hits") / F.col("base_n"))
    joined = part.join(whole, list(base)) if base else part.crossJoin(F.broadcast(whole))
    return joined.select(*cell, "n", "hits", F.when(F.col("n") >= least, F.round(ratio, 4)).alias("lift"))


def average_rank(value: Column, by: Sequence[str]) -> Column:
    """Rank within a group where ties share the mean of their places; null for null."""
    w = Window.partitionBy(*by).orderBy(value.asc_nulls_last())
    ties = F.count("*").over(Window.partitionBy(*by, value))
    return F.when(value.isNotNull(), F.rank().over(w) + (ties - 1) / 2)


def shrunk(hits: Column, n: Column, prior: Column | float, weight: float) -> Column:
    """Empirical-Bayes rate: (hits + weight * prior) / (n + weight)."""
    prior = F.lit(prior) if isinstance(prior, int | float) else prior
    return (F.coalesce(hits, F.lit(0)) + weight * prior) / (F.coalesce(n, F.lit(0)) + weight)


def islands(day: Column, by: Sequence[str], order: Sequence[str], gap: int) -> Column:
    """Number of the block that a row is in: a new one begins more than gap days after the row before."""
    w = Window.partitionBy(*by).orderBy(*order)
    return F.sum(F.when(F.coalesce(day - F.lag(day).over(w) > gap, F.lit(True)), 1).otherwise(0)).over(w)


def numbered(rows: DataFrame, order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """rows with their place in the order, from 1: ranges of the order are numbered side by side, each from the sum of
    the sizes of those before it. Rows with equal keys are in one range."""
    from .baseline import written

    parts = written(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = sorted((r["__part"], r["count"]) for r in parts.groupBy("__part").count().collect())  # one row a range
    starts, before = [], 0
    for part, n in sizes:
        starts.append((part, before))
        before += n
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "__part int, __before long"))
    k = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return parts.withColumn("__k", k).join(starts, "__part").withColumn(name, F.col("__before") + F.col("__k")).drop("__part", "__k", "__before")


def tie_mean(place: Column, ties: Column, amounts: Sequence[int]) -> Column:
    """Whole amount of a place that `ties` share: the mean of the amounts of the places they take up, cut to a whole number;
    places beyond the table have nothing."""
    last = len(amounts)
    taken = F.slice(F.array(*[F.lit(a).cast("long") for a in amounts]), F.least(place, F.lit(last)).cast("int"), F.least(ties, last + 1 - F.least(place, F.lit(last))).cast("int"))
    return F.when(place <= last, F.floor(F.aggregate(taken, F.lit(0).cast("long"), lambda a, b: a + b) / ties)).otherwise(F.lit(0)).cast("long")


def capped_fold(start: Column, rows: Column, amount: str, limit: str, cap: int) -> Column:
    """start plus the amounts of an ordered array of structs, each of which lifts the sum up to the row's limit and never
    lowers it, all up to cap."""
    return F.aggregate(rows, start.cast("long"), lambda a, r: F.least(F.lit(cap).cast("long"), F.greatest(a, F.least(a + r[amount], r[limit]))))
