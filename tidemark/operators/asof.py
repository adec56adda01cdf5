"""As-of joins and as-of windows: every value uses rows strictly before (or up to) a day, never the day's own.

Two forms of a windowed sum: `frame` aggregates over a range frame of day buckets; `prefix` takes the difference of
two running sums, each fetched by an as-of join, which stays linear where frames hold many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame, right: DataFrame, *, by: Sequence[str], left_on: str, right_on: str, take: Sequence[str], inclusive: bool = False, order: Sequence[str] = ()
) -> DataFrame:
    """left with `take` from the latest right row of the same key before left_on (or at it, if inclusive).

    Both sides are united and one window carries the last right row forward: one shuffle by key, no range join.
    order: right columns that decide between rows of one time, the last one wins.
    """
    value = F.struct(*[F.col(c).alias(c) for c in take])
    key = [F.col(c) for c in by]
    kept = F.struct(*[F.col(c) for c in left.columns])
    side = F.lit(1 if inclusive else -1)
    rank = [F.col(c) for c in order]
    probes = left.select(*key, F.col(left_on).alias("__t"), side.alias("__side"), *[F.lit(None).alias(f"__o{i}") for i in range(len(order))], F.lit(None).alias("__v"), kept.alias("__row"))
    facts = right.select(*key, F.col(right_on).alias("__t"), F.lit(0).alias("__side"), *[c.alias(f"__o{i}") for i, c in enumerate(rank)], value.alias("__v"), F.lit(None).alias("__row"))
    both = facts.unionByName(probes)
    w = Window.partitionBy(*by).orderBy("__t", "__side", *[F.col(f"__o{i}").asc_nulls_first() for i in range(len(order))]).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("__last", F.last("__v", ignorenulls=True).over(w)).filter(F.col("__row").isNotNull())
    return out.select("__row.*", *[F.col("__last")[c].alias(c) for c in take])


def day_buckets(rows: DataFrame, keys: Sequence[str], day: str, sums: dict[str, Column]) -> DataFrame:
    """One row for each key and day with the named sums: what all windows of day resolution need."""
    return rows.groupBy(*keys, day).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def window_sums(buckets: DataFrame, keys: Sequence[str], day: str, names: Sequence[str], days: int | None, form: str = "frame") -> DataFrame:
    """buckets with sums of the `days` days before (None: all earlier days), the day itself left out.

    form: frame or prefix; both give the same values.
    """
    every = Window.partitionBy(*keys).orderBy(day)
    if form == "frame" or days is None:
        w = every.rangeBetween(Window.unboundedPreceding if days is None else -days, -1)
        return buckets.select("*", *[F.sum(n).over(w).alias(f"{n}_before") for n in names])
    upto = every.rowsBetween(Window.unboundedPreceding, 0)
    running = buckets.select(*keys, F.col(day).alias("at"), *[F.sum(n).over(upto).alias(f"{n}_run") for n in names])
    runs = [f"{n}_run" for n in names]
    here = asof_join(buckets, running, by=keys, left_on=day, right_on="at", take=runs)
    here = here.select(*buckets.columns, *[F.col(r).alias(f"{r}_hi") for r in runs], (F.col(day) - days).alias("__from"))
    low = asof_join(here, running, by=keys, left_on="__from", right_on="at", take=runs)
    some = F.col(f"{runs[0]}_hi").isNotNull()
    diff = lambda n: F.col(f"{n}_run_hi") - F.coalesce(F.col(f"{n}_run"), F.lit(0))
    return low.select(*buckets.columns, *[F.when(some, diff(n)).alias(f"{n}_before") for n in names])


def band_join(left: DataFrame, right: DataFrame, *, by: Sequence[str], left_on: str, right_on: str, days: int) -> DataFrame:
    """All right rows of the key in [left_on - days, left_on), by cells of `days` days: an equi join and a filter."""
    cell = lambda c: F.floor(c / days)
    cells = F.explode(F.array(cell(F.col(left_on)), cell(F.col(left_on)) - 1))
    probe = left.withColumn("__cell", cells)
    near = probe.join(right.withColumn("__cell", cell(F.col(right_on))), [*by, "__cell"])
    return near.filter((F.col(right_on) < F.col(left_on)) & (F.col(right_on) >= F.col(left_on) - days)).drop("__cell")


def around(rows: DataFrame, points: DataFrame, *, by: Sequence[str], key: Sequence[str], at: str, value: str, before: int, after: int) -> DataFrame:
    """key, n, total: count and sum of the points' values in [at - before, at + after] of each row, without pairs.

    Times are whole numbers. A key's time line is cut into cells as long as the window; a point goes to the one or two
    cells whose rows reach it. There the points are summed in order, and a row is the running sum at its end less that at
    its start. Points without a value or a time are left out; rows without points have 0 and null, and so have rows with
    a null in `by` or `at`. Sums are exact decimals; key must tell rows apart.
    """
    width = before + after
    t, names = F.col(at).cast("long"), [f"__by{i}" for i in range(len(by))]
    ids = [f"__key{i}" for i in range(len(key))]
    groups = [F.col(c).alias(n) for c, n in zip(by, names, strict=True)]
    ends = F.inline(F.array(*[F.struct(p.alias("pos"), F.lit(k).alias("kind"), F.lit(s).alias("sign")) for p, k, s in ((t - before, 0, -1), (t + after, 2, 1))]))
    asked = rows.select(*groups, *[F.col(c).alias(n) for c, n in zip(key, ids, strict=True)], F.floor(t / width).alias("cell"), ends)
    cells = F.array_distinct(F.array(F.floor((t - after) / width), F.floor((t + before) / width)))
    v = F.col(value).cast("decimal(28,6)")
    known = points.filter(F.col(value).isNotNull() & F.col(at).isNotNull()).select(*groups, F.explode(cells).alias("cell"), t.alias("pos"), F.lit(1).alias("kind"), v.alias("v"))
    both = asked.unionByName(known, allowMissingColumns=True)
    w = Window.partitionBy(*names, "cell").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    run = both.select("*", F.count("v").over(w).alias("upto"), F.sum("v").over(w).alias("sum")).filter("kind <> 1")
    usable = F.col("pos").isNotNull()
    for n in names:
        usable = usable & F.col(n).isNotNull()
    part = lambda c: F.sum(F.when(usable, F.col("sign") * F.coalesce(c, F.lit(0))))
    out = run.groupBy(*ids).agg(F.coalesce(part("upto"), F.lit(0)).cast("long").alias("n"), part("sum").alias("total"))
    return out.select(*[F.col(n).alias(c) for c, n in zip(key, ids, strict=True)], "n", F.when(F.col("n") > 0, F.col("total")).alias("total"))


def last_before(rows: DataFrame, by: Sequence[str], day: str, order: Sequence[str], cols: Sequence[str], k: int) -> DataFrame:
    """by, day, last: the k newest rows strictly before each day of the key, newest first, as structs of day, order and cols.

    Each day keeps its k newest rows, and a day looks back over k days, so that no list grows with a key's past.
    """
    item = F.struct(day, *order, *cols)
    newest = Window.partitionBy(*by, day).orderBy(*[F.desc(c) for c in order])
    top = rows.withColumn("__k", F.row_number().over(newest)).filter(F.col("__k") <= k)
    days = top.groupBy(*by, day).agg(F.collect_list(item).alias("__day"))
    back = Window.partitionBy(*by).orderBy(day).rowsBetween(-k, -1)
    all_ = F.flatten(F.collect_list("__day").over(back))
    return days.select(*by, day, F.slice(F.reverse(F.array_sort(all_)), 1, k).alias("last"))


def overlap_counts(spans: DataFrame, by: Sequence[str], key: str, start: str, end: str) -> DataFrame:
    """key, n: other closed intervals of the group that overlap each one, by two running counts instead of pairs."""
    point = lambda t, kind: spans.select(*by, F.col(key).alias("id"), F.col(t).alias("t"), F.lit(kind).alias("kind"))
    w = Window.partitionBy(*by).orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    # At one time births (0) come before the question of how many were born (1), and that before ends (3); the
    # question of how many have ended (2) comes before ends of its own time.
    points = point(start, 0).unionByName(point(end, 1)).unionByName(point(start, 2)).unionByName(point(end, 3))
    seen = points.select("id", "kind", F.count_if(F.col("kind") == 0).over(w).alias("born"), F.count_if(F.col("kind") == 3).over(w).alias("over"))
    asked = seen.filter("kind IN (1, 2)").groupBy("id").agg(F.sum(F.when(F.col("kind") == 1, F.col("born")).otherwise(-F.col("over"))).alias("n"))
    return asked.select(F.col("id").alias(key), (F.col("n") - 1).alias("n"))


def rate(hits: Column, n: Column, digits: int = 6) -> Column:
    """hits / n, null where n is 0 or null."""
    return F.round(F.try_divide(hits, n), digits)


def null_safe(rows: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join by columns that both tables have, where nulls meet; rows' columns come first. how: inner, left, left_anti."""
    marks = [f"__on{i}" for i in range(len(on))]
    right = other.select(*[F.col(c).alias(m) for c, m in zip(on, marks, strict=True)], *[c for c in other.columns if c not in on])
    same = F.lit(True)
    for c, m in zip(on, marks, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(m))
    return rows.join(right, same, how).drop(*marks)
