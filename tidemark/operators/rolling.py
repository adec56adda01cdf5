"""Order statistics of a moving window of days, without joining rows to their windows.

The time line of a key with more than `small` different facts is cut into blocks as long as the window. Each fact goes to its
own block and to the next one, each probe to its own, so that a block holds all that its probes' windows reach, at most twice
the facts in all, and a key with many rows is split by time. Equal values of a key and day are one row with their number from
the start, so that what is moved, sorted and held grows with the different values of a day and not with its rows.

Within a block rows come in the order of days. A window is a run of them, and many windows are answered at once: places of
values are halved bit by bit, and counts of each half up to each row tell how many of a run lie in it (`by_rank`, `below`), in
some 20 steps of whole arrays for all probes instead of a step for each value that comes or goes. For a mode one sorted list
is kept up to date.

A block of more than `small` such rows is split by value too. Its cells lie between approximate quantiles of its own facts, and
each of these is a cell by itself, so that a value that repeats without end is counted, not held. Counts by day and cell,
summed over the window, tell for each day the facts of a cell and of all cells below it; sorted lists then answer for one
cell each: the value of a rank in the cell, the place of a value in it, or its most frequent value.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from ..sources.io import written
from .asof import null_safe

#: Rows that are answered at once, unless a window alone holds more facts.
CHUNK = 200_000
#: Cells of a hot block at most, not counting the quantiles between them: a list holds 1 / MOST_CELLS of its facts.
MOST_CELLS = 4096
#: More values of a day than this are merged into the window's list at once.
_MANY = 64
#: More values than this are held in an array: a day's come and go by copies of memory, not value by value.
_LARGE = 2048


class Window:
    """The values of a moving window, sorted, each once with how often it is held."""

    def __init__(self, days: int):
        self.days, self.n, self.held, self.kinds, self.times, self.sums = days, 0, deque(), [], [], None

    @property
    def values(self) -> list | np.ndarray:
        """All values, repeated as they are held."""
        if isinstance(self.kinds, np.ndarray):
            return np.repeat(self.kinds, self.times)
        return [v for v, c in zip(self.kinds, self.times, strict=True) for _ in range(c)]

    def add(self, day: int, values: Sequence, times: Sequence | None = None) -> None:
        """times: how often each value is there, else once."""
        times = [1] * len(values) if times is None else times
        self.held.append((day, values, times))
        self.n, self.sums = self.n + sum(times), None
        if self.n > _LARGE:
            self._merge(values, times)
            return
        if isinstance(self.kinds, np.ndarray):
            self.kinds, self.times = self.kinds.tolist(), self.times.tolist()
        if len(values) > _MANY:
            count = dict(zip(self.kinds, self.times, strict=True))
            for v, c in zip(values, times, strict=True):
                count[v] = count.get(v, 0) + c
            self.kinds = sorted(count)
            self.times = [count[v] for v in self.kinds]
            return
        for v, c in zip(values, times, strict=True):
            at = bisect_left(self.kinds, v)
            if at < len(self.kinds) and self.kinds[at] == v:
                self.times[at] += c
            else:
                self.kinds.insert(at, v)
                self.times.insert(at, c)

    def _merge(self, values: Sequence, times: Sequence) -> None:
        kinds, held = np.asarray(self.kinds, float), np.asarray(self.times, np.int64)
        new, of = np.unique(np.asarray(values, float), return_inverse=True)
        count = np.zeros(len(new), np.int64)
        np.add.at(count, of, times)
        at = np.searchsorted(kinds, new)
        known = np.zeros(len(new), bool)
        inside = at < len(kinds)
        known[inside] = kinds[at[inside]] == new[inside]
        held[at[known]] += count[known]
        self.kinds, self.times = np.insert(kinds, at[~known], new[~known]), np.insert(held, at[~known], count[~known])

    def move(self, day: int) -> None:
        """Forgets what lies more than `days` days before day."""
        values, times = [], []
        while self.held and self.held[0][0] < day - self.days:
            _, v, c = self.held.popleft()
            values += v
            times += c
        if not values:
            return
        self.n, self.sums = self.n - sum(times), None
        if isinstance(self.kinds, np.ndarray):
            np.subtract.at(self.times, np.searchsorted(self.kinds, np.asarray(values, float)), times)
            left = self.times > 0
            self.kinds, self.times = self.kinds[left], self.times[left]
            return
        for v, c in zip(values, times, strict=True):
            self.times[bisect_left(self.kinds, v)] -= c
        if 0 in self.times:
            left = [i for i, c in enumerate(self.times) if c]
            self.kinds, self.times = [self.kinds[i] for i in left], [self.times[i] for i in left]

    def _upto(self) -> list | np.ndarray:
        """For each kind the number of values up to it, itself included."""
        if self.sums is None:
            self.sums = np.cumsum(self.times) if isinstance(self.times, np.ndarray) else list(accumulate(self.times))
        return self.sums

    def ranked(self, rank: int) -> float:
        """The value of a rank, from 0."""
        return float(self.kinds[bisect_right(self._upto(), rank)])

    def median(self) -> float | None:
        return (self.ranked((self.n - 1) // 2) + self.ranked(self.n // 2)) / 2 if self.n else None

    def share_below(self, v: float | None) -> float | None:
        """Share of the values that are smaller, ties counting half."""
        return None if v is None or not self.n else self.place(v) / self.n

    def place(self, v: float) -> float:
        """Number of the values that are smaller, ties counting half."""
        below, upto = (int(self._upto()[at - 1]) if at else 0 for at in (bisect_left(self.kinds, v), bisect_right(self.kinds, v)))
        return (below + upto) / 2

    def mode(self) -> tuple[float | None, int]:
        """The most frequent value, of equally frequent ones the smallest, and how often it is there."""
        if not self.n:
            return None, 0
        most = max(self.times)
        return float(self.kinds[int(np.argmax(self.times))]), int(most)


STATS = {"median", "share_below", "mode", "place", "ranked"}


def _halves(codes: np.ndarray, times: np.ndarray | None, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each bit from the highest one, rows being stably sorted by the bits above it: the bit, and how many rows have no
    such bit and how often they are there, up to each row. times: None if each is there once."""
    for bit in reversed(range(bits)):
        one = (codes >> bit & 1).astype(bool)
        zero = ~one
        zeros = np.r_[0, np.cumsum(zero)]
        yield bit, zeros, zeros if times is None else np.r_[0, np.cumsum(np.where(zero, times, 0))]
        codes = np.concatenate([codes[zero], codes[one]])
        times = None if times is None else np.concatenate([times[zero], times[one]])


def _into(lo: np.ndarray, hi: np.ndarray, up: np.ndarray, zeros: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs lie among the rows with the bit, if up, else without it."""
    return tuple(np.where(up, zeros[-1] + at - zeros[at], zeros[at]) for at in (lo, hi))


def by_rank(codes: np.ndarray, times: np.ndarray | None, bits: int, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each run of rows lo to hi the code of a rank, from 0, each row counting times."""
    found = np.zeros(len(lo), np.int64)
    for bit, zeros, held in _halves(codes, times, bits):
        here = held[hi] - held[lo]
        up = rank >= here
        rank = np.where(up, rank - here, rank)
        found |= up.astype(np.int64) << bit
        lo, hi = _into(lo, hi, up, zeros)
    return found


def below(codes: np.ndarray, times: np.ndarray | None, bits: int, lo: np.ndarray, hi: np.ndarray, code: np.ndarray) -> np.ndarray:
    """For each run of rows lo to hi how many have a smaller code, each row counting times; bits hold code too."""
    total = np.zeros(len(lo), np.int64)
    for bit, zeros, held in _halves(codes, times, bits):
        up = (code >> bit) & 1 == 1
        total += np.where(up, held[hi] - held[lo], 0)
        lo, hi = _into(lo, hi, up, zeros)
    return total


def answered(stat: str, days: int, facts: Sequence[np.ndarray], probes: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How many facts the probes' windows hold, and the statistic, NaN for none. facts: group, day, value and times; probes:
    group, day and value; both sorted by group and day, groups being numbers from 0 in that order."""
    group, day, value, times = facts
    g, d, own = probes
    if not len(group) or not len(g):
        return np.zeros(len(g), np.int64), np.full(len(g), np.nan)
    first = min(day.min(), d.min() - days)
    span = int(max(day.max(), d.max()) - first) + 1
    at = group * span + (day - first)
    lo, hi = np.searchsorted(at, g * span + (d - days - first)), np.searchsorted(at, g * span + (d - first))
    upto = np.r_[0, np.cumsum(times)]
    n = upto[hi] - upto[lo]
    # A row's code is its place among its group's values.
    kinds, dense = np.unique(value, return_inverse=True)
    place = group * (len(kinds) + 1) + dense
    order = np.argsort(place, kind="stable")
    starts = np.searchsorted(group, np.arange(max(group[-1], g[-1]) + 2))
    codes = np.empty(len(group), np.int64)
    codes[order] = np.arange(len(group)) - starts[group[order]]
    bits = int(np.diff(starts).max()).bit_length()
    times = None if len(times) == upto[-1] and times.min() == 1 else times
    out, ask = np.full(len(g), np.nan), n > 0
    if stat in ("median", "ranked"):
        ask &= ~np.isnan(own) if stat == "ranked" else True
        of = lambda who, rank: value[order][starts[g[who]] + by_rank(codes, times, bits, lo[who], hi[who], rank)]
        who = np.flatnonzero(ask)
        if stat == "ranked":
            out[who] = of(who, own[who].astype(np.int64))
        else:
            low = of(who, (n[who] - 1) // 2)
            high, even = low.copy(), n[who] % 2 == 0
            high[even] = of(who[even], n[who[even]] // 2)
            out[who] = (low + high) / 2
        return n, out
    who = np.flatnonzero(ask & ~np.isnan(own))
    runs, base = (codes, times, bits, lo[who], hi[who]), g[who] * (len(kinds) + 1)
    edges = [np.searchsorted(place[order], base + np.searchsorted(kinds, own[who], side)) - starts[g[who]] for side in ("left", "right")]
    out[who] = sum(below(*runs, e) for e in edges) / 2
    return n, out / np.maximum(n, 1) if stat == "share_below" else out


def rolling(
    probes: DataFrame, facts: DataFrame, *, by: Sequence[str], day: str, value: str, days: int, stat: str = "median", at: str | None = None,
    times: str | None = None, counted: bool = False, small: int = 1_000_000, cell_rows: int = 250_000,
) -> DataFrame:
    """probes with window_n long and window double: the statistic of the facts of the key in [day - days, day - 1].

    stat: median, share_below (of the probe's own `value`) or mode (of numbers). at: the facts' day column, if it has
    another name. Facts without a value (null or NaN) are left out, a probe's NaN is a null; a window without facts has
    window_n 0 and a null. Keys of more than `small` different facts are cut into blocks, blocks of more into cells of about
    `cell_rows` of them. counted: facts are written, and there are no two of a key, day and value.
    """
    names = probes.columns
    marks, keys = [f"p{i}" for i in range(len(names))], [f"k{i}" for i in range(len(by))]
    named = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]
    real = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("v")
    own = real(value) if value in names else F.lit(None).cast("double").alias("v")
    block, on = F.floor(F.col("d") / days), [*keys, "block"]
    asked = probes.select(*named, F.col(day).cast("long").alias("d"), own, *[F.col(c).alias(m) for c, m in zip(names, marks, strict=True)])
    many = F.col(times).cast("long") if times else F.lit(1).cast("long")
    known = facts.select(*named, F.col(at or day).cast("long").alias("d"), real(value), many.alias("c")).filter("v IS NOT NULL")
    if not counted:
        known = written(known.groupBy(*keys, "d", "v").agg(F.sum("c").alias("c")), "facts")
    large = written(known.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > small).select(*keys, F.lit(True).alias("cut")), "large")
    if not large.limit(1).count():
        whole = F.lit(0).cast("long").alias("block")
        out = _answers(asked.select("*", whole), known.select("*", whole), on, marks, days, stat)
        return out.select(*[F.col(m).alias(c) for m, c in zip(marks, names, strict=True)], "window_n", "window")
    asked, known = (null_safe(x, large, keys, "left").withColumn("block", F.when(F.col("cut"), block).otherwise(F.lit(0))) for x in (asked, known))
    asked = asked.drop("cut")
    both = F.explode(F.when(F.col("cut"), F.array("block", F.col("block") + 1)).otherwise(F.array("block"))).alias("block")
    sizes = known.groupBy(*on, "cut").agg(F.count("*").alias("n")).filter("cut").select(*keys, F.explode(F.array("block", F.col("block") + 1)).alias("block"), "n")
    hot = written(sizes.groupBy(*on).agg(F.sum("n").alias("n")).filter(F.col("n") > small), "hot")
    known = known.select(*keys, both, "d", "v", "c")
    if not hot.limit(1).count():
        out = _answers(asked, known, on, marks, days, stat)
    else:
        rest = _answers(null_safe(asked, hot, on, "left_anti"), null_safe(known, hot, on, "left_anti"), on, marks, days, stat)
        split = _by_value(null_safe(asked, hot.select(*on), on), null_safe(known, hot, on), on, marks, days, stat, cell_rows)
        out = rest.select(*marks, "window_n", "window").unionByName(split)
    return out.select(*[F.col(m).alias(c) for m, c in zip(marks, names, strict=True)], "window_n", "window")


def _cuts_up_to(v: Column) -> Column:
    """How many of the sorted `cuts` are no larger than v, by halving."""
    steps = [MOST_CELLS >> i for i in range(1, MOST_CELLS.bit_length())]
    further = lambda at, k: (at + k <= F.size("cuts")) & (F.try_element_at("cuts", at + k) <= v)
    return F.aggregate(F.array(*[F.lit(k) for k in steps]), F.lit(0), lambda at, k: F.when(further(at, k), at + k).otherwise(at))


def _by_value(asked: DataFrame, known: DataFrame, on: list[str], marks: list[str], days: int, stat: str, cell_rows: int) -> DataFrame:
    """The answers of hot blocks; known has n, the rows of its block."""
    shares = [i / MOST_CELLS for i in range(1, MOST_CELLS)]
    found = known.groupBy(*on).agg(F.percentile_approx("v", shares, 4 * MOST_CELLS).alias("all"), F.first("n").alias("n"))
    found = found.withColumn("step", F.greatest(F.lit(1), F.floor(F.lit(float(MOST_CELLS)) * cell_rows / F.col("n"))))
    cuts = written(found.select(*on, F.array_distinct(F.filter("all", lambda _, i: i % F.col("step") == 0)).alias("cuts")), "cuts")
    day, cell, place = [*on, "d"], [*on, "cell"], [*on, "d", "cell"]

    def placed(df: DataFrame) -> DataFrame:
        """df with cell: 2 i + 1 for the cut i itself (from 0), 2 i for values between the cuts i - 1 and i."""
        at = null_safe(df, cuts, on).withColumn("upto", _cuts_up_to(F.col("v")))
        exact = F.try_element_at("cuts", F.col("upto")) == F.col("v")
        number = F.when((F.col("upto") > 0) & exact, 2 * F.col("upto") - 1).otherwise(2 * F.col("upto"))
        return at.withColumn("cell", F.when(F.col("v").isNotNull(), number)).drop("upto", "cuts")

    facts = written(placed(known.drop("n")), "cells")
    lists = facts.filter("cell % 2 = 0")
    daily = facts.groupBy(*place).agg(F.sum("c").alias("c"))
    empty = null_safe(asked.select(*day).distinct(), cuts.select(*on, F.explode(F.sequence(F.lit(0), 2 * F.size("cuts"))).alias("cell")), on)
    # Days asked for come in as rows without facts; a frame ends the day before, so a day's own facts don't count.
    rows = daily.withColumn("asked", F.lit(False)).unionByName(empty.select(*place, F.lit(0).cast("long").alias("c"), F.lit(True).alias("asked")))
    inside = F.coalesce(F.sum("c").over(Over.partitionBy(*cell).orderBy("d").rangeBetween(-days, -1)), F.lit(0).cast("long"))
    counts = rows.withColumn("inside", inside).filter("asked").select(*place, "inside")
    of_day = Over.partitionBy(*day)
    counts = written(counts.withColumn("under", F.sum("inside").over(of_day.orderBy("cell")) - F.col("inside")).withColumn("total", F.sum("inside").over(of_day)), "counts")
    totals = counts.filter("cell = 0").select(*day, F.col("total").alias("window_n"))

    if stat == "share_below":
        mine = placed(null_safe(asked, totals, day))
        mine = null_safe(mine, counts.select(*place, "inside", "under"), place, "left").select(*cell, "d", "v", *marks, "window_n", "inside", "under")
        single = mine.filter("cell IS NULL OR cell % 2 = 1").select(*marks, F.col("window_n").alias("n"), (F.col("under") + F.col("inside") / 2).alias("place"))
        inner = _answers(mine.filter("cell % 2 = 0").withColumnRenamed("window_n", "n"), lists, cell, [*marks, "n", "under"], days, "place")
        every = single.unionByName(inner.select(*marks, "n", (F.col("under") + F.col("window")).alias("place")))
        return every.select(*marks, F.col("n").alias("window_n"), F.try_divide("place", "n").alias("window"))

    shown = [f"o{i}" for i in range(len(day))]
    back = [F.col(o).alias(c) for c, o in zip(day, shown, strict=True)]
    known_cut = null_safe(counts.filter("inside > 0"), cuts, on).withColumn("cut", F.try_element_at("cuts", F.floor((F.col("cell") + 1) / 2).cast("int"))).drop("cuts")
    known_cut = known_cut.select("*", *[F.col(c).alias(o) for c, o in zip(day, shown, strict=True)])
    if stat == "median":
        middle = F.explode(F.array(F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)))
        some = known_cut.withColumn("rank", middle).filter("rank >= under AND rank < under + inside").withColumn("v", (F.col("rank") - F.col("under")).cast("double"))
        inner = _answers(some.filter("cell % 2 = 0"), lists, cell, shown, days, "ranked").select(*back, "window")
        values = some.filter("cell % 2 = 1").select(*day, F.col("cut").alias("window")).unionByName(inner)
        best = values.groupBy(*day).agg((F.sum("window") / 2).alias("window"))
    else:
        some = known_cut.withColumn("v", F.lit(None).cast("double"))
        inner = _answers(some.filter("cell % 2 = 0"), lists, cell, shown, days, "mode").select(*back, "window", "repeats")
        values = some.filter("cell % 2 = 1").select(*day, F.col("cut").alias("window"), F.col("inside").alias("repeats")).unionByName(inner)
        best = values.groupBy(*day).agg(F.min_by("window", F.struct(-F.col("repeats"), F.col("window"))).alias("window"))
    return null_safe(null_safe(asked, totals, day), best, day, "left").select(*marks, "window_n", "window")


def _answers(asked: DataFrame, known: DataFrame, keys: list[str], marks: list[str], days: int, stat: str) -> DataFrame:
    """marks of asked with window_n, window and, for a mode, repeats; both tables have the keys, d and v, known has c, how
    often v is there."""
    blank = [F.lit(None).cast(asked.schema[m].dataType).alias(m) for m in marks]
    rows = asked.select(*keys, "d", F.lit(0).alias("side"), "v", F.lit(0).cast("long").alias("c"), *marks).unionByName(known.select(*keys, "d", F.lit(1).alias("side"), "v", "c", *blank))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, *keys).sortWithinPartitions(*keys, "d", "side")
    assert stat in STATS, stat
    twin = stat == "mode"

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows wait until there are CHUNK of them, and as many as facts are held for the windows that go on."""
        facts, probes, shown, last, number, waiting, held = [], [], [], None, 0, 0, 0

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal facts, probes, shown, number, waiting, held
            known, wanted = ([np.concatenate(x) for x in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * k for rows, k in ((facts, 4), (probes, 3)))
            n, found = answered(stat, days, known, wanted)
            start = 0
            for columns in shown:
                stop = start + len(columns[0])
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n[start:stop], pa.int64()), pa.array(found[start:stop], pa.float64(), from_pandas=True)], [*marks, "window_n", "window"])
                start = stop
            go_on = (known[0] == number) & (known[1] >= newest - days)
            facts, probes, shown, number, waiting = [[np.zeros(int(go_on.sum()), np.int64), *[x[go_on] for x in known[1:]]]], [], [], 0, 0
            held = len(facts[0][0])

        for batch in batches:
            if not batch.num_rows:
                continue
            places = [batch.column(c) for c in keys]
            codes = [pc.fill_null(c.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False) for c in places]
            new_key = np.zeros(batch.num_rows, bool)
            for code in codes:
                new_key[1:] |= code[1:] != code[:-1]
            new_key[0] = last is not None and tuple(place[0].as_py() for place in places) != last
            last = tuple(place[batch.num_rows - 1].as_py() for place in places)
            group = number + np.cumsum(new_key)
            number, fact = int(group[-1]), batch.column("side").to_numpy() == 1
            d, v, c = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("d", "v", "c"))
            v, newest = v.astype(float), int(d[-1])
            facts.append([x[fact] for x in (group, d, v, c)])
            probes.append([x[~fact] for x in (group, d, v)])
            asking = batch.filter(pa.array(~fact))
            shown.append([asking.column(m) for m in marks])
            waiting += batch.num_rows
            if waiting >= max(CHUNK, held):
                yield from flushed()
        if waiting:
            yield from flushed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, last = Window(days), None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            places = [batch.column(c) for c in keys]
            codes = [pc.fill_null(c.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False) for c in places]
            d, side = batch.column("d").to_numpy(), batch.column("side").to_numpy()
            cut = np.zeros(n - 1, bool)
            for code in (*codes, d, side):
                cut |= code[1:] != code[:-1]
            starts = [0, *(np.flatnonzero(cut) + 1).tolist()]
            v, c = batch.column("v").to_pylist(), batch.column("c").to_pylist()
            counts, found = [], []
            new_key = np.zeros(n, bool)
            for code in codes:
                new_key[1:] |= code[1:] != code[:-1]
            first = tuple(place[0].as_py() for place in places)
            new_key[0] = first != last
            for x, y in zip(starts, [*starts[1:], n], strict=True):
                if new_key[x]:
                    window = Window(days)
                if side[x]:
                    window.add(int(d[x]), v[x:y], c[x:y])
                else:
                    window.move(int(d[x]))
                    counts += [window.n] * (y - x)
                    found += [window.mode()] * (y - x)
            last = tuple(place[n - 1].as_py() for place in places)
            probes_here = batch.filter(pa.array(side == 0))
            kept = [probes_here.column(m) for m in marks]
            modes, repeats = pa.array([m for m, _ in found], pa.float64()), pa.array([r for _, r in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), modes, repeats], [*marks, "window_n", "window", "repeats"])

    fields = "".join(f"{m} {asked.schema[m].dataType.simpleString()}, " for m in marks)
    return rows.mapInArrow(run if twin else at_once, f"{fields}window_n long, window double" + (", repeats long" if twin else ""))
