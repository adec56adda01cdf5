"""Ratings that depend on each other from day to day: every row gets its value as of the day before.

Days are an inherent chain: a day's updates need the ratings that earlier days left. Consecutive days are packed into
blocks of at most BLOCK_ROWS rows, known from one count a day. A block is one bounded task that holds just the entities it
touches and goes over its days with whole-day array operations. All that doesn't wait for the chain is done by all tasks at
once: rows are written once, sorted and packed into a row a day with its columns as bytes, and results stay packed until they
are read, so that the chain's task handles arrays and no rows. A day with more rows than a block may have is spread over all
tasks by event, since all its events use the ratings before it: only sums by entity come together. Which block an entity comes
up in next is known beforehand, so a block writes its entities' state into the folders of these blocks and reads just its own
folder: each state is written once and read once, and nothing is rewritten.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import new_path, written

#: Rows of a block of days at most.
BLOCK_ROWS = 2_000_000
#: Parts of a block that are written by tasks of their own.
PARTS = 8
#: Instead of a block: a row that no later block reads; results.
NONE, RESULT = -1, -2
#: What a packed row holds: a day's rows, a block's entities with their next blocks, entities' state.
DAY, WHO, HELD = 0, 1, 2
#: Cells of a matrix of opponents that are held at a time.
CELLS = 4_000_000


def fields(starts: np.ndarray, sizes: np.ndarray):
    """Indices of events with equal sizes, shape (events, size), a bounded number of cells at a time; single ones left out."""
    for n in np.unique(sizes[sizes > 1]).tolist():
        at = starts[sizes == n]
        step = max(1, CELLS // (n * n))
        for i in range(0, len(at), step):
            yield at[i : i + step, None] + np.arange(n)[None, :]


def opponents(idx: np.ndarray, made):
    """Sums over opponents of made(i, j), arrays of (events, some, size); large fields a few rows at a time."""
    n = idx.shape[1]
    step = max(1, CELLS // (n * len(idx)))
    out = None
    for a in range(0, n, step):
        part = [m.sum(2) for m in made(idx[:, a : a + step, None], idx[:, None, :])]
        out = part if out is None else [np.concatenate([x, y], axis=1) for x, y in zip(out, part, strict=True)]
    return out


class Elo:
    """Pairwise Elo: each opponent of an event moves a rating by k / (n - 1) times outcome less expectation, ties half."""

    state, parts = {"rating": 1500.0}, ["move"]

    def __init__(self, k: float = 32.0):
        self.k = k

    def moves(self, before: dict, rank: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> dict:
        r, move = before["rating"], np.zeros(len(rank))
        for idx in fields(starts, sizes):
            def made(i, j):
                won = (rank[i] < rank[j]) + 0.5 * (rank[i] == rank[j])
                return [np.where(i == j, 0.0, won - 1 / (1 + 10 ** ((r[j] - r[i]) / 400)))]
            move[idx] = self.k * opponents(idx, made)[0] / (idx.shape[1] - 1)
        return {"move": move}

    def grown(self, state: dict, days: np.ndarray) -> dict:
        return state

    def after(self, before: dict, sums: dict) -> dict:
        return {"rating": before["rating"] + sums["move"]}


class Glicko:
    """Glicko by day: deviations grow with the root of the days since the last event up to their start, outcomes are
    graded by the distance of ranks, each opponent weighs weight / (n - 1)."""

    state, parts = {"rating": 1500.0, "dev": 350.0}, ["up", "info"]

    def __init__(self, drift: float = 30.0, per_days: float = 30.0, span: float = 3.0, weight: float = 3.0):
        self.drift, self.per_days, self.span, self.weight, self.q = drift, per_days, span, weight, np.log(10) / 400

    def moves(self, before: dict, rank: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> dict:
        r, g = before["rating"], 1 / np.sqrt(1 + 3 * self.q**2 * before["dev"] ** 2 / np.pi**2)
        up, info = np.zeros(len(rank)), np.zeros(len(rank))
        for idx in fields(starts, sizes):
            def made(i, j):
                e = 1 / (1 + 10 ** (-g[j] * (r[i] - r[j]) / 400))
                graded = 0.5 + np.clip(rank[j] - rank[i], -self.span, self.span) / (2 * self.span)
                other = (i != j).astype(float)
                return [other * g[j] * (graded - e), other * self.q**2 * g[j] ** 2 * e * (1 - e)]
            w = self.weight / (idx.shape[1] - 1)
            a, b = opponents(idx, made)
            up[idx], info[idx] = w * a, w * b
        return {"up": up, "info": info}

    def grown(self, state: dict, days: np.ndarray) -> dict:
        return {**state, "dev": np.minimum(350.0, np.sqrt(state["dev"] ** 2 + self.drift**2 * days / self.per_days))}

    def after(self, before: dict, sums: dict) -> dict:
        low = 1 / (1 / before["dev"] ** 2 + sums["info"])
        return {"rating": before["rating"] + self.q * low * sums["up"], "dev": np.sqrt(low)}


def _events(day: np.ndarray, event: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.r_[True, (day[1:] != day[:-1]) | (event[1:] != event[:-1])]) if len(day) else np.zeros(0, np.int64)
    return starts, np.diff(np.r_[starts, len(day)])


def _columns(t: pa.Table, names: Sequence[str]) -> list[np.ndarray]:
    return [t.column(c).to_numpy() for c in names]


def packed(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """by and each of the columns as the bytes of an array: one row for each run of rows with equal `by`, which are whole
    numbers that rows lie sorted by. A null number is NaN."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def closed() -> pa.RecordBatch:
            blobs = [np.concatenate(x).tobytes() for x in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in at], *[pa.array([x], pa.binary()) for x in blobs]], [*by, *columns])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = ([batch.column(c).to_numpy(zero_copy_only=False) for c in names] for names in (by, columns))
            cut = np.zeros(batch.num_rows - 1, bool)
            for k in keys:
                cut |= k[1:] != k[:-1]
            starts = [0, *(np.flatnonzero(cut) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                key = tuple(int(k[a]) for k in keys)
                if held and key != at:
                    yield closed()
                    held = []
                at = key
                held.append([v[a:b].copy() for v in values])
        if held:
            yield closed()

    return rows.select(*[F.col(c).cast("long").alias(c) for c in by], *columns).mapInArrow(run, ", ".join([f"{c} long" for c in by] + [f"{c} binary" for c in columns]))


def unpacked(rows: DataFrame, blobs: Sequence[tuple[str, Sequence[str], str]], key: str | None = None) -> DataFrame:
    """Rows of packed ones. blobs: (column, names that lie in it one after the other, their type, long or double)."""
    kinds = {"long": (np.int64, pa.int64()), "double": (np.float64, pa.float64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list] = {n: [] for n in out}
            for i in range(batch.num_rows):
                size = 0
                for c, names, kind in blobs:
                    wide = np.frombuffer(batch.column(c)[i].as_buffer(), kinds[kind][0]).reshape(len(names), -1)
                    size = wide.shape[1]
                    for n, x in zip(names, wide, strict=True):
                        parts[n].append(x)
                if key:
                    parts[key].append(np.full(size, batch.column(key)[i].as_py()))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts[n]), kinds[k][1], from_pandas=True) for n, k in out.items()], list(out))

    out = {n: kind for _, names, kind in blobs for n in names} | ({key: "long"} if key else {})
    return rows.select(*([key] if key else []), *[c for c, _, _ in blobs]).mapInArrow(run, ", ".join(f"{n} {k}" for n, k in out.items()))


def wide(blob: pa.Scalar, n: int = 1, kind=np.float64) -> np.ndarray:
    """The n arrays of a blob."""
    return np.frombuffer(blob.as_buffer(), kind).reshape(n, -1)


def slices(blocks: Sequence[tuple[int, int]], counts: dict[int, int], most: int) -> list[tuple[int, int, int]]:
    """(day, block, slice): a block's days in runs of about a PARTS-th of `most` rows, which are written by tasks of their own."""
    out, number, held, last = [], 0, 0, None
    for day, block in blocks:
        if held and (block != last or held >= most / PARTS):
            number, held = number + 1, 0
        held, last = held + counts[day], block
        out.append((day, block, number))
    return out


class Deal:
    """Rows dealt out to blocks of days, each in a folder of its own.

    rows: day, event, entity (whole numbers) and the columns that `schema` names; blocks: (day, block) in the order of days.
    A block of at most `most` rows lies packed by day, its rows in the order of `order`, with the sorted entities and their
    next blocks beside it; of a larger one, which is a single day, the rows stay rows.
    """

    def __init__(self, rows: DataFrame, counts: dict[int, int], blocks: Sequence[tuple[int, int]], most: int, at: str, schema: str, columns: Sequence[str], order: Sequence[str]):
        self.spark, self.at, self.path, self.columns = rows.sparkSession, at, f"{at}-state", list(columns)
        self.sizes: dict[int, int] = {}
        for day, b in blocks:
            self.sizes[b] = self.sizes.get(b, 0) + counts[day]
        self.large = {b for b, n in self.sizes.items() if n > most}
        if not blocks:
            return
        known = slices(blocks, counts, most)
        dealt = rows.join(F.broadcast(self.spark.createDataFrame(known, "day long, block int, slice int")), "day")
        seen = dealt.select("entity", "block").distinct().withColumn("next", F.lead("block", default=NONE).over(Window.partitionBy("entity").orderBy("block")))
        seen = written(seen, "seen")
        self.read_later = {r[0] for r in seen.select("next").distinct().collect()}  # blocks, not entities
        small = ~F.col("block").isin(*self.large) if self.large else F.lit(True)
        limit = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        by_slice = dealt.filter(small).repartition(max(1, min(known[-1][2] + 1, limit)), "slice").sortWithinPartitions("day", *order)
        packed(by_slice, ["block", "day"], columns).write.partitionBy("block").parquet(f"{at}/days")
        by_block = seen.filter(small).repartition(max(1, min(len(self.sizes), limit)), "block").sortWithinPartitions("block", "entity")
        packed(by_block.withColumn("next", F.col("next").cast("long")), ["block"], ["entity", "next"]).write.partitionBy("block").parquet(f"{at}/who")
        if self.large:
            self.rows, _ = dealt_out(dealt.drop("slice").filter(~small), f"{at}/rows", schema, seen)

    def state(self, b: int, schema: str) -> DataFrame:
        """What earlier blocks left for block b."""
        return self.spark.read.schema(schema).parquet(f"{self.path}/next={b}") if b in self.read_later else self.spark.createDataFrame([], schema)

    def all(self, b: int, schema: str, more: DataFrame | None = None) -> DataFrame:
        """Packed rows of block b, and more of them, in one partition: what, key and the blobs that schema names."""
        names = [f.split(" ")[0] for f in schema.split(", ")][2:]

        def named(path: str, what: int, key: str, blobs: Sequence[str]) -> DataFrame:
            df = self.spark.read.schema(", ".join([*([f"{key} long"] if key else []), *[f"{c} binary" for c in blobs]])).parquet(f"{self.at}/{path}/block={b}")
            have = dict(zip(names, blobs, strict=False))
            return df.select(F.lit(what).alias("what"), (F.col(key) if key else F.lit(None).cast("long")).alias("key"), *[F.col(have[n]).alias(n) if n in have else F.lit(None).cast("binary").alias(n) for n in names])

        out = named("days", DAY, "day", self.columns).unionByName(named("who", WHO, "", ["entity", "next"]))
        for other in ([self.state(b, schema)] if b in self.read_later else []) + ([more] if more is not None else []):
            out = out.unionByName(other)
        return out.coalesce(1)

    def left(self, made: DataFrame) -> None:
        """Writes what a block leaves: packed rows with next, the block that reads them, or RESULT."""
        made.write.mode("append").partitionBy("next").parquet(self.path)

    def results(self, schema: str, which: int = RESULT) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/next={which}")


def dealt_out(dealt: DataFrame, at: str, schema: str, seen: DataFrame | None = None):
    """(read, {block: rows}): read(b) is block b of dealt, from its own folder, with next: the next block of its entity, or NONE.
    seen: entity, block and next of all blocks, if there are more of them than in dealt."""
    spark = dealt.sparkSession
    if seen is None:
        seen = dealt.select("entity", "block").distinct().withColumn("next", F.lead("block", default=NONE).over(Window.partitionBy("entity").orderBy("block")))
    rows = dealt.join(seen, ["entity", "block"])
    sizes = {r["block"]: r["count"] for r in dealt.groupBy("block").count().collect()}
    parts = max(1, min(len(sizes) * PARTS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows.repartition(parts, "block", F.pmod(F.xxhash64("event"), F.lit(PARTS))).write.partitionBy("block").parquet(at)
    return lambda b: spark.read.schema(f"{schema}, next int").parquet(f"{at}/block={b}"), sizes


def by_next(following: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(next block, places) of the entities that a later block reads."""
    order = np.argsort(following, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(following[order])) + 1) if len(order) else []:
        if following[part[0]] != NONE:
            yield int(following[part[0]]), part


LEFT = "what int, key long, a binary, b binary, c binary"


def batch_of(rows: Sequence[tuple], schema: str) -> pa.RecordBatch:
    """Packed rows of schema and next."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split(" ") for f in f"{schema}, next int".split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [n for n, _ in fields])


def ratings_by_day(rows: DataFrame, rule: Elo | Glicko, *, day: str, event: str, entity: str, rank: str, block_rows: int | None = None) -> DataFrame:
    """entity, day, and for each part of the rule's state before_x and x: the values before and after each day that an
    entity takes part in.

    rows: one for each participant of an event, of numbers, with the rank in it (equal ranks are ties). Rows without a
    rank, and events of one, move nothing; a row without a rank takes no part.
    """
    most = block_rows or BLOCK_ROWS
    spark, names = rows.sparkSession, list(rule.state)
    alone = F.lit(-(2**62)) + F.monotonically_increasing_id()  # a row without an event is one by itself
    rows = rows.filter(F.col(rank).isNotNull() & F.col(entity).isNotNull() & F.col(day).isNotNull())
    rows = rows.select(F.col(day).cast("long").alias("day"), F.coalesce(F.col(event).cast("long"), alone).alias("event"), F.col(entity).cast("long").alias("entity"), F.col(rank).cast("double").alias("rank"))
    rows = written(rows, "rating-rows")
    blocks: list[tuple[int, int]] = []
    counts, number, held = {}, 0, 0
    for r in rows.groupBy("day").count().orderBy("day").collect():  # one row a day
        if held and held + r["count"] > most:
            number, held = number + 1, 0
        held += r["count"]
        counts[r["day"]] = r["count"]
        blocks.append((r["day"], number))
    columns = ["entity", "event", "rank"]
    deal = Deal(rows, counts, blocks, most, new_path(spark, "ratings"), "day long, event long, entity long, rank double", columns, ["event", "entity"])
    shown = [x for c in names for x in (f"before_{c}", c)]
    result = [("a", ["entity"], "long"), ("b", shown, "double")]

    def left_by(who: np.ndarray, since: np.ndarray, state: dict, following: np.ndarray) -> Iterator[pa.RecordBatch]:
        for b, at in by_next(following):
            yield batch_of([(HELD, 0, who[at].tobytes(), since[at].tobytes(), np.concatenate([state[c][at] for c in names]).tobytes(), b)], LEFT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's days one after the other."""
        days, states, who, following = [], [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for what, key, *blobs in zip(*[batch.column(c) for c in ("what", "key", "a", "b", "c")], strict=True):
                if what.as_py() == DAY:
                    days.append((key.as_py(), blobs))
                elif what.as_py() == WHO:
                    who, following = wide(blobs[0], kind=np.int64)[0], wide(blobs[1], kind=np.int64)[0]
                else:
                    states.append(blobs)
        state = {c: np.full(len(who), v) for c, v in rule.state.items()}
        since = np.full(len(who), np.iinfo(np.int64).min)
        for a, b, c in states:
            at = np.searchsorted(who, wide(a, kind=np.int64)[0])
            since[at] = wide(b, kind=np.int64)[0]
            for n, x in zip(names, wide(c, len(names)), strict=True):
                state[n][at] = x
        for d, (a, b, c) in sorted(days, key=lambda x: x[0]):
            entities, inside = np.unique(wide(a, kind=np.int64)[0], return_inverse=True)
            events, ranks, here = wide(b, kind=np.int64)[0], wide(c)[0], np.searchsorted(who, entities)
            gap = np.where(since[here] == np.iinfo(np.int64).min, 0, d - since[here])
            before = rule.grown({c: state[c][here] for c in names}, gap.astype(float))
            starts, sizes = _events(np.zeros(len(events), bool), events)
            moves = rule.moves({c: v[inside] for c, v in before.items()}, ranks, starts, sizes)
            after = rule.after(before, {c: np.bincount(inside, v, len(here)) for c, v in moves.items()})
            for c in names:
                state[c][here] = after[c]
            since[here] = d
            yield batch_of([(DAY, d, entities.tobytes(), np.concatenate([x for c in names for x in (before[c], after[c])]).tobytes(), None, RESULT)], LEFT)
        yield from left_by(who, since, state, following)

    def contribute(t: pa.Table) -> pa.Table:
        """Moves of some events of one day."""
        t = t.sort_by([("event", "ascending"), ("entity", "ascending")])
        days, events, entities, ranks = _columns(t, ["day", "event", "entity", "rank"])
        starts, sizes = _events(days, events)
        moves = rule.moves({c: t.column(c).to_numpy() for c in names}, ranks, starts, sizes)
        return pa.table([entities, *[moves[c] for c in rule.parts]], names=["entity", *rule.parts])

    def close(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            before, sums = ({c: batch.column(c).to_numpy() for c in cols} for cols in (names, rule.parts))
            after, who, d = rule.after(before, sums), batch.column("entity").to_numpy(), batch.column("day").to_numpy()
            yield batch_of([(DAY, int(d[0]), who.tobytes(), np.concatenate([x for c in names for x in (before[c], after[c])]).tobytes(), None, RESULT)], LEFT)
            yield from left_by(who, d, after, batch.column("next").to_numpy())

    def grow(batches):
        for batch in batches:
            gap = (batch.column("day").to_numpy() - batch.column("since").to_numpy()).astype(float)
            grown = rule.grown({c: batch.column(c).to_numpy() for c in names}, gap)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("day", "event", "entity", "rank", "since", "next")], *[pa.array(grown[c]) for c in names]], ["day", "event", "entity", "rank", "since", "next", *names])

    state_fields = ", ".join(f"{c} double" for c in names)
    for b in sorted(deal.sizes):
        if b not in deal.large:
            deal.left(deal.all(b, LEFT).mapInArrow(run, f"{LEFT}, next int"))
            continue
        # one day: its events are independent of each other
        state = unpacked(deal.state(b, LEFT), [("a", ["entity"], "long"), ("b", ["since"], "long"), ("c", names, "double")])
        now = deal.rows(b).join(state, "entity", "left")
        now = now.select("day", "event", "entity", "rank", F.coalesce("since", "day").alias("since"), "next", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in rule.state.items()])
        now = now.mapInArrow(grow, f"day long, event long, entity long, rank double, since long, next int, {state_fields}")
        parts = F.lit(max(1, deal.sizes[b] * 8 // most))
        moves = now.groupBy(F.pmod(F.xxhash64("event"), parts)).applyInArrow(contribute, "entity long, " + ", ".join(f"{c} double" for c in rule.parts))
        sums = moves.groupBy("entity").agg(*[F.sum(c).alias(c) for c in rule.parts])
        made = now.groupBy("entity").agg(F.first("day").alias("day"), F.first("next").alias("next"), *[F.first(c).alias(c) for c in names]).join(sums, "entity")
        deal.left(made.mapInArrow(close, f"{LEFT}, next int"))
    if not deal.sizes:
        return spark.createDataFrame([], f"entity long, day long, {', '.join(f'{c} double' for c in shown)}")
    out = unpacked(deal.results(LEFT).withColumnRenamed("key", "day"), result, "day")
    return out.select("entity", "day", *shown)
