"""Nearest neighbours along one sorted key: range partitions, each with the few halo rows of its neighbours that matter."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .baseline import written

#: Rows of a range partition, about.
CELL_ROWS = 1_000_000


def nearest_other(rows: DataFrame, *, key: str, group: str, ids: Sequence[str], pick: str, carry: Sequence[str] = (), seed: int = 7, cell_rows: int = CELL_ROWS) -> DataFrame:
    """group, ids and carry of each pick, and s_key, s_group, s_ids, s_carry (s_ before the columns' own names) of its
    surrogate: the row that is no pick, has another group and whose key is nearest, of two at one distance the lower one.

    Equal keys are in the order of a seeded hash of group and ids, then of these. Rows without a key or group take no
    part; picks without any such row have nulls; repeated rows are rows. A surrogate may serve several picks.

    Rows are sorted by range once, in cells of about `cell_rows`; a task looks both ways in its own and gives out its picks
    and four free rows: the first and the last one, and those nearest to them of another group. Of all other cells a pick
    needs no more than these, so nothing but picks is written.
    """
    names = [group, *ids, *carry]
    marks = ["g", *[f"i{k}" for k in range(len(ids))], *[f"c{k}" for k in range(len(carry))]]
    marked = rows.select(F.col(key).cast("double").alias("key"), *[F.col(c).alias(m) for c, m in zip(names, marks, strict=True)], F.coalesce(F.col(pick), F.lit(False)).alias("pick")).filter("key IS NOT NULL AND NOT isnan(key) AND g IS NOT NULL")
    told = marks[: 1 + len(ids)]
    marked = marked.withColumn("h", F.unhex(F.md5(F.concat_ws(":", F.lit(seed), *[F.col(m).cast("string") for m in told]).cast("binary"))))
    order, shown = ["key", "h", *told], ["key", *marks]
    cells = max(1, -(-rows.count() // cell_rows))
    dealt = marked.repartitionByRange(cells, *order).sortWithinPartitions(*order).select("pick", F.spark_partition_id().alias("cell"), *shown)
    sides = ("low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        cell = pa.Table.from_batches(held).combine_chunks()
        chosen = cell.column("pick").to_numpy()
        of = cell.column("g").combine_chunks().dictionary_encode().indices.to_numpy()
        low, high = _before(chosen, of), len(of) - 1 - _before(chosen[::-1], of[::-1])[::-1]
        at = np.flatnonzero(chosen)
        free = np.flatnonzero(~chosen)
        edges = []
        for edge, ends in (("a", free), ("z", free[::-1])):
            other = ends[of[ends] != of[ends[0]]] if len(ends) else ends
            edges += [(e, int(x[0])) for e, x in ((edge, ends), (f"{edge}2", other)) if len(x)]
        own = cell.take(pa.array(np.r_[at, np.array([i for _, i in edges], int)]))
        none = [None] * len(edges)
        out = [pa.array([None] * len(at) + [e for e, _ in edges], pa.string()), *(own.column(c) for c in ("cell", *shown))]
        for side in (low[at], high[at]):
            inside = (side >= 0) & (side < len(of))
            there = pa.array([int(i) if ok else None for i, ok in zip(side, inside, strict=True)] + none, pa.int64())
            out += [cell.column(c).take(there) for c in shown]
        yield from pa.Table.from_arrays(out, ["edge", "cell", *shown, *[f"{s}_{c}" for s in sides for c in shown]]).combine_chunks().to_batches(max_chunksize=10_000)

    kinds = {c: dealt.schema[c].dataType.simpleString() for c in shown}
    schema = ", ".join(["edge string", "cell int", *[f"{c} {t}" for c, t in kinds.items()], *[f"{s}_{c} {t}" for s in sides for c, t in kinds.items()]])
    found = written(dealt.mapInArrow(run, schema), "picks")
    one = lambda side: F.when(F.col(f"{side}_g").isNotNull(), F.struct(*[F.col(f"{side}_{c}").alias(c) for c in shown]))
    out = found.filter("edge IS NULL").join(F.broadcast(_halo(found, shown, cells)), "cell", "left")
    for side in sides:
        near = F.when(F.col(f"{side}1.g") != F.col("g"), F.col(f"{side}1")).otherwise(F.col(f"{side}2"))
        out = out.withColumn(side, F.coalesce(one(side), near))
    below = F.col("low").isNotNull() & (F.col("high").isNull() | (F.col("key") - F.col("low.key") <= F.col("high.key") - F.col("key")))
    out = out.withColumn("s", F.when(below, F.col("low")).otherwise(F.col("high")))
    return out.select(
        *[F.col(m).alias(c) for m, c in zip(marks, names, strict=True)], F.col("key").alias(key), F.col("s.key").alias(f"s_{key}"), *[F.col(f"s.{m}").alias(f"s_{c}") for m, c in zip(marks, names, strict=True)]
    )


def _before(chosen: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each row the place of the nearest row before it that is not chosen and of another group, or -1."""
    place = np.arange(len(of))
    free = np.maximum.accumulate(np.where(chosen, -1, place))
    near = np.r_[-1, free[:-1]]
    # Where the free rows' group changes, the row before is the nearest of another group until the next change.
    change = ~chosen & (near >= 0) & (of[near] != of)
    far = np.maximum.accumulate(np.where(change, near, -1))
    return np.where((near >= 0) & (of[near] != of), near, far)


def _halo(found: DataFrame, shown: Sequence[str], cells: int) -> DataFrame:
    """For each cell the free rows of other cells that its picks need: two before it and two behind it, of two groups."""
    row = F.struct(*shown)
    ends: dict[int, dict] = {}
    edges = found.filter("edge IS NOT NULL").select("cell", "edge", row.alias("row"))
    for r in edges.collect():  # four rows a cell
        ends.setdefault(r["cell"], {})[r["edge"]] = r["row"]
    sides = []
    for ways, last in ((range(cells), "z"), (range(cells - 1, -1, -1), "a")):
        held, of = [], {}  # the nearest free row passed, and the nearest of another group
        for cell in ways:
            of[cell] = [*held, None, None][:2]
            if r := ends.get(cell):
                second = [r[f"{last}2"]] if f"{last}2" in r else [x for x in held if x["g"] != r[last]["g"]][:1]
                held = [r[last], *second]
        sides.append(of)
    kind = edges.schema["row"].dataType.simpleString()
    return found.sparkSession.createDataFrame([(c, *sides[0][c], *sides[1][c]) for c in range(cells)], f"cell int, low1 {kind}, low2 {kind}, high1 {kind}, high2 {kind}")
