"""Nearest vectors by inner product: randomly rotated one-bit codes with error bounds, exact scores for what they leave.

After Gao and Long, "RaBitQ: Quantizing High-Dimensional Vectors with a Theoretical Error Bound for Approximate Nearest
Neighbor Search" (2024):

1. CELLS centres are fitted on a sample of SAMPLE_ROWS rows (the only thing that is sampled). Every row belongs to its
   nearest centre c; its residual r = v - c is turned by a seeded random rotation into BITS_PER_DIM signs for each
   dimension. A code is these packed bits with two correction scalars: |r| and s, the inner product of the turned unit
   residual with its signs.
2. A turned query is cut into bit planes of PLANES bits. <q, v> is estimated from population counts of code AND plane:
   <q, c> + |r| * <signs, q'> / s. The signs' part that does not lie along the residual is a random direction, so that
   the error has the deviation |r| |q| sqrt((1 - s^2) / (s^2 (bits - 1))); EPSILON of these and the query's rounding are
   the bound.
3. Rows lie in blocks of one cell and bounded size, with their vectors. A task takes one block of queries and GROUP blocks
   of rows: a query passes over a block whose centre and radius can't reach its k-th score; in the others it takes the
   exact inner product, in double precision, of the 3 k best estimates, and then of just the rows whose upper bound reaches the
   k-th score so far. Each task returns k rows for a query, and one window picks the nearest of all tasks.

So the stated queries meet all rows, in blocks; nothing is capped, and a row is missed only where its error exceeds
EPSILON deviations: about once in thirty thousand rows that belong to a result.

Defined results: rows whose id is null, or whose vector is null, empty, zero or holds null or non-finite components take
no part. Shorter vectors count as ending in zeros. Equal scores are ordered by id. Rows with the query's own id are never
its result; rows that repeat an id are queries and candidates of their own. An empty table gives no rows. Further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import discard, materialise, table

CELLS, SAMPLE_ROWS, SAMPLE_BYTES, LLOYD_ROUNDS = 64, 4096, 32_000_000, 6
#: Rows that a cell has at least on average.
CELL_ROWS = 256
BITS_PER_DIM, PLANES, EPSILON = 4, 6, 4.0
#: Rows of a block of rows and of a block of queries, on average; blocks of rows that a task meets; queries at a time.
BLOCK_ROWS, QUERY_ROWS, GROUP, SLAB = 2048, 1024, 8, 32


def taking_part(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id long, v array<double> of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    return rows.filter(F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Lists of doubles as rows of dim columns; shorter ones end in zeros."""
    ends = vectors.offsets.to_numpy().astype(np.int64)
    sizes, flat = np.diff(ends), vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim).astype(np.float64)
    out = np.zeros((len(sizes), dim))
    at = np.repeat(np.arange(len(sizes)), sizes)
    out[at, np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], sizes)] = flat
    return out


def rotation(dim: int, seed: int = 12) -> np.ndarray:
    """dim orthonormal rows in a space of as many dimensions as a code has bits (a multiple of 64)."""
    bits = -(-max(dim, min(dim * BITS_PER_DIM, 1024)) // 64) * 64
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))[0].T


def centres(sample: np.ndarray, cells: int, seed: int = 12) -> np.ndarray:
    """Lloyd's centres of the sample, from seeded rows of it."""
    found = sample[np.random.default_rng(seed).permutation(len(sample))[:cells]].copy()
    for _ in range(LLOYD_ROUNDS):
        own = nearest_centre(sample, found)
        for c in np.unique(own):
            found[c] = sample[own == c].mean(0)
    return found


def nearest_centre(v: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return ((centre**2).sum(1)[None, :] - 2 * (v @ centre.T)).argmin(1)


def encode(v: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, ...]:
    """(cell, packed bits, |r|, s) of each row."""
    cell = nearest_centre(v, centre)
    r = v - centre[cell]
    length = np.sqrt((r**2).sum(1))
    turned = (r / np.where(length > 0, length, 1)[:, None]) @ turn
    s = np.abs(turned).sum(1) / np.sqrt(turn.shape[1])
    return cell, np.packbits(turned > 0, axis=1, bitorder="little"), length, np.where(s > 0, s, 1.0)


class Queries:
    """A block of queries with their bit planes, and the best of each so far."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, turn: np.ndarray, k: int):
        self.v, self.ids, self.k, self.bits = v, ids, k, turn.shape[1]
        self.length = np.sqrt((v**2).sum(1))
        turned = v @ turn
        self.total = turned.sum(1)
        self.low = turned.min(1)
        self.step = np.maximum((turned.max(1) - self.low) / (2**PLANES - 1), 1e-300)
        cut = np.rint((turned - self.low[:, None]) / self.step[:, None])
        # What rounding can change in <signs, q'>.
        self.rounding = np.abs(turned - self.low[:, None] - cut * self.step[:, None]).sum(1) / np.sqrt(self.bits)
        cut = np.nan_to_num(cut).astype(np.uint8)
        planes = [np.packbits((cut >> j) & 1, axis=1, bitorder="little").view(np.uint64) for j in range(PLANES)]
        self.planes = np.stack(planes, axis=1)
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(v)
        self.kth = np.full(len(v), -np.inf)

    def _signs(self, rows: np.ndarray, code: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """<signs, q'> of the queries and all codes, by population counts."""
        sums = np.zeros((len(rows), len(code)), np.int32)
        for j in range(PLANES):
            for w in range(code.shape[1]):
                sums += np.bitwise_count(code[None, :, w] & self.planes[rows, j, w][:, None]).astype(np.int32) << j
        inside = self.low[rows][:, None] * ones[None, :] + self.step[rows][:, None] * sums
        return (2 * inside - self.total[rows][:, None]) / np.sqrt(self.bits)

    def meet(self, centre: np.ndarray, ids: np.ndarray, v: np.ndarray, code: np.ndarray, length: np.ndarray, s: np.ndarray) -> None:
        """Takes in a block of rows of one cell."""
        base = self.v @ centre
        slack = 1e-9 * self.length * (np.sqrt((centre**2).sum()) + length.max())
        near = np.flatnonzero(~(base + self.length * length.max() + slack < self.kth))
        ones = np.bitwise_count(code).sum(1, dtype=np.int64)
        spread = EPSILON * length * np.sqrt(np.maximum(1 - s**2, 0) / (s**2 * (self.bits - 1)))
        scale = length / s
        for first in range(0, len(near), SLAB):
            at = near[first : first + SLAB]
            middle = base[at][:, None] + scale[None, :] * self._signs(at, code, ones)
            bound = self.length[at][:, None] * spread[None, :] + self.rounding[at][:, None] * scale[None, :] + slack[at][:, None]
            own = self.ids[at][:, None] == ids[None, :]
            least, sure = self.kth[at], np.zeros(own.shape, bool)
            first_ones = 3 * self.k
            if len(ids) > first_ones:  # the exact scores of the best estimates: the k-th score can't be less
                top = np.argpartition(np.where(own, -np.inf, middle), len(ids) - first_ones, axis=1)[:, len(ids) - first_ones :]
                np.put_along_axis(sure, top, True, axis=1)
                known = np.where(np.take_along_axis(own, top, axis=1), -np.inf, (self.v[at][:, None, :] * v[top]).sum(2))
                least = np.maximum(least, np.partition(known, first_ones - self.k, axis=1)[:, first_ones - self.k])
            x, y = np.nonzero((sure | ~(middle + bound < least[:, None])) & ~own)
            score = np.concatenate([(self.v[at[x[a : a + 65_536]]] * v[y[a : a + 65_536]]).sum(1) for a in range(0, len(x), 65_536)] or [np.zeros(0)])
            cuts = np.searchsorted(x, np.arange(len(at) + 1))
            for q, a, b in zip(at.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a < b:
                    scores, found = np.concatenate([self.best[q][0], score[a:b]]), np.concatenate([self.best[q][1], ids[y[a:b]]])
                    order = np.lexsort((found, -scores))[: self.k]
                    self.best[q] = scores[order], found[order]
                    if len(order) == self.k:
                        self.kth[q] = scores[order[-1]]


def _packed(rows: DataFrame, by: str, names: list[str], made) -> DataFrame:
    """One row for each value of `by`, with the binary columns `names` that made(table) gives."""

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        return pa.table({by: pa.array([key[0].as_py()], pa.int64()), **{n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(names, made(rows.combine_chunks()), strict=True)}})

    return rows.groupBy(by).applyInArrow(pack, f"{by} long, " + ", ".join(f"{n} binary" for n in names))


def nearest(vectors: DataFrame, asks: Column, k: int, *, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id long, rank int, vec_id long, score double: for each row where `asks` holds, the k other rows with the
    largest inner products."""
    rows = taking_part(vectors, id_col, vec_col)
    chosen = taking_part(vectors.filter(asks), id_col, vec_col)
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    n, dim = size["n"], size["dim"] or 1
    room = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(room).select("v").toArrow()["v"].combine_chunks()
    cells = max(1, min(CELLS, n // CELL_ROWS, len(sample)))
    with np.errstate(all="ignore"):
        centre = centres(matrix(sample, dim), cells) if len(sample) else np.zeros((1, dim))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim)
        with np.errstate(all="ignore"):
            for batch in batches:
                cell, bits, length, s = encode(matrix(batch.column("v"), dim), centre, turn)
                packed = pa.array([x.tobytes() for x in bits], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64()), packed, pa.array(length), pa.array(s)], [*batch.schema.names, "cell", "code", "length", "s"])

    coded = materialise(rows.mapInArrow(code, "id long, v array<double>, cell long, code binary, length double, s double"), "codes")
    held = {r["cell"]: -(-r["n"] // BLOCK_ROWS) for r in coded.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # CELLS rows at most
    first = dict(zip(sorted(held), np.cumsum([0, *[held[c] for c in sorted(held)]]).tolist(), strict=False))
    blocks = sum(held.values())
    places = F.create_map(*[F.lit(x) for c in sorted(held) for x in (c, first[c])]) if held else None
    chunks = F.create_map(*[F.lit(x) for c in sorted(held) for x in (c, held[c])]) if held else None
    block = (F.element_at(places, F.col("cell")) + F.pmod(F.xxhash64("id"), F.element_at(chunks, F.col("cell")))) if held else F.lit(0)

    def of_rows(t: pa.Table) -> list[np.ndarray]:
        col = lambda c: t.column(c).combine_chunks()
        codes = np.frombuffer(b"".join(col("code").to_pylist()), np.uint8)
        return [t.column("cell").to_numpy()[:1], t.column("id").to_numpy(), matrix(col("v"), dim), codes, t.column("length").to_numpy(), t.column("s").to_numpy()]

    names = ["cell", "ids", "vs", "codes", "lengths", "ss"]
    packed = materialise(_packed(coded.withColumn("block", block.cast("long")), "block", names, of_rows), "code-blocks")
    # The key tells queries apart that repeat an id; it is written with its row and never made again.
    asked = materialise(chosen.withColumn("key", F.monotonically_increasing_id()), "queries")
    q_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    q_names = ["keys", "q_ids", "qs"]
    of_queries = lambda t: [t.column("key").to_numpy(), t.column("id").to_numpy(), matrix(t.column("v").combine_chunks(), dim)]
    q_packed = materialise(_packed(asked.withColumn("qb", F.pmod(F.xxhash64("key"), F.lit(q_blocks))), "qb", q_names, of_queries), "query-blocks")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, ids, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if left.num_rows and right.num_rows:
            as_array = lambda t, c, i, kind: np.frombuffer(t.column(c)[i].as_py(), kind)
            with np.errstate(all="ignore"):
                own = as_array(left, "keys", 0, np.int64)
                q = Queries(as_array(left, "qs", 0, np.float64).reshape(len(own), dim), as_array(left, "q_ids", 0, np.int64), rotation(dim), k)
                for i in range(right.num_rows):
                    there = as_array(right, "ids", i, np.int64)
                    v = as_array(right, "vs", i, np.float64).reshape(len(there), dim)
                    bits = as_array(right, "codes", i, np.uint64).reshape(len(there), -1)
                    q.meet(centre[as_array(right, "cell", i, np.int64)[0]], there, v, bits, as_array(right, "lengths", i, np.float64), as_array(right, "ss", i, np.float64))
            for key, (score, found) in zip(own.tolist(), q.best, strict=True):
                keys.append(np.full(len(found), key)), ids.append(found), scores.append(score)
            keys.append(own[:0])
            named = dict(zip(own.tolist(), as_array(left, "q_ids", 0, np.int64).tolist(), strict=True))
        flat = np.concatenate(keys)
        own_ids = np.array([named[x] for x in flat.tolist()], np.int64) if len(flat) else flat
        return pa.table({"key": pa.array(flat, pa.int64()), "query_id": pa.array(own_ids, pa.int64()), "vec_id": pa.array(np.concatenate(ids), pa.int64()), "score": pa.array(np.concatenate(scores), pa.float64())})

    groups = max(1, -(-blocks // GROUP))
    left = q_packed.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = packed.withColumn("g", F.pmod("block", F.lit(groups)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))
    found = left.groupBy("qb", "g").cogroup(right.groupBy("qb", "g")).applyInArrow(search, "key long, query_id long, vec_id long, score double")
    found = materialise(found, "found")
    discard(coded, packed, asked, q_packed)
    w = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
QUERIES = {"op12_ann_search": op12_ann_search}
ORACLES = {"op12_ann_search": OP12_SQL}
