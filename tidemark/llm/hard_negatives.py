"""Hard negatives from a forest of STR-packed R-trees: boxes bound inner products, a best-first queue skips the rest.

1. Components become floor(256 x), scores are exact integers. Spark sorts the rows by (label, the coordinate that varies
   most, id) into ranges of bounded size: the first step of sort-tile-recursive packing. Each range is one tree: its rows
   are cut into slabs by the next coordinates, again and again, down to leaves of LEAF rows; upper levels take FANOUT
   neighbours each. A node holds the least and largest value of every coordinate and of the label.
2. An anchor q bounds a node's scores from below and above by adding, for each coordinate, the smaller and the larger of
   q_i lo_i and q_i hi_i.
3. First pass: each anchor's first positives of its own label; nodes whose labels leave the anchor's out are skipped.
   Second pass: with the positives' scores known, each positive gives a window of scores, and one walk serves all windows
   of an anchor. The queue gives the node with the highest upper bound first. A node is skipped for a window if its bounds
   lie outside it, or if its upper bound lies strictly below the window's k-th score so far (equal scores are decided by
   id, so they are looked at); a node that no window wants is dropped, and so is one that has only the anchor's label.
4. A task takes one block of anchors and GROUP trees, carrying the k-th scores from tree to tree, and returns k rows for
   each anchor and window at most; one window function picks the first ones of all tasks.

So the stated anchors meet all rows, in blocks of bounded size, and nothing is capped: a label with a third of all rows is
many trees.

Defined results: rows whose id or label is null, or whose vector is null or holds null or non-finite components, take no
part. Shorter vectors count as ending in zeros, an empty one is all zeros. Scaled components beyond 2^24 count as 2^24.
Rows with the anchor's own id are neither its positives nor its negatives; rows that repeat an id are anchors and
candidates of their own. A window with no row gives none. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import discard, materialise, table
from .ann_search import matrix

SCALE, LARGEST = 256, 1 << 24
LEAF, FANOUT = 128, 16
#: Rows of a tree and anchors of a block on average; trees that a task meets.
TREE_ROWS, ANCHOR_ROWS, GROUP = 4096, 512, 4
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
_NONE = np.iinfo(np.int64).min


def dot_type(a: np.ndarray, b: np.ndarray) -> type:
    """The type in which inner products of integer rows are exact: doubles (fast) while sums stay below 2^53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[-1])
    return np.float64 if most < 2**53 else np.int64


class Tree:
    """An STR-packed R-tree over integer vectors."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        order = np.concatenate(_tiles(v, np.lexsort((ids, labels)), _by_spread(v), 0)) if len(v) else np.zeros(0, np.int64)
        self.v, self.ids, self.labels = v[order], ids[order], labels[order]
        # levels[0]: leaves; each level: (lo, hi, least label, largest label).
        cut = np.arange(0, len(v), LEAF)
        levels = [[np.minimum.reduceat(self.v, cut), np.maximum.reduceat(self.v, cut), np.minimum.reduceat(self.labels, cut), np.maximum.reduceat(self.labels, cut)]]
        while len(levels[-1][0]) > 1:
            lo, hi, a, b = levels[-1]
            cut = np.arange(0, len(lo), FANOUT)
            levels.append([np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut), np.minimum.reduceat(a, cut), np.maximum.reduceat(b, cut)])
        self.levels = levels

    def bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each level (least, largest) possible score of each anchor (row) with each node (column)."""
        kind = dot_type(q, self.v)
        up, down = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
        out = []
        for lo, hi, _, _ in self.levels:
            lo, hi = lo.astype(kind).T, hi.astype(kind).T
            out.append(((up @ lo + down @ hi).astype(np.int64), (up @ hi + down @ lo).astype(np.int64)))
        return out


def _by_spread(v: np.ndarray) -> np.ndarray:
    """Coordinates, those that vary most first."""
    return np.argsort(-v.astype(np.float64).var(0), kind="stable")


def _tiles(v: np.ndarray, rows: np.ndarray, dims: np.ndarray, depth: int) -> list[np.ndarray]:
    """Rows cut recursively into slabs by one coordinate after another: sort-tile-recursive packing into whole leaves."""
    leaves = -(-len(rows) // LEAF)
    if leaves <= 1 or depth >= len(dims):
        return [rows]
    rows = rows[np.argsort(v[rows, dims[depth]], kind="stable")]
    slabs = max(2, round(leaves ** (1 / max(1, min(3, len(dims)) - depth)))) if depth < 3 else 2
    size = -(-leaves // slabs) * LEAF
    return [x for a in range(0, len(rows), size) for x in _tiles(v, rows[a : a + size], dims, depth + 1)]


class Best:
    """The first k (score, id) of each of several windows of scores [low, high] of one anchor."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.floor = low.copy()  # a window wants scores from here: its low end, or its k-th score so far
        self.held: list[list[tuple[int, int]]] = [[] for _ in low]

    def wanted(self, least: int, most: int) -> bool:
        return bool(((self.floor <= most) & (self.high >= least)).any())

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for w in np.flatnonzero(self.floor <= scores.max(initial=_NONE)):
            at = np.flatnonzero((scores >= self.floor[w]) & (scores <= self.high[w]))
            if len(at):
                if len(at) > self.k:
                    at = at[np.lexsort((ids[at], -scores[at]))[: self.k]]
                held = sorted([*self.held[w], *zip((-scores[at]).tolist(), ids[at].tolist(), strict=True)])[: self.k]
                self.held[w] = held
                if len(held) == self.k:
                    self.floor[w] = max(self.low[w], -held[-1][0])


def walk(tree: Tree, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, best: list[Best], *, same_label: bool) -> int:
    """Offers the tree's rows to each anchor's windows, best nodes first; returns how many leaves were read."""
    if not len(tree.v):
        return 0
    bounds, kind, top = tree.bounds(q), dot_type(q, tree.v), len(tree.levels) - 1
    rows, asked, read = tree.v.astype(kind), q.astype(kind), 0

    def fits(level: int, node: int, label: int) -> bool:
        a, b = tree.levels[level][2][node], tree.levels[level][3][node]
        return a <= label <= b if same_label else not a == label == b

    for i, (own, label, found) in enumerate(zip(ids.tolist(), labels.tolist(), best, strict=True)):
        queue = [(-int(bounds[top][1][i, 0]), top, 0)] if fits(top, 0, label) else []
        while queue:
            most, level, node = heapq.heappop(queue)
            if not found.wanted(int(bounds[level][0][i, node]), -most):
                continue
            if level:
                low, high = bounds[level - 1]
                for child in range(node * FANOUT, min((node + 1) * FANOUT, low.shape[1])):
                    if fits(level - 1, child, label) and found.wanted(int(low[i, child]), int(high[i, child])):
                        heapq.heappush(queue, (-int(high[i, child]), level - 1, child))
                continue
            a = node * LEAF
            there = slice(a, a + LEAF)
            keep = ((tree.labels[there] == label) == same_label) & (tree.ids[there] != own)
            found.offer((rows[there] @ asked[i]).astype(np.int64)[keep], tree.ids[there][keep])
            read += 1
    return read


def quantised(rows: DataFrame, label: Column, *, id_col: str, vec_col: str) -> DataFrame:
    """id long, label long, v array<long> of the rows that take part."""
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(finite)
    part = lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
    return rows.select("id", "label", F.transform("x", part).alias("v"))


def _array(t: pa.Table, name: str, i: int, dim: int = 0) -> np.ndarray:
    a = np.frombuffer(t.column(name)[i].as_py(), np.int64)
    return a.reshape(-1, dim) if dim else a


def forest(rows: DataFrame, dim: int) -> DataFrame:
    """tree long, low_label, high_label, ids, labels, vs (binary): ranges of rows by (label, widest coordinate, id)."""
    spread = rows.select(*[F.var_pop(F.get("v", F.lit(i)).cast("double")).alias(f"c{i}") for i in range(dim)]).first()
    widest = max(range(dim), key=lambda i: (spread[i] or 0.0, -i))
    n = rows.count()
    ranges = max(1, -(-n // TREE_ROWS))
    ordered = rows.withColumn("lead", F.coalesce(F.get("v", F.lit(widest)), F.lit(0).cast("long")))
    ordered = ordered.repartitionByRange(ranges, "label", "lead", "id").sortWithinPartitions("label", "lead", "id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["low_label", "high_label", "ids", "labels", "vs"]
        for batch in batches:
            for a in range(0, batch.num_rows, 2 * TREE_ROWS):
                part = batch.slice(a, 2 * TREE_ROWS)
                labels = part.column("label").to_numpy()
                packed = [part.column("id").to_numpy(), labels, matrix(part.column("v"), dim).astype(np.int64)]
                ends = [pa.array([labels[0]], pa.int64()), pa.array([labels[-1]], pa.int64())]
                yield pa.RecordBatch.from_arrays([*ends, *[pa.array([x.tobytes()], pa.binary()) for x in packed]], names)

    packed = ordered.mapInArrow(pack, "low_label long, high_label long, ids binary, labels binary, vs binary")
    return materialise(packed.withColumn("tree", F.monotonically_increasing_id()), "trees")


def _blocks(anchors: DataFrame, dim: int, extra: list[str]) -> DataFrame:
    """block long and packed columns: keys, ids, labels, vs and, of each anchor, `extra` (arrays of longs, flattened with their sizes)."""
    names = ["keys", "ids", "labels", "vs", *[f"{c}_{x}" for c in extra for x in ("n", "all")]]

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        col = lambda c: t.column(c).combine_chunks()
        made = [t.column(c).to_numpy() for c in ("key", "id", "label")] + [matrix(col("v"), dim).astype(np.int64)]
        for c in extra:
            made += [np.diff(col(c).offsets.to_numpy()).astype(np.int64), col(c).flatten().to_numpy()]
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), **{n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(names, made, strict=True)}})

    return anchors.groupBy("block").applyInArrow(pack, "block long, " + ", ".join(f"{n} binary" for n in names))


def _meet(anchors: DataFrame, trees: DataFrame, dim: int, extra: list[str], *, same_label: bool, k: int) -> DataFrame:
    """key long, slot int, id long, score long: the first k rows of each anchor's windows within each group of trees."""
    anchor_blocks = materialise(_blocks(anchors, dim, extra), "anchor-blocks")
    n_trees = trees.count()
    groups = max(1, -(-n_trees // GROUP))
    ranked = trees.withColumn("g", F.pmod(F.xxhash64("tree"), F.lit(groups)).cast("int"))
    left = anchor_blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    n_blocks = (anchor_blocks.agg(F.max("block")).first()[0] or 0) + 1
    right = ranked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))

    def search(a: pa.Table, t: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if a.num_rows and t.num_rows:
            keys, ids, labels, q = _array(a, "keys", 0), _array(a, "ids", 0), _array(a, "labels", 0), _array(a, "vs", 0, dim)
            if extra:
                cuts = np.cumsum(_array(a, f"{extra[0]}_n", 0))[:-1]
                low, high = (np.split(_array(a, f"{c}_all", 0), cuts) for c in extra)
                best = [Best(x, y, k) for x, y in zip(low, high, strict=True)]
            else:
                best = [Best(np.array([_NONE]), np.array([np.iinfo(np.int64).max]), k) for _ in keys]
            for i in range(t.num_rows):
                tree = Tree(_array(t, "vs", i, dim), _array(t, "ids", i), _array(t, "labels", i))
                walk(tree, q, ids, labels, best, same_label=same_label)
            out = [(key, w, found, -score) for key, b in zip(keys.tolist(), best, strict=True) for w, held in enumerate(b.held) for score, found in held]
        cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
        kinds = [("key", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("score", pa.int64())]
        return pa.table({n: pa.array(c, kind) for (n, kind), c in zip(kinds, cols, strict=True)})

    found = left.groupBy("block", "g").cogroup(right.groupBy("block", "g")).applyInArrow(search, "key long, slot int, id long, score long")
    w = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "id")
    found = materialise(found, "met").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return found


def mine(vectors: DataFrame, anchors: Column, label: Column, *, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id long, rank int, negative_id, positive_score, negative_score long.

    anchors says which rows are anchors, label gives each row's label. A negative of a positive has LOW to HIGH percent of
    its score.
    """
    rows = materialise(quantised(vectors, label, id_col=id_col, vec_col=vec_col), "quantised")
    dim = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 1)
    chosen = quantised(vectors.filter(anchors), label, id_col=id_col, vec_col=vec_col)
    # The key tells anchors apart that repeat an id; it is written with its row and never made again.
    chosen = materialise(chosen.withColumn("key", F.monotonically_increasing_id()), "anchors")
    blocks = max(1, -(-chosen.count() // ANCHOR_ROWS))
    chosen = chosen.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    trees = forest(rows, dim)
    positives = materialise(_meet(chosen, trees, dim, [], same_label=True, k=POSITIVES).select("key", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # In integers: LOW * p <= 100 * n <= HIGH * p.
    floor = lambda x: F.expr(f"({x} - pmod({x}, 100)) div 100")
    low, high = -floor(f"-{LOW} * positive_score"), floor(f"{HIGH} * positive_score")
    windows = positives.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", low.alias("low"), high.alias("high")))).alias("w"))
    asking = chosen.join(windows, "key").select("*", F.col("w.low").alias("low"), F.col("w.high").alias("high")).drop("w")
    negatives = _meet(asking, trees, dim, ["low", "high"], same_label=False, k=NEGATIVES)
    named = positives.join(chosen.select("key", F.col("id").alias("anchor_id")), "key").withColumn("slot", F.col("place") - 1)
    out = negatives.join(named, ["key", "slot"])
    discard(rows)
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), found AS (
  SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)::INT AS rank
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3
"""
QUERIES = {"op11_hard_negatives": op11_hard_negatives}
ORACLES = {"op11_hard_negatives": OP11_SQL}
