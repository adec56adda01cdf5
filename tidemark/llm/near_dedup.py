"""MinHash near-dedup with odd sketches: banded candidates, XOR population counts, links confirmed on full sets.

1. Every text gives the set of its word shingles and SAMPLES MinHash samples of it. The first samples make BANDS band
   keys; all of them are folded into a parity bitmap, the odd sketch. Texts with equal sets are one class from here on,
   so that copies cost nothing more; a class is a node.
2. Classes that share a band key are candidates. Every member is first compared with its bucket's smallest node.
   The sketches' XOR count estimates how many samples differ; a pair goes on unless the count lies more than SIGMAS
   deviations beyond what a similarity of PERCENT gives. A second bitmap has the parities of the set itself: its XOR
   count never exceeds the sets' difference, so a count beyond what a link may differ by rules a pair out for certain.
3. What passes is confirmed on the full shingle sets of both texts. Confirmed links give components.
4. Buckets whose other members still lie in several components are compared all against all but within the largest of
   these, in blocks of bounded size. A block asks for a forest of most similar pairs that would join its components,
   these are confirmed, and components merge; this repeats, without the pairs that were refused, until no block asks.
   After ROUNDS rounds all pairs that are left are asked at once. So every pair of a bucket is screened, or already lies
   in one component: no link is lost to a cap.

What can be lost: at a similarity of 0.8 a pair misses all 40 bands of 5 rows about once in ten million, and the screen
of six deviations about once in a thousand million. Links that are reported are exact.

Defined results: null or blank texts have the empty set, link with nothing and are kept. Rows that repeat an id are told
apart by their sets. A row with a null id counts as a document, is linked like any other and is kept only where its
component has no id at all; equal texts share a component; an empty table gives no rows; other columns are not read by
`near_duplicates` and are kept by `drop_near_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import _shingles as sh
from ._common import BROADCAST_ROWS, discard, join_groups, materialise, small, table
from ._segments import slices

BANDS, BAND_ROWS = 40, 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
#: MinHash samples of a set, of which the first BANDS * BAND_ROWS make the band keys.
SAMPLES = 1024
SIGMAS = 6
#: Members of a bucket that are compared in one block are two such chunks at most, SLAB of them at a time.
CHUNK, SLAB = 2048, 64
#: Pairs of one node that are confirmed in one group.
PER_GROUP = 256
ROUNDS = 3
#: Refused pairs of a node that a block leaves out beforehand; those of nodes with more are taken out afterwards.
REFUSED = 4096


def sketches(docs: DataFrame, *, id_col: str, text_col: str, width: int) -> DataFrame:
    """id, th long (hash of the text), n int (shingles), h1, h2 long (digest of the set), bands array<long>,
    odd binary (of the samples), parity binary (of the set)."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = sh.seeds(2 * SAMPLES)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                sets = sh.shingle_sets(batch.column(1).slice(a, b - a), width)
                bands, odd, parity = [], [], []
                with np.errstate(over="ignore"):
                    for s in sets:
                        if not len(s):
                            bands.append(None), odd.append(None), parity.append(None)
                            continue
                        samples = sh.sample(s, SAMPLES, salts)
                        bands.append(sh.band_keys(samples[: BANDS * BAND_ROWS], BANDS).view(np.int64))
                        odd.append(sh.odd_sketch(_spread(samples)))
                        parity.append(sh.odd_sketch(s))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([len(s) for s in sets], pa.int32()),
                        *_digest_columns(sets),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(odd, pa.binary()),
                        pa.array(parity, pa.binary()),
                    ],
                    ["id", "th", "n", "h1", "h2", "bands", "odd", "parity"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    return rows.mapInArrow(run, f"id {kind}, th long, n int, h1 long, h2 long, bands array<long>, odd binary, parity binary")


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _digest_columns(sets: list[np.ndarray]) -> list[pa.Array]:
    both = np.frombuffer(b"".join(_digest(s) for s in sets), "<i8").reshape(-1, 2)
    return [pa.array(both[:, 0]), pa.array(both[:, 1])]


def _with_digests(rows: DataFrame, *, text_col: str, width: int) -> DataFrame:
    """rows with the columns h1 and h2 behind their own: the digests of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(text_col)):
                part = batch.slice(a, b - a)
                sets = sh.shingle_sets(part.column(text_col), width)
                yield pa.RecordBatch.from_arrays([*part.columns, *_digest_columns(sets)], [*part.schema.names, "h1", "h2"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, h1 long, h2 long")


def _spread(samples: np.ndarray) -> np.ndarray:
    """Samples hashed with their place, so that a place that differs flips two random bits."""
    return sh.mix64(samples ^ sh.seeds(len(samples)))


def passes(n_a: np.ndarray, n_b: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """Whether pairs with these set sizes and XOR counts may be links."""
    fits = 100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b)
    # Of a link's samples at most so many places differ on average, two bits each.
    places = SAMPLES * (100 - PERCENT) / 100
    mean = sh.expected_flips(2 * places)
    p = mean / sh.ODD_BITS
    spread = sh.ODD_BITS * p * (1 - p) + 4 * places * PERCENT / 100
    return fits & (flips <= mean + SIGMAS * np.sqrt(spread) + 1)


def within(n_a: np.ndarray, n_b: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """Whether the sets' parities leave a link possible: a link's sets differ in at most so many shingles."""
    return flips * (100 + PERCENT) <= (n_a + n_b) * (100 - PERCENT)


def _similar(flips: np.ndarray) -> np.ndarray:
    """Estimated similarity from the XOR count."""
    p = np.clip(1 - 2 * flips / sh.ODD_BITS, 1e-9, 1)
    return 1 - np.log(p) / np.log(1 - 2 / sh.ODD_BITS) / (2 * SAMPLES)


def _words(sketch: pa.Array) -> np.ndarray:
    """The sketches as rows of uint64 words."""
    return np.frombuffer(b"".join(sketch.to_pylist()), np.uint64).reshape(len(sketch), -1)


def _screen(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """a, b, est double of the pairs (a, b) that may be links."""
    side = lambda x: info.select(*[F.col(c).alias(f"{x}_{c}") for c in info.columns])
    both = pairs.join(side("a"), F.col("a") == F.col("a_node")).join(side("b"), F.col("b") == F.col("b_node"))
    both = both.filter(100 * F.least("a_n", "b_n") >= PERCENT * F.greatest("a_n", "b_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("a_n", "b_n"))
            flips = sh.popcounts(_words(batch.column("a_odd")), _words(batch.column("b_odd")))
            odd = sh.popcounts(_words(batch.column("a_parity")), _words(batch.column("b_parity")))
            ok, est = pa.array(passes(n_a, n_b, flips) & within(n_a, n_b, odd)), pa.array(_similar(flips))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), est], ["a", "b", "est"]).filter(ok)

    return both.select("a", "b", *[f"{x}_{c}" for x in "ab" for c in ("n", "odd", "parity")]).mapInArrow(run, "a long, b long, est double")


def _confirm(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets are similar enough. texts: node, h1, text.

    The pairs of a b stand together behind b's own text, in groups of bounded size; a group is read as a stream.
    """
    counts = pairs.groupBy("b").agg(F.ceil(F.count("*") / PER_GROUP).cast("int").alias("groups"))
    group = F.pmod(F.xxhash64("a"), F.col("groups")).cast("int").alias("g")
    asked = pairs.join(counts, "b").select("b", group, F.lit(1).alias("asked"), F.col("a").alias("node"))
    heads = counts.select("b", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"), F.lit(0).alias("asked"), F.col("b").alias("node"))
    rows = asked.unionByName(heads).join(texts, "node").select("b", "g", "asked", "node", "h1", "text")
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "b", "g").sortWithinPartitions("b", "g", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, place = None, None
        for batch in batches:
            for x, y in slices(batch.column("text")):
                part = batch.slice(x, y - x)
                sets = sh.shingle_sets(part.column("text"), width)
                a, b = [], []
                rest = (part.column(c).to_pylist() for c in ("b", "g", "asked", "node", "h1"))
                for s, pb, g, is_asked, node, h1 in zip(sets, *rest, strict=True):
                    if np.frombuffer(_digest(s), "<i8")[0] != h1:
                        continue  # another text with the same hash
                    if not is_asked:
                        head, place = s, (pb, g)
                    elif place == (pb, g):
                        both = len(np.intersect1d(s, head, assume_unique=True))
                        if 100 * both >= PERCENT * (len(s) + len(head) - both):
                            a.append(node)
                            b.append(pb)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the smallest node reachable) for all nodes of edges (a, b) but those that are themselves smallest.

    Alternating large-star and small-star steps (Kiveris and others, 2014); each round's edges are written out, and
    a round that changes none of them ends it.
    """
    pairs, state = _written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last = pairs
        pairs, after = _written(linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        discard(last)
        if after == state:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        state = after


def _written(pairs: DataFrame) -> tuple[DataFrame, dict]:
    """pairs (u, v) written out, with a count and two checksums taken on the way."""
    seen = Observation()
    sums = (F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("s"), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 40))).alias("t"))
    return materialise(pairs.observe(seen, *sums), "edges"), seen.get


def _merge(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (node, comp) after new links (a, b): components of the links between labels, then the nodes follow."""
    if labels is None:
        return components(links)
    comp = lambda x: labels.select(F.col("node").alias(x), F.col("comp").alias(f"{x}_comp"))
    ends = links.join(comp("a"), "a", "left").join(comp("b"), "b", "left")
    new = components(ends.select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b")))
    moved = labels.join(new.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left")
    moved = moved.select("node", F.coalesce("to", "comp").alias("comp"))
    return materialise(moved.unionByName(new), "labels")


def _ask(buckets: DataFrame, info: DataFrame, labels: DataFrame, rejected: DataFrame | None, *, all_pairs: bool) -> DataFrame:
    """a, b (a > b): candidates from different components within buckets (band, node); see `_forest`.

    A bucket's members outside its largest component are dealt to chunks, and so are the others; a block compares a
    chunk of the first with a chunk of either. So the largest component comes once for each chunk of the first.
    """
    here = buckets.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    held = here.groupBy("band", "comp").agg(F.count("*").alias("c")).groupBy("band").agg(
        F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("most"), F.count("*").alias("comps")
    )
    chunks = lambda n: F.ceil(n / CHUNK).cast("int")
    open_ones = materialise(
        held.filter("comps > 1").select(
            "band", "m", F.col("most.comp").alias("most"), chunks(F.col("m") - F.col("most.c")).alias("some"), chunks(F.col("most.c")).alias("rest")
        ), "open-bands",
    )
    if open_ones.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rows = here.join(F.broadcast(open_ones), "band")
    else:
        rows = join_groups(here, open_ones, ["band"], "m").filter("m IS NOT NULL")
    apart = F.col("comp") != F.col("most")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.when(apart, F.col("some")).otherwise(F.col("rest"))).cast("int"))
    block = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.alias("side"))
    own, some = F.col("own"), F.col("some")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    # side: 0 for a chunk that meets itself, else 1 for the first and 2 for the second chunk of a block.
    mutual = F.transform(upto(some), lambda x: block(F.least(own, x), F.greatest(own, x), F.when(x == own, 0).when(x > own, 1).otherwise(2)))
    onward = F.transform(upto(F.col("rest")), lambda y: block(own, some + y, F.lit(1)))
    once = F.transform(upto(some), lambda x: block(x, some + own, F.lit(2)))
    rows = rows.select("band", "node", "comp", F.inline(F.when(apart, F.concat(mutual, onward)).otherwise(once)))
    rows = rows.join(info, "node")
    if rejected is None:
        rows = rows.withColumn("no", F.array().cast("array<long>"))
    else:
        twice = rejected.unionByName(rejected.select(F.col("b").alias("a"), F.col("a").alias("b")))
        few = twice.groupBy("a").agg(F.count("*").alias("times")).filter(F.col("times") <= REFUSED).select("a")
        lists = twice.join(few, "a").groupBy(F.col("a").alias("node")).agg(F.collect_list("b").alias("no"))
        rows = rows.join(lists, "node", "left")
    parts = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "band", "i", "j").sortWithinPartitions("band", "i", "j")

    def pairs_of(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts).combine_chunks()
        node, comp, n, side = (t.column(c).to_numpy() for c in ("node", "comp", "n", "side"))
        label = np.unique(comp, return_inverse=True)[1]
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        if not side.any():  # of a chunk with itself; its own largest component needs no comparison within
            left = np.flatnonzero(label != np.bincount(label).argmax())
        words, parity = (_words(t.column(c).combine_chunks()) for c in ("odd", "parity"))
        no = t.column("no").to_pylist()
        column = {x: k for k, x in enumerate(node[right].tolist())} if any(no) else {}

        def slab(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            flips = sh.popcounts(words[rows][:, None], words[right][None, :])
            ok = passes(n[rows][:, None], n[right][None, :], flips) & (label[rows][:, None] != label[right][None, :])
            x, y = np.nonzero(ok)
            ok[x, y] = within(n[rows[x]], n[right[y]], sh.popcounts(parity[rows[x]], parity[right[y]]))
            if column:
                for x, k in enumerate(rows.tolist()):
                    ok[x, [column[y] for y in no[k] or () if y in column]] = False
            return ok, flips

        def made(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
            a, b = node[left[x]], node[right[y]]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

        value = None if all_pairs else np.full((len(left), len(right)), -1.0, np.float32)
        for at in range(0, len(left), SLAB):
            ok, flips = slab(left[at : at + SLAB])
            if all_pairs:
                x, y = np.nonzero(ok)
                if len(x):
                    yield made(x + at, y)
            else:
                value[at : at + SLAB] = np.where(ok, _similar(flips), -1.0)
        if value is not None and (value >= 0).any():
            found = np.array(_forest(value, label[left], label[right])).reshape(-1, 2)
            yield made(found[:, 0], found[:, 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("band", "i", "j")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if x == y:
                    continue
                key = tuple(keys[x].tolist())
                if held and key != last:
                    yield from pairs_of(held)
                    held.clear()
                held.append(batch.slice(x, y - x))
                last = key
        if held:
            yield from pairs_of(held)

    columns = ["band", "i", "j", "side", "node", "comp", "n", "odd", "parity", "no"]
    asked = rows.select(*columns).mapInArrow(run, "a long, b long").distinct()
    return asked if rejected is None else asked.join(rejected, ["a", "b"], "left_anti")


def _forest(value: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) pairs that would join all components that pairs link, the most similar first (Boruvka's steps).

    value: estimated similarity, -1 where there is no pair. left, right: the component of each row and column.
    """
    names = np.unique(np.concatenate([left, right]))
    parent = {int(x): int(x) for x in names}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out: list[tuple[int, int]] = []
    while True:
        l_root, r_root = (np.array([root(int(x)) for x in c]) for c in (left, right))
        value[l_root[:, None] == r_root[None, :]] = -1.0
        best_col, best_row = value.argmax(1), value.argmax(0)
        edges = [(value[x, y], x, y, l_root[x]) for x, y in enumerate(best_col.tolist()) if value[x, y] >= 0]
        edges += [(value[x, y], x, y, r_root[y]) for y, x in enumerate(best_row.tolist()) if value[x, y] >= 0]
        if not edges:
            return out
        asked = set()
        for _, x, y, mine in sorted(edges, key=lambda e: (-e[0], e[1], e[2])):
            if mine in asked:
                continue
            asked.add(mine)
            a, b = root(int(left[x])), root(int(right[y]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((x, y))


def _best(pairs: DataFrame) -> DataFrame:
    """The most similar b of each a, as unordered pairs (a > b)."""
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("est", "b")).alias("b"))
    return best.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends lie in different components."""
    comp = lambda x: labels.select(F.col("node").alias(x), F.col("comp").alias(f"{x}_comp"))
    both = pairs.join(comp("a"), "a", "left").join(comp("b"), "b", "left")
    return both.filter(F.coalesce("a_comp", "a") != F.coalesce("b_comp", "b")).select("a", "b")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """One row for each row of docs: id, n_shingles long, component_id (smallest id reachable over links), kept boolean."""
    return _judged(docs, id_col=id_col, text_col=text_col, width=width).drop("h1", "h2")


def _links(docs: DataFrame, classes: DataFrame, *, id_col: str, text_col: str, width: int) -> DataFrame:
    """Labels (node, comp) of the classes that links join."""
    info = classes.select("node", "n", "odd", "parity")
    members = classes.select("node", F.explode("bands").alias("band"))
    shared = materialise(members.groupBy("band").agg(F.min("node").alias("pivot"), F.count("*").alias("m")).filter("m > 1"), "shared-bands")
    # A merge join at every size: both sides grow with the corpus, and large partitions of a band can be split.
    buckets = materialise(members.join(shared.hint("merge"), "band"), "buckets")
    star = buckets.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    star = materialise(_screen(star, info), "star-pairs")
    others = buckets.filter("m > 2 AND node <> pivot").select("band", "node")
    needed = star.select(F.col("a").alias("node")).union(star.select("b")).union(others.select("node")).distinct()
    needed = materialise(needed.join(classes.select("node", "id", "th", "h1"), "node"), "needed")
    texts = _texts_of(docs, needed, id_col=id_col, text_col=text_col)

    labels = _merge(None, materialise(_confirm(_best(star), texts, width), "links"))
    rest = materialise(_apart(star.select("a", "b"), labels), "star-rest")
    if rest.limit(1).count():
        labels = _merge(labels, materialise(_confirm(rest, texts, width), "links"))
    rejected: DataFrame | None = None
    for turn in range(1, ROUNDS + 2):
        asked = materialise(_ask(others, info, labels, rejected, all_pairs=turn > ROUNDS), "asked")
        if not asked.limit(1).count():
            break
        linked = materialise(_confirm(asked, texts, width), "links")
        refused = asked.join(linked, ["a", "b"], "left_anti")
        last, rejected = rejected, materialise(refused if rejected is None else rejected.unionByName(refused), "refused")
        if last is not None:
            discard(last)
        last, labels = labels, _merge(labels, linked)
        discard(asked, linked, last)
    discard(shared, buckets, star, needed, texts, rest)
    return labels


def _texts_of(docs: DataFrame, needed: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """node, h1, text: one text of each needed class (node, id, th, h1)."""
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("__th"))
    same = F.col("__id").eqNullSafe(F.col("id")) & (F.col("__th") == F.col("th"))
    texts = materialise(rows.join(small(needed), same).select("node", "h1", "text"), "needed-texts")
    if texts.count() == needed.count():
        return texts
    one = materialise(texts.dropDuplicates(["node"]), "needed-texts")  # rows that repeat an id and its text
    discard(texts)
    return one


def _judged(docs: DataFrame, *, id_col: str, text_col: str, width: int) -> DataFrame:
    """near_duplicates with h1, h2, the digest of each row's set."""
    rows = materialise(sketches(docs, id_col=id_col, text_col=text_col, width=width), "sketches")
    named = rows.filter("n > 0").groupBy("h1", "h2", "n").agg(
        F.min("id").alias("id"), F.coalesce(F.min_by("th", "id"), F.min("th")).alias("th"), F.count("*").alias("size"),
        *[F.first(c).alias(c) for c in ("bands", "odd", "parity")],
    )
    # The number is written with its row and never made again.
    classes = materialise(named.withColumn("node", F.monotonically_increasing_id()), "set-classes")
    labels = _links(docs, classes, id_col=id_col, text_col=text_col, width=width)
    # The smallest node of a component has no label of its own.
    all_ = materialise(labels.unionByName(labels.select(F.col("comp").alias("node"), "comp").distinct()), "component-nodes")
    firsts = all_.join(classes.select("node", "id"), "node").groupBy("comp").agg(F.min("id").alias("first"), F.count("*").alias("members"))
    firsts = materialise(firsts, "component-ids")
    joined = join_groups(all_, firsts, ["comp"], "members").select("node", "first")
    groups = classes.join(joined, "node", "left").withColumn("component_id", F.coalesce("first", "id"))
    alone = (F.col("size") == 1) & F.col("component_id").eqNullSafe(F.col("id"))
    groups = materialise(groups.filter(~alone).select("h1", "h2", "size", "component_id"), "set-components")
    discard(labels, all_, firsts, classes)
    out = join_groups(rows.select("id", "n", "h1", "h2"), groups, ["h1", "h2"], "size")
    comp = F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        comp.alias("component_id"),
        F.col("id").eqNullSafe(comp).alias("kept"),
        "h1",
        "h2",
    )


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """docs with all their columns: just the rows that `near_duplicates` keeps.

    Rows go by their id, and where an id (or null) has both rows that stay and rows that go, by id and set.
    """
    found = _judged(docs, id_col=id_col, text_col=text_col, width=width).select(F.col(id_col).alias("gone"), "kept", "h1", "h2")
    found = materialise(found, "near-judged")
    gone = materialise(found.filter("NOT kept").select("gone", "h1", "h2").distinct(), "near-copies")
    ids = gone.select("gone").distinct()
    by_id = small(ids)
    out = docs.join(by_id, docs[id_col].eqNullSafe(by_id["gone"]), "left_anti")
    stay = found.filter("kept").select(F.col("gone").alias("stay"))
    both = materialise(ids.join(stay, F.col("gone").eqNullSafe(F.col("stay")), "left_semi"), "near-shared-ids")
    discard(found)
    if not both.limit(1).count():
        return out
    names = docs.columns
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    safe = docs.toDF(*[f"c{i}" for i in range(len(names))])
    safe = safe.join(small(both.withColumnRenamed("gone", "__both")), F.col(key).eqNullSafe(F.col("__both")), "left_semi")
    judged = _with_digests(safe, text_col=text, width=width)
    copies = small(gone.select("gone", F.col("h1").alias("g1"), F.col("h2").alias("g2")))
    same = F.col(key).eqNullSafe(F.col("gone")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    return out.unionByName(judged.join(copies, same, "left_anti").drop("h1", "h2").toDF(*names))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


QUERIES = {"op10_near_dedup": op10_near_dedup}
ORACLES: dict = {}
