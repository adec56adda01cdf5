"""Token ids in directly addressable codes: byte levels with continuation bitmaps and rank directories.

A segment holds the ids of consecutive documents. Level 0 has the lowest 8 bits of every id and a bitmap of the
ids that go on; level 1 has the next 8 bits of just those, and so forth. The position of an id on the next level
is the rank of its bit, which a directory of counts every 512 bits gives with one popcount of at most 64 bytes, so
any token is read alone, without decoding its block.

A store is a folder of Parquet files in the session's shared folder, written by Spark (any file system, and lost
tasks are written again), one row for each segment: part, number in the part, first local token, its documents'
ids and token counts, the codes. Documents ascend by id over parts, segments and rows.

Defined results: a null text is the empty one and has just the end id; a null document id comes first; rows that
repeat an id are ordered by their text's hash and each has its own place; an empty table gives an empty store;
other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import discard, materialise, small, table
from ._segments import SegmentCache, slices
from .bpe import COMMON, byte_symbols, vocabulary_path

END_ID = 2
#: Tokens in a segment, up to the end of its last document.
SEGMENT_TOKENS = 1 << 18
#: Bytes of text that are encoded at a time: the more, the fewer times a frequent word is looked up.
ENCODE_BYTES = 16_000_000
_BLOCK = 512
_MAGIC = b"DAC1"


def pack(ids: np.ndarray) -> bytes:
    """ids (unsigned, up to 32 bits) as directly addressable codes."""
    left = np.asarray(ids, np.uint32)
    levels = []
    while len(left) or not levels:
        more = left > 0xFF
        bits = np.packbits(more, bitorder="little")
        whole = np.concatenate([bits, np.zeros(-len(bits) % (_BLOCK // 8), np.uint8)])
        counts = np.bitwise_count(whole.reshape(-1, _BLOCK // 8)).sum(1, dtype=np.uint32)
        ranks = (np.cumsum(counts, dtype=np.uint32) - counts).astype("<u4")
        levels.append((len(left), left.astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()))
        left = left[more] >> np.uint32(8)
        if not len(left):
            break
    head = _MAGIC + struct.pack("<I", len(levels)) + b"".join(struct.pack("<I", n) for n, *_ in levels)
    return head + b"".join(b"".join(parts) for _, *parts in levels)


class Codes:
    """A packed segment; nothing is decoded before it is asked for."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        (n_levels,) = struct.unpack_from("<I", data, 4)
        sizes = struct.unpack_from(f"<{n_levels}I", data, 8)
        at, self.levels = 8 + 4 * n_levels, []
        for n in sizes:
            n_bits = -(-n // 8)
            n_ranks = -(-n_bits // (_BLOCK // 8))
            chunks = np.frombuffer(data, np.uint8, n, at)
            bits = np.frombuffer(data, np.uint8, n_bits, at + n)
            ranks = np.frombuffer(data, "<u4", n_ranks, at + n + n_bits)
            self.levels.append((chunks, bits, ranks))
            at += n + n_bits + 4 * n_ranks
        self.n = sizes[0]

    def __len__(self) -> int:
        return self.n

    def token(self, i: int) -> int:
        """The id at position i: one chunk, bit and rank for each of its levels."""
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            byte, bit = i >> 3, i & 7
            if not bits[byte] >> bit & 1:
                break
            block = i // _BLOCK
            first = block * (_BLOCK // 8)
            before = int(np.bitwise_count(bits[first:byte]).sum()) + (int(bits[byte]) & (1 << bit) - 1).bit_count()
            i, shift = int(ranks[block]) + before, shift + 8
        return value

    def all(self) -> np.ndarray:
        """All ids, uint32."""
        out: np.ndarray | None = None
        for chunks, bits, _ in reversed(self.levels):
            here = chunks.astype(np.uint32)
            if out is not None and len(out):
                here[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)] |= out << np.uint32(8)
            out = here
        return out


@lru_cache(maxsize=4)
def _encoder(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Whole texts to ids with the tokenizers library, which sees each distinct segment of a slice once."""
    import json
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker on each core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}

    model = tokenizer.model
    symbols = {b: c for c, b in byte_symbols().items()}
    glue, latin = symbols[0x20], {b: c for b, c in symbols.items() if chr(b) != c}
    stops = {p: np.array(tokenizer.encode(p, add_special_tokens=False).ids, "<i4").tobytes() for p in ("", ".", ",")}

    def new(segments: list[str]) -> list[bytes]:
        """Ids of each segment. A plain word, a full stop or comma after it or not, goes to the library's model at once."""
        out: list[bytes | None] = []
        rest = []
        for s in segments:
            word, stop = (s[:-1], s[-1]) if s[-1:] in (".", ",") else (s, "")
            if s[:1] == " " and word[1:].isalpha() and (word.isascii() or COMMON.fullmatch(word)):
                coded = glue + word[1:] if word.isascii() else word.encode().decode("latin-1").translate(latin)
                out.append(array("i", [t.id for t in model.tokenize(coded)]).tobytes() + stops[stop])
            else:
                rest.append(len(out))
                out.append(None)
        made = tokenizer.encode_batch_fast([segments[i] for i in rest], add_special_tokens=False)
        for i, e in zip(rest, made, strict=True):
            out[i] = array("i", e.ids).tobytes()
        return out

    return SegmentCache(new, special).encode


def write_store(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    segment_tokens: int = SEGMENT_TOKENS,
) -> DataFrame:
    """Tokenises docs, appends end_id to each, writes the store in ascending id order, and returns it as read back.

    Texts are encoded where they lie; only packed ids are sorted and dealt by ranges of ids.
    """
    spark = docs.sparkSession
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _encoder(path), np.array([end_id], np.int32)
        for batch in batches:
            for a, b in slices(batch.column("text"), ENCODE_BYTES):
                part = batch.slice(a, b - a)
                coded, ends = encode(part.column("text"))
                packed = []
                for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    ids = np.concatenate([coded[x:y], end])
                    packed.append(b"\x02" + ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"\x04" + ids.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("th"), pa.array(packed, pa.binary())], ["id", "th", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, first, count = TaskContext.get().partitionId(), 0, 0, 0
        ids: list[pa.Array] = []
        sizes: list[int] = []
        held: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            nonlocal number, first
            tokens = np.concatenate(held).astype(np.uint32)
            row = {
                "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                "first": pa.array([first], pa.int64()), "n_tokens": pa.array([len(tokens)], pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays(ids)),
                "sizes": pa.array([sizes], pa.list_(pa.int64())), "codes": pa.array([pack(tokens)], pa.binary()),
            }
            number, first = number + 1, first + len(tokens)
            ids.clear(), sizes.clear(), held.clear()
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for i, data in enumerate(batch.column(1).to_pylist()):
                here = np.frombuffer(data, f"<u{data[0]}", offset=1)
                ids.append(batch.column(0).slice(i, 1))
                sizes.append(len(here))
                held.append(here)
                count += len(here)
                if count >= segment_tokens:
                    yield segment()
                    count = 0
        if sizes:
            yield segment()

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    # Written first: dealing by ranges reads its input twice.
    coded = materialise(texts.mapInArrow(code, f"id {kind}, th long, packed binary"), "token-ids")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = coded.repartitionByRange(parts, "id", "th").sortWithinPartitions("id", "th").select("id", "packed")
    schema = f"part int, number int, first long, n_tokens long, ids array<{kind}>, sizes array<long>, codes binary"
    store = materialise(ordered.mapInArrow(run, schema), "token-store")
    discard(coded)
    return store


def read_documents(store: DataFrame, *, id_col: str = "doc_id", want: tuple[str, ...] = ("tokens",)) -> DataFrame:
    """Documents of a store: id, start long (tokens of all documents before), n_tokens long, and what is wanted:
    tokens array<int>, or ids_crc32 long (of the ids as little-endian unsigned 32-bit integers)."""
    kind = store.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                first, ids, sizes, codes = (batch.column(c)[i] for c in ("first", "ids", "sizes", "codes"))
                tokens, sizes = Codes(codes.as_py()).all(), sizes.values.to_numpy()
                ends = np.cumsum(sizes)
                if len(tokens) != ends[-1]:
                    raise ValueError("a segment's codes don't match its document sizes")
                made = {"id": ids.values, "start": pa.array(first.as_py() + ends - sizes), "n_tokens": pa.array(sizes)}
                if "tokens" in want:
                    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                    made["tokens"] = pa.ListArray.from_arrays(offsets, pa.array(tokens.view(np.int32)))
                if "ids_crc32" in want:
                    data = memoryview(tokens.astype("<u4", copy=False)).cast("B")
                    crcs = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                    made["ids_crc32"] = pa.array(crcs, pa.int64())
                yield pa.RecordBatch.from_pydict(made)

    placed = _placed(store).select("first", "ids", "sizes", "codes")
    more = {"tokens": ", tokens array<int>", "ids_crc32": ", ids_crc32 long"}
    schema = f"id {kind}, start long, n_tokens long" + "".join(v for k, v in more.items() if k in want)
    return placed.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _placed(store: DataFrame) -> DataFrame:
    """The store with `first` counted from the store's beginning: one sum for each part, which are few."""
    totals = store.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = materialise(totals.select("part", before.alias("before")), "token-parts")
    return store.join(small(starts), "part").withColumn("first", F.col("first") + F.col("before"))


def tokens_at(store: DataFrame, wanted: DataFrame) -> DataFrame:
    """position, token for the positions (long, counted over the whole store) of wanted, each read alone.

    Positions meet the segments' directory by cells; those of a segment are gathered, so that its codes come once,
    and are then read by address.
    """
    placed = _placed(store)
    spans = placed.select("part", "number", "first", (F.col("first") + F.col("n_tokens")).alias("after"))
    step = F.lit(SEGMENT_TOKENS)
    cells = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("first") / step), F.floor((F.col("after") - 1) / step))))
    asked = wanted.groupBy("position").agg(F.count("*").alias("times"))
    found = asked.withColumn("cell", F.floor(F.col("position") / step)).join(cells, "cell")
    found = found.filter((F.col("position") >= F.col("first")) & (F.col("position") < F.col("after")))
    local = F.struct((F.col("position") - F.col("first")).alias("at"), "times")
    found = found.groupBy("part", "number", "first").agg(F.collect_list(local).alias("wanted")).join(store.select("part", "number", "codes"), ["part", "number"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                first, asked, data = (batch.column(c)[i].as_py() for c in ("first", "wanted", "codes"))
                codes = Codes(data)
                made = [(first + w["at"], codes.token(w["at"])) for w in asked for _ in range(w["times"])]
                yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], pa.int64()) for k in (0, 1)], ["position", "token"])

    return found.select("first", "wanted", "codes").mapInArrow(run, "position long, token long")


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = write_store(table(spark, sf_dir, "documents"), vocabulary_path())
    return read_documents(store, want=("ids_crc32",))


QUERIES = {"op9_token_store": op9_token_store}
ORACLES: dict = {}
