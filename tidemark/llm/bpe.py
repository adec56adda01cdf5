"""Byte-level BPE by segment trees over the ranks of adjacent pairs, and its decoding.

A pre-token is a row of byte symbols. Leaf i of its tree holds (rank of the merge of symbol i and the next living
one, i), so the root is the leftmost pair of lowest rank. A merge changes three leaves, each a walk up to the root,
and the row is done when the root holds no rank. Short pre-tokens of a batch run side by side as matrix rows with
one tree each; long ones (a page without a space) run alone, in n log n.

Defined results: a null text is the empty one and has no ids; the string of a special token in a text is that
token; repeated rows repeat; an empty table gives no rows; a null id list decodes to the empty string; columns
that are not named are kept by `decode` and not read by `encode`.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table
from ._segments import SegmentCache, ragged, slices

VOCABULARY = "byte_bpe_50k.json"
#: Above any leaf and rank: no merge.
_NONE = np.int32(2**31 - 1)
#: Pre-tokens of up to so many bytes run side by side.
_WIDEST = 128
#: Symbols of the pre-tokens that run side by side, padding included, at most.
_CELLS = 1 << 18
#: The hash table of pairs has 2^_SLOT_BITS slots; keys are spread by an odd multiplier.
_SLOT_BITS = 18
_SPREAD = np.int64(-7046029254386353131)
#: The split of byte-level BPE, as the vocabulary's own documentation gives it (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Blocks in which every Unicode version classes characters alike; others are split by the library itself.
COMMON = re.compile("[\0-՗‐-‧‰-⁞、-〾ぁ-ゖァ-ヺ一-龥가-힣]*")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairTree:
    """A segment tree over the pair ranks of one long pre-token."""

    def __init__(self, model: Bpe, ids: list[int]):
        self.model, self.ids, n = model, ids, len(ids)
        self.width = 1 << max(1, (n - 1).bit_length())
        self.after, self.before = list(range(1, n + 1)), list(range(-1, n - 1))
        self.n = n
        none = (1 << 60, 0)
        self.tree = [none] * (2 * self.width)
        for i in range(n - 1):
            self.tree[self.width + i] = self._leaf(i)
        for i in range(self.width - 1, 0, -1):
            self.tree[i] = min(self.tree[2 * i], self.tree[2 * i + 1])

    def _leaf(self, i: int) -> tuple[int, int]:
        j = self.after[i]
        return (self.model.rank_of.get((self.ids[i], self.ids[j]), 1 << 60) if j < self.n else 1 << 60, i)

    def _update(self, i: int, leaf: tuple[int, int]) -> None:
        tree, i = self.tree, self.width + i
        tree[i] = leaf
        while i > 1:
            i >>= 1
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def run(self) -> list[int]:
        while (top := self.tree[1])[0] < 1 << 60:
            rank, i = top
            j = self.after[i]
            self.ids[i] = int(self.model.merged[rank])
            self.after[i] = k = self.after[j]
            if k < self.n:
                self.before[k] = i
            self._update(j, (1 << 60, j))
            self._update(i, self._leaf(i))
            if (h := self.before[i]) >= 0:
                self._update(h, self._leaf(h))
        out, i = [], 0
        while i < self.n:
            out.append(self.ids[i])
            i = self.after[i]
        return out


class Bpe:
    """A byte-level BPE vocabulary; one for each worker and path (see `load`)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, vocab = path, spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        symbols = byte_symbols()
        self.byte_id = np.zeros(256, np.int32)
        for char, b in symbols.items():
            self.byte_id[b] = vocab[char]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        bytes_of = [b""] * size
        for token, i in vocab.items():
            bytes_of[i] = bytes(symbols[c] for c in token)
        for token, i in self.special.items():
            bytes_of[i] = token.encode()
        self.all_bytes = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.byte_sizes = np.array([len(b) for b in bytes_of], np.int64)
        self.byte_starts = np.cumsum(self.byte_sizes) - self.byte_sizes
        self.rank_of = {(vocab[a], vocab[b]): r for r, (a, b) in reversed(list(enumerate(pairs)))}
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        # Pairs to ranks: an open hash table, and a plain table for pairs of single bytes.
        self.slot_keys, self.slot_ranks = np.full(1 << _SLOT_BITS, -1, np.int64), np.zeros(1 << _SLOT_BITS, np.int32)
        self.byte_pair_rank = np.full((256, 256), _NONE, np.int32)
        byte_of = {int(i): b for b, i in enumerate(self.byte_id)}
        for (a, b), rank in self.rank_of.items():
            key = a << 32 | b
            at = (key * int(_SPREAD) & 2**64 - 1) >> (64 - _SLOT_BITS)
            while self.slot_keys[at] >= 0:
                at = at + 1 & (1 << _SLOT_BITS) - 1
            self.slot_keys[at], self.slot_ranks[at] = key, rank
            if a in byte_of and b in byte_of:
                self.byte_pair_rank[byte_of[a], byte_of[b]] = rank
        self.split = regex.compile(PATTERN)
        self._library = None
        self.cache = SegmentCache(self.encode_segments, self.special)

    def pretokenize(self, text: str) -> list[str]:
        if COMMON.fullmatch(text):
            return self.split.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def encode_segments(self, segments: list[str]) -> list[bytes]:
        split = [[s] if s[1:].isalpha() and s[0] == " " and COMMON.fullmatch(s) else self.pretokenize(s) for s in segments]
        distinct = list({p for parts in split for p in parts})
        ids = dict(zip(distinct, self.merge([p.encode() for p in distinct]), strict=True))
        return [b"".join([ids[p] for p in parts]) for parts in split]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each pre-token, as little-endian 32-bit integers."""
        out = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > _WIDEST:
                ids = PairTree(self, self.byte_id[np.frombuffer(w, np.uint8)].tolist()).run()
                out[i] = np.array(ids, "<i4").tobytes()
            elif w:
                by_width.setdefault(1 << max(2, (len(w) - 1).bit_length()), []).append(i)
        for width, which in by_width.items():
            step = _CELLS // width
            for at in range(0, len(which), step):
                rows = which[at : at + step]
                for i, ids in zip(rows, self._merge_rows([words[i] for i in rows], width), strict=True):
                    out[i] = ids
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of ids, _NONE where there is none (or right < 0)."""
        key = np.where(right < 0, -2, left.astype(np.int64) << 32 | right)  # -1 marks an empty slot
        at = key * _SPREAD >> (64 - _SLOT_BITS) & (1 << _SLOT_BITS) - 1
        out = np.full(len(key), _NONE, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            held = self.slot_keys[at[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.slot_ranks[at[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
            at[todo] = at[todo] + 1 & (1 << _SLOT_BITS) - 1
        return out

    def _merge_rows(self, words: list[bytes], width: int) -> list[bytes]:
        """The ids of words of up to width bytes, as little-endian 32-bit integers.

        tree has 2 * width nodes for each word in heap order, root at 1, leaf of position i at width + i; a node
        holds rank * width + position. All arrays are flat; base is the place of a word's first node or symbol.
        """
        n = len(words)
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, n)
        first = np.cumsum(lengths) - lengths
        row = np.repeat(np.arange(n), lengths)
        col = np.arange(len(data)) - first[row]
        place = row * width + col
        ids = np.full(n * width, -1, np.int32)
        ids[place] = self.byte_id[data]
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), n)
        before = np.tile(np.arange(-1, width - 1, dtype=np.int32), n)
        tree = np.full((n, 2 * width), _NONE, np.int32)
        pairs = np.flatnonzero(col[1:] > 0)
        ranks = self.byte_pair_rank[data[pairs], data[pairs + 1]]
        found = ranks < _NONE
        at = pairs[found]
        tree.ravel()[row[at] * 2 * width + width + col[at]] = ranks[found] * width + col[at]
        size = width
        while size > 1:
            np.minimum(tree[:, size : 2 * size : 2], tree[:, size + 1 : 2 * size : 2], out=tree[:, size // 2 : size])
            size //= 2
        tree = tree.ravel()
        live = np.arange(n)
        while True:
            top = tree[live * (2 * width) + 1]
            going = top < _NONE
            live, top = live[going], top[going]
            if not len(live):
                break
            rank, i = np.divmod(top, width)
            base, node = live * width, live * (2 * width)
            j = after[base + i]
            k = after[base + j]
            h = before[base + i]
            made = self.merged[rank]
            ids[base + i] = made
            ids[base + j] = -1
            after[base + i] = k
            has_k, has_h = k < width, h >= 0
            before[(base + k)[has_k]] = i[has_k]
            right = np.where(has_k, ids[base + np.where(has_k, k, 0)], -1)
            left = ids[(base + h)[has_h]]
            got = self._ranks(np.concatenate([made, left]), np.concatenate([right, made[has_h]]))
            where = np.concatenate([i, h[has_h]])
            got = np.where(got < _NONE, got * width + where, _NONE)
            tree[node + width + j] = _NONE
            own = np.concatenate([node, node[has_h], node])
            tree[own[: len(got)] + width + where] = got
            walk = np.concatenate([where, j]) + width
            while walk[0] > 1:
                walk >>= 1
                both = own + 2 * walk
                tree[own + walk] = np.minimum(tree[both], tree[both + 1])
        kept = ids >= 0
        flat = ids[kept].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.count_nonzero(kept.reshape(n, width), axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids end)."""
        return self.cache.encode(texts)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of ids, cut at ends; bytes that are no UTF-8 become replacement characters."""
        sizes = self.byte_sizes[ids]
        data = ragged(self.all_bytes, self.byte_starts[ids], sizes).tobytes()
        cuts = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends])]
        try:
            data.decode()
            texts = None if np.any(np.frombuffer(data, np.uint8)[cuts[(cuts > 0) & (cuts < len(data))]] & 0xC0 == 0x80) else data
        except UnicodeDecodeError:
            texts = None
        if texts is None:
            return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)], pa.string())
        return pa.StringArray.from_buffers(len(ends), pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data))


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", decoded_col: str | None = None
) -> DataFrame:
    """One row for each row of docs: id, ids array<int>. One scan, no shuffle.

    With decoded_col, one more column holds what the ids decode to, made where the ids are (a round trip).
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                ids, ends = model.encode(batch.column(1).slice(a, b - a))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))
                out = [batch.column(0).slice(a, b - a), lists]
                if decoded_col:
                    out.append(model.decode(ids, ends))
                yield pa.RecordBatch.from_arrays(out, ["id", "ids", "decoded"][: len(out)])

    schema = f"id {kind}, ids array<int>" + ", decoded string" * bool(decoded_col)
    out = docs.select(id_col, text_col).mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return out.withColumnRenamed("decoded", decoded_col) if decoded_col else out


def decode(rows: DataFrame, path: str, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """rows with one more column, the text of ids_col (special tokens included)."""

    @F.pandas_udf("string")
    def text_of(ids):
        lists = [x if x is not None else [] for x in ids]
        ends = np.cumsum([len(x) for x in lists])
        flat = np.concatenate(lists).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
        return load(path).decode(flat, ends).to_pandas()

    return rows.withColumn(out_col, text_of(F.col(ids_col)))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = encode(table(spark, sf_dir, "documents"), vocabulary_path(), decoded_col="decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op2_bpe": op2_bpe}
ORACLES: dict = {}
