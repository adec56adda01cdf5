"""Tokenising whole texts by segment: each distinct segment of a slice is tokenised once.

A byte-level BPE first splits a text with a pattern in which a space always goes with the character after it,
unless that is white space too. So a text may be cut before every space that a non-space follows, and each
segment tokenised on its own: the ids are those of the whole text. Segments repeat far more than texts do. Cutting,
numbering the distinct segments and putting the ids together are done on Arrow and numpy arrays.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r" (?=\S)")
#: A space before white space of any kind, or at the end.
_LOOSE = r" (?:[\s\x{0b}\x{1c}-\x{1f}\x{85}\pZ]|\z)"
#: Bytes of text that are handled at a time, one text at least.
SLICE_BYTES = 4_000_000


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of an Arrow string or binary array with about so many bytes each, one value at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, n = 0, len(texts)
    while start < n:
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield start, end
        start = end


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start : start + size] of all (start, size), one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class SegmentCache:
    """Tokenises texts; encode_new(list of distinct strings) -> ids of each, as little-endian 32-bit bytes.

    Ids of the first `limit` segments that it meets are kept, which holds the frequent ones, and forgotten after
    REFRESH slices; segments beyond that are tokenised in each slice that has them.
    """

    REFRESH = 200

    def __init__(self, encode_new: Callable[[list[str]], list[bytes]], special: dict[str, int] | None = None, limit: int = 400_000):
        self.encode_new, self.limit, self.calls = encode_new, limit, 0
        self.special = special or {}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids end), int32 and int64."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        marked = np.zeros(len(texts), bool)
        for s in self.special:
            marked |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self._plain(texts)
        parts: list[str] = []
        split = [self.marks.split(t) for t in texts.to_pylist()]
        for p in split:
            parts += p[::2]  # what stands between special tokens is a text of its own
        ids, ends = self._plain(pa.array(parts, pa.string()))
        pieces = iter(np.split(ids, ends[:-1]))
        done = [
            np.concatenate([np.array([self.special[p]], np.int32) if i % 2 else next(pieces) for i, p in enumerate(ps)])
            for ps in split
        ]
        return np.concatenate(done), np.cumsum([len(d) for d in done])

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        mask = pc.match_substring_regex(texts, _LOOSE).to_numpy(zero_copy_only=False)
        if mask.any():
            return self._both(texts, mask)
        cut = pc.split_pattern(texts, " ")
        offsets = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        codes, keys = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        heads = offsets[:-1]
        head_keys = [" " + keys[c] for c in codes[heads].tolist()]  # " " marks a text's first segment, which has no space
        codes[heads] = np.arange(len(keys), len(keys) + len(heads))
        return self._look_up(keys + head_keys, codes, offsets)

    def _both(self, texts: pa.Array, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts with loose spaces (mask) are cut by pattern, the others at every space."""
        (a, a_ends), (b, b_ends) = self._plain(texts.filter(pa.array(~mask))), self._spaced(texts.filter(pa.array(mask)))
        starts, sizes = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for where, ends, first in ((~mask, a_ends, 0), (mask, b_ends, len(a))):
            sizes[where] = np.diff(ends, prepend=0)
            starts[where] = first + ends - sizes[where]
        return ragged(np.concatenate([a, b]), starts, sizes), np.cumsum(sizes)

    def _spaced(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As _plain, where a text has a space before white space or at its end: cut by pattern."""
        cut = [_CUT.split(t) for t in texts.to_pylist()]
        number: dict[str, int] = {}
        codes = [number.setdefault(s if i else " " + s, len(number)) for c in cut for i, s in enumerate(c)]
        offsets = np.cumsum([0, *map(len, cut)])
        return self._look_up(list(number), np.array(codes, np.int64), offsets)

    def _look_up(self, keys: list[str], codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.calls += 1
        if self.calls % self.REFRESH == 0:
            self.known.clear()
        known = self.known
        ids = list(map(known.get, keys))
        new = [i for i, x in enumerate(ids) if x is None]
        asked = [keys[i] for i in new]
        made = self.encode_new([k[1:] if k[:1] == " " else " " + k for k in asked])
        for i, x in zip(new, made, strict=True):
            ids[i] = x
        if len(known) < self.limit:
            known.update(zip(asked, made, strict=True))
        flat = np.frombuffer(b"".join(ids), "<i4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        here = sizes[codes]
        out = ragged(flat, (np.cumsum(sizes) - sizes)[codes], here)
        return out, np.concatenate([[0], np.cumsum(here)])[offsets[1:]]
