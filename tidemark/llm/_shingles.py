"""Word shingles of whole texts as 64-bit hashes, and MinHash samples and odd sketches over them (numpy)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from ._fuse import mix64

#: Bits of an odd sketch.
ODD_BITS = 2048
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(2**64 - 1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words, where each text's words end). A-Z is lower-cased; words stand between ASCII white space."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
    coded = cut.flatten().dictionary_encode()
    words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))[codes]
    real = np.fromiter((bool(w) for w in words), bool, len(words))[codes]
    return hashes[real], np.concatenate([[0], np.cumsum(real)])[offsets[1:]]


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text: runs of `width` words; fewer words are one shingle, none are none."""
    hashes, ends = word_hashes(texts)
    starts = np.concatenate([[0], ends[:-1]])
    with np.errstate(over="ignore"):
        return [_set(hashes[a:b], width) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _set(words: np.ndarray, width: int) -> np.ndarray:
    if len(words) == 0:
        return words
    run = min(width, len(words))
    rows = len(words) - run + 1
    made = mix64(words[:rows] + np.uint64(run))
    for i in range(1, run):
        made = mix64(made * _SPREAD + words[i : i + rows])
    return np.unique(made)


def seeds(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * _SPREAD)


def sample(values: np.ndarray, k: int, salts: np.ndarray) -> np.ndarray:
    """k MinHash samples: equal in two sets' same place with a chance of their similarity.

    After Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching" (2017): in round r every value falls into one
    of k bins with a random rank behind those of earlier rounds; a bin keeps the least; bins that k rounds leave
    empty take their least of all values. salts: 2 k numbers.
    """
    out = np.full(k, _EMPTY)
    step = max(1, math.ceil(k * (math.log(k) + 2) / len(values)))
    low, shift = np.uint64(0xFFFFFFFF), np.uint64(32)
    for first in range(0, k, step):
        rounds = np.arange(first, min(k, first + step), dtype=np.uint64)
        h = mix64(values[None, :] ^ salts[rounds.astype(np.int64)][:, None])
        bins = ((h >> shift) * np.uint64(k)) >> shift
        np.minimum.at(out, bins.ravel().astype(np.int64), ((rounds[:, None] << shift) | (h & low)).ravel())
        if out.max() != _EMPTY:
            return out
    empty = np.flatnonzero(out == _EMPTY)
    step = max(1, 65_536 // len(values))
    for first in range(0, len(empty), step):
        at = empty[first : first + step]
        ranks = (mix64(values[None, :] ^ salts[k + at][:, None]) & low).min(1)
        out[at] = ((k + at).astype(np.uint64) << shift) | ranks
    return out


def band_keys(samples: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band of consecutive samples."""
    rows = samples.reshape(bands, -1)
    with np.errstate(over="ignore"):
        made = mix64(np.arange(1, bands + 1, dtype=np.uint64) * _SPREAD)
        for i in range(rows.shape[1]):
            made = mix64(made * _SPREAD + rows[:, i])
    return made


def odd_sketch(samples: np.ndarray) -> bytes:
    """Each sample flips one of ODD_BITS bits (Mitzenmacher, Pagh and Pham, "Efficient Estimation for High Similarities using Odd Sketches", 2014)."""
    at = (samples >> np.uint64(64 - ODD_BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=ODD_BITS).astype(np.uint8) & 1).tobytes()


def popcounts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Set bits of a XOR b over the last axis (uint64 words)."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def expected_flips(difference: np.ndarray) -> np.ndarray:
    """The mean XOR count of two odd sketches whose samples differ in so many places."""
    return ODD_BITS / 2 * (1 - (1 - 2 / ODD_BITS) ** difference)
