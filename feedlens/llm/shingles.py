"""Word shingles and their MinHash signatures as numpy arrays.

A word maps to a 64-bit id, a shingle to a 64-bit mix of its word ids.  Two
different shingles share a 64-bit value with probability 2**-64, so sizes
and intersections of the value sets are those of the shingle sets.
"""

from __future__ import annotations

import numpy as np
import xxhash

_P = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S1, _S2, _S3 = np.uint64(30), np.uint64(27), np.uint64(31)


class WordIds(dict):
    """Cache word -> 64-bit id.  Bounded: emptied when full, which changes
    nothing but speed."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        self[word] = h
        return h


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S1)) * _MIX1
    x = (x ^ (x >> _S2)) * _MIX2
    return x ^ (x >> _S3)


def shingle_set(words: list[bytes], width: int, ids: WordIds) -> np.ndarray:
    """Sorted distinct shingle values; a text with fewer than ``width`` words
    has its whole sequence as one shingle, a text without words none."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(ids.__getitem__, words), np.uint64, n)
    width = min(width, n)
    m = n - width + 1
    h = np.full(m, np.uint64(width))
    for i in range(width):
        h = mix(h * _P + w[i:i + m])
    return np.unique(h)


def hash_family(k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``k`` universal hash functions ``a * x + b mod 2**64`` with odd a."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, k, dtype=np.uint64)


def minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the set, in blocks that stay in the
    CPU cache whatever the size of the set."""
    out = np.full(len(a), np.uint64(2**64 - 1))
    for i in range(0, len(values), 256):
        block = values[i:i + 256, None] * a
        block += b
        np.minimum(out, block.min(axis=0), out=out)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` minima (as int64)."""
    bands = len(signature) // rows
    parts = signature[:bands * rows].reshape(bands, rows)
    h = mix(np.arange(1, bands + 1, dtype=np.uint64) * _P)
    for i in range(rows):
        h = mix(h * _P + parts[:, i])
    return h.view(np.int64)


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())
