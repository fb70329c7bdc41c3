"""Vectorised text primitives shared by the operators.

Spark partitions the rows; inside a task each Arrow batch is viewed as one
byte buffer with document offsets, cut into slices of about ``SLICE``
bytes, and words, windows and fingerprints are computed with numpy over a
whole slice.  Nothing here keeps state beyond one slice, so memory follows
the largest single text, never the partition.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D; all of these
are ASCII, so runs never cut a UTF-8 character.  Fingerprints are 64-bit:
``sum(TABLE[byte] * B^i)`` modulo 2^64, shifted back to the start of the
string and mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
TABLE = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_pow = {"n": 0, "p": None, "inv": None}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``B^i`` and ``B^-i`` for i < n (grown on demand, shared by all calls)."""
    if _pow["n"] < n:
        size = max(n, SLICE + SLICE // 4)
        for name, base in (("p", _BASE), ("inv", _BASE_INV)):
            a = np.full(size, base, U)
            a[0] = 1
            _pow[name] = np.cumprod(a)
        _pow["n"] = size
    return _pow["p"][:n], _pow["inv"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (avalanche of all bits)."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def flat(col) -> tuple[np.ndarray, np.ndarray]:
    """String or binary Arrow column -> (bytes, offsets); nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, o, d = col.buffers()
    off = np.frombuffer(o, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(d, np.uint8) if d is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(data: np.ndarray, off: np.ndarray, target: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first document, bytes, offsets)`` for runs of whole documents of about ``target`` bytes."""
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + target, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True that do not cross document offsets."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    cut = off[(off > 0) & (off < n)]
    first[cut] = mask[cut]
    last[cut - 1] = mask[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def run_hash(b: np.ndarray, mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``mask`` given by ``runs``."""
    if not len(starts):
        return np.zeros(0, U)
    p, inv = powers(len(b))
    v = TABLE[b]
    v *= p
    v *= mask
    return mix(np.add.reduceat(v, starts) * inv[starts] + (ends - starts).astype(U))


class Words:
    """Words of one slice: ``start``, ``end`` (bytes), ``hash``, and ``at``: the
    first word of each document (one entry more than documents)."""

    def __init__(self, b: np.ndarray, off: np.ndarray, hashes: bool = True):
        mask = ~WHITE[b]
        self.mask = mask
        self.start, self.end = runs(mask, off)
        self.hash = run_hash(b, mask, self.start, self.end) if hashes else None
        self.at = np.searchsorted(self.start, off)
        self.doc = np.repeat(np.arange(len(off) - 1), np.diff(self.at))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k-word shingles of each document: ``(hash, document, first word)``.
    A document of 1 to k - 1 words has one shingle of all its words; a
    document without words has none."""
    n = len(words.hash)
    out = np.zeros(n, U)
    left = words.at[1:][words.doc] - np.arange(n)          # words from here to the document's end
    for j in range(k):
        step = np.zeros(n, U)
        step[:max(n - j, 0)] = words.hash[j:] * U(_BASE_INV ^ (2 * j * 0x51ED270B))
        out += np.where(left > j, mix(step ^ U(j + 1)), U(0))
    count = np.diff(words.at)
    keep = (left >= k) | ((count[words.doc] < k) & (np.arange(n) == words.at[:-1][words.doc]))
    first = np.flatnonzero(keep)
    return mix(out[first]), words.doc[first], first


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def per_doc_sum(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive entries of ``at``."""
    c = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return c[at[1:]] - c[at[:-1]]
