"""Tokenising by pieces: texts are cut where no tokenizer rule looks across,
each different piece of a slice is encoded once, and a bounded cache keeps
pieces between slices.  The ids of a text are the ids of its pieces in order.

``byte_pieces`` cuts for ``public_tokenizers.PATTERN`` (a single space
belongs to what follows it; other white space stands alone), ``word_pieces``
for vocabularies that drop white space.  Both also cut between ASCII
letters, digits and punctuation, but never beside an apostrophe
(contractions) or a byte above 127 (any class).  A text with white space
outside ASCII is one piece for ``byte_pieces``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import textbytes as tb

SLICE = 1 << 20

_CLASS = np.full(256, 3, np.uint8)          # 0: cuts nowhere, 1 letter, 2 digit, 3 punctuation
_CLASS[128:] = 0
_CLASS[39] = 0                              # apostrophe
_CLASS[48:58] = 2
_CLASS[65:91] = 1
_CLASS[97:123] = 1
_CLASS[tb.WHITE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(b: np.ndarray) -> np.ndarray:
    return _LOWER[b]


def _class_cuts(b: np.ndarray) -> np.ndarray:
    """True where a piece starts because the class changes."""
    c = _CLASS[b]
    cut = np.zeros(len(b), bool)
    cut[1:] = (c[1:] != c[:-1]) & (c[1:] != 0) & (c[:-1] != 0)
    return cut


def _wide_white(b: np.ndarray) -> np.ndarray:
    """Positions where white space outside ASCII starts."""
    lead = np.flatnonzero((b == 0xC2) | (b == 0xE1) | (b == 0xE2) | (b == 0xE3))
    if not len(lead):
        return lead
    pad = np.concatenate([b, np.zeros(2, np.uint8)])
    x, y, z = b[lead], pad[lead + 1], pad[lead + 2]
    hit = (x == 0xC2) & ((y == 0x85) | (y == 0xA0))
    hit |= (x == 0xE1) & (y == 0x9A) & (z == 0x80)
    hit |= (x == 0xE2) & (y == 0x80) & ((z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF))
    hit |= (x == 0xE2) & (y == 0x81) & (z == 0x9F)
    hit |= (x == 0xE3) & (y == 0x80) & (z == 0x80)
    return lead[hit]


def byte_pieces(b: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of the pieces of one slice (each ends where the next starts)."""
    n = len(b)
    if not n:
        return np.zeros(0, np.int64)
    white = tb.WHITE[b]
    first = _class_cuts(b)
    at = off[:-1][np.diff(off) > 0]                     # starts of texts that are not empty
    edge = np.zeros(n, bool)
    edge[at] = True
    last = np.zeros(n, bool)
    last[off[1:][np.diff(off) > 0] - 1] = True          # last byte of each text
    # white space begins a piece after a word; a word begins one unless a space is in front
    first[1:] |= white[1:] & ~white[:-1]
    word = np.flatnonzero(~white[1:] & white[:-1] & ~edge[1:]) + 1
    space = b[word - 1] == 32
    first[word[~space]] = True
    # of white space in front of a word the last character stands alone or goes with the word
    first[word - 1] = True
    first |= edge
    odd = _wide_white(b)
    if len(odd):
        for d in np.unique(np.searchsorted(off, odd, "right") - 1):
            first[off[d]:off[d + 1]] = False
            first[off[d]] = True
    return np.flatnonzero(first)


def word_pieces(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces, without white space, and the mask of their bytes."""
    mask = ~tb.WHITE[b]
    start, end = tb.runs(mask, off)
    inner = _class_cuts(b)
    edge = off[:-1][np.diff(off) > 0]
    inner[edge] = False
    cut = np.flatnonzero(inner)
    return np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut])), mask


class PieceCache:
    """Ids of pieces by fingerprint; emptied when it holds ``limit`` pieces."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], limit: int = 800_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(0, np.uint64)               # ascending
        self.slot = np.zeros(0, np.int32)
        self.begin = np.zeros(1, np.int64)              # ids of slot i: pool[begin[i]:begin[i + 1]]
        self.pool = np.zeros(0, np.int32)

    def ids(self, b: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in order, and the number of ids of each piece."""
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(self.key) > self.limit:
            self.clear()
        order = np.argsort(key)
        ranked = key[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        uniq = ranked[new]
        which = np.empty(len(key), np.int64)
        which[order] = np.cumsum(new) - 1
        example = order[new]
        pos = np.searchsorted(self.key, uniq)
        safe = np.minimum(pos, max(len(self.key) - 1, 0))
        known = (self.key[safe] == uniq) if len(self.key) else np.zeros(len(uniq), bool)
        slot = np.zeros(len(uniq), np.int32)
        if known.any():
            slot[known] = self.slot[safe[known]]
        miss = np.flatnonzero(~known)
        if len(miss):
            raw = b.tobytes()
            got = self.encode([raw[s:e] for s, e in zip(start[example[miss]].tolist(), end[example[miss]].tolist())])
            size = np.fromiter(map(len, got), np.int64, len(got))
            slot[miss] = np.arange(len(self.begin) - 1, len(self.begin) - 1 + len(miss))
            self.pool = np.concatenate([self.pool, np.fromiter((i for g in got for i in g), np.int32, int(size.sum()))])
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(size)])
            self.slot = np.insert(self.slot, pos[miss], slot[miss])
            self.key = np.insert(self.key, pos[miss], uniq[miss])
        s = slot[which]
        count = self.begin[s + 1] - self.begin[s]
        return self.pool[spread(self.begin[s], count)], count


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (count[0] of them), then the same for 1, 2, ..."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return shift + np.arange(total)


def _tokenise(cache: PieceCache, b, off, start, end, mask) -> tuple[np.ndarray, np.ndarray]:
    key = tb.run_hash(b, mask, start, end)
    ids, count = cache.ids(b, start, end, key)
    begin = np.concatenate([[0], np.cumsum(count)])
    return ids, begin[np.searchsorted(start, off)]


def byte_ids(cache: PieceCache, b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of one slice and the offsets of its texts in them (byte-level vocabularies)."""
    start = byte_pieces(b, off)
    end = np.append(start[1:], len(b))
    return _tokenise(cache, b, off, start, end, True)


def word_ids(cache: PieceCache, b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for lower-casing vocabularies without white space."""
    b = lower_ascii(b)
    start, end, mask = word_pieces(b, off)
    return _tokenise(cache, b, off, start, end, mask)


def library_encoder(path: str) -> Callable[[list[bytes]], list[list[int]]]:
    """Encoding by the ``tokenizers`` library, without special tokens."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    batch = getattr(tok, "encode_batch_fast", tok.encode_batch)

    def encode(raw: list[bytes]) -> list[list[int]]:
        out = []
        for i in range(0, len(raw), 4096):
            out += [e.ids for e in batch([r.decode("utf-8", "replace") for r in raw[i:i + 4096]], add_special_tokens=False)]
        return out

    return encode


_caches: dict[tuple, PieceCache] = {}


def cache_for(kind: str, path: str, make: Callable[[str], Callable]) -> PieceCache:
    """One cache a worker process and vocabulary file, kept between tasks."""
    if (kind, path) not in _caches:
        _caches.clear()
        _caches[(kind, path)] = PieceCache(make(path))
    return _caches[(kind, path)]
