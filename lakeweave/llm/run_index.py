"""A run-length index over a block of texts, in numpy.

The suffix array gives the Burrows-Wheeler transform; only the heads of its
runs are kept, each with the text position of its suffix, the position of
the suffix before it, and their common prefix.  Inside a run these values
move in step with the text (the suffix one to the right has the same
neighbour one to the right, and one byte less in common), so the samples
answer for every position: ``stream`` walks the text and gives each
position's matching statistic -- length and place of its longest match with
the suffix before it.
"""

from __future__ import annotations

import numpy as np

from .pieces import spread


class RunIndex:
    """Index of ``texts``: concatenated bytes and offsets."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        m = len(off) - 1
        size = np.diff(off)
        n = len(data) + m
        self.begin = off[:-1] + np.arange(m)             # where each text starts among the separators
        # text: separators are different symbols, smaller than all bytes, so no match runs across them
        text = np.empty(n, np.int64)
        text[spread(self.begin, size)] = data.astype(np.int64) + m
        text[self.begin + size] = np.arange(m)
        self.n, self.size = n, size
        longest = int(size.max(initial=0)) + 1
        # ranks by prefixes of 4, 8, 16, ... symbols until all suffixes differ
        bits = int(m + 256).bit_length()
        self.first = 4 if 4 * bits < 63 else 2           # symbols that fit into one number
        key = np.zeros(n, np.int64)
        for i in range(self.first):                      # nothing after the end counts as smallest
            key <<= bits
            if i < n:
                key[:n - i] += text[i:] + 1
        # (a rank is the place of the first suffix with that prefix; only suffixes that still tie are sorted again)
        rank, tied = _places(key, np.zeros(n, np.int64))
        ranks, width = [rank], self.first
        tied = np.flatnonzero(tied)
        while len(tied) and width < longest:
            r = ranks[-1]
            second = np.zeros(len(tied), np.int64)
            inside = tied + width < n
            second[inside] = r[tied[inside] + width] + 1
            place, more = _places(r[tied] * (n + 1) + second, r[tied])
            r = r.copy()
            r[tied] = place
            ranks.append(r)
            tied = tied[more]
            width *= 2
        rank = ranks[-1]
        sa = np.empty(n, np.int64)
        sa[rank] = np.arange(n)
        before = text[sa - 1]                            # the transform (of position 0: the last separator)
        head = np.ones(n, bool)
        head[1:] = before[1:] != before[:-1]
        j = np.flatnonzero(head)
        self.runs = len(j)
        at, other = sa[j], np.where(j > 0, sa[j - 1], 0)
        common = self._common(ranks, text, at, other)
        common[j == 0] = 0
        order = np.argsort(at)
        self.sample, self.neighbour, self.length = at[order], other[order], common[order]

    def _common(self, ranks: list[np.ndarray], text: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common prefixes of suffix pairs, from the ranks of doubled prefixes
        and the last symbols themselves."""
        n, got = len(ranks[0]), np.zeros(len(x), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            a, b = x + got, y + got
            ok = (a < n) & (b < n)
            same = np.zeros(len(x), bool)
            same[ok] = ranks[k][a[ok]] == ranks[k][b[ok]]
            got[same] += self.first << k
        open_ = np.ones(len(x), bool)
        for _ in range(self.first - 1):
            a, b = x + got, y + got
            open_ &= (a < n) & (b < n)
            open_[open_] = text[a[open_]] == text[b[open_]]
            got[open_] += 1
        return got

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """For every position: length of the match, and where the matching suffix starts."""
        t = np.arange(self.n)
        i = np.searchsorted(self.sample, t, "right") - 1
        i = np.maximum(i, 0)
        step = t - self.sample[i]
        return np.maximum(self.length[i] - step, 0), self.neighbour[i] + step

    def classes(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of ``length`` bytes that occur more than once: text number,
        start in the text, and a class that equal windows share."""
        match, other = self.stream()
        linked = np.flatnonzero(match >= length)
        if not len(linked):
            none = np.zeros(0, np.int64)
            return none, none, none
        root = np.arange(self.n)
        root[linked] = other[linked]
        while True:
            new = root[root]
            if (new == root).all():
                break
            root = new
        top = np.zeros(self.n, bool)
        top[linked] = True
        top[root[linked]] = True
        where = np.flatnonzero(top)
        text = np.searchsorted(self.begin, where, "right") - 1
        return text, where - self.begin[text], root[where]


def _places(key: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key among those of its group, plus the group's own place
    (``base``, which orders the keys first); whether other keys equal it."""
    n = len(key)
    order = np.argsort(key)
    ranked, group = key[order], base[order]
    new = np.ones(n + 1, bool)
    new[1:-1] = ranked[1:] != ranked[:-1]
    start = np.ones(n, bool)
    start[1:] = group[1:] != group[:-1]
    at = np.arange(n)
    place = np.empty(n, np.int64)
    place[order] = group + np.maximum.accumulate(np.where(new[:-1], at, 0)) - np.maximum.accumulate(np.where(start, at, 0))
    tied = np.empty(n, bool)
    tied[order] = ~(new[:-1] & new[1:])
    return place, tied
