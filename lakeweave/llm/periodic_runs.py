"""Operator 13: periodic runs by recompression.

A run is a stretch of words with smallest period q (words q apart are equal),
at least ``min_length`` words and ``min_exponent`` periods long, that neither
neighbouring word extends with the same period.

Recompression (Jez, "Recompression: a simple and powerful technique for word
equations", 2013) turns a sequence into a run-length grammar by alternating
two steps: blocks of one symbol become one symbol (block compression), then,
with the symbols split into left and right ones, every left symbol that is
followed by a right one is joined with it (pair compression).  Both steps
look at neighbours only, so equal stretches are parsed alike away from their
ends, and the longest common extension of two positions is found by climbing
the levels while symbols agree and descending where they differ (I, "Longest
common extensions with recompression", 2017).  No suffix array is built.

Candidates lie on a harmonic grid: for every period q the positions 0, 2q,
4q, ...  A run of three periods or more covers such a position x together
with x + q, so extending (x, x + q) to both sides gives the whole run; there
are about (n / 2) ln(n / 3) candidates for n words.

Scale: documents are independent and nothing is shuffled.  A task works on
slices of whole documents of about 1 MB with one grammar a slice (documents
are kept apart by symbols that occur once); candidates are made in chunks, so
memory follows the longest single text.  Word names are exact (dictionary
encoding), not hashes.

Defined cases: a null or empty text, or one without words, has no words and
no runs, and collapses to the empty text.  Repeated rows and equal texts get
equal results, row by row; ids may be null or repeated.  An empty table gives
an empty result.  Columns other than the id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import fields, on_text, read

MIN_LENGTH = 24
MIN_EXPONENT = 3
CHUNK = 1 << 20          # candidates looked at together


# --- the grammar -------------------------------------------------------------

@dataclass
class Level:
    """Symbols of one level.  ``up[i]`` is the symbol of the next level that
    covers symbol i, ``first[k]`` the first symbol that symbol k of the next
    level covers (one entry more than symbols); both None at the top.
    ``block``: the next level is one of blocks, not of pairs."""

    sym: np.ndarray
    up: np.ndarray | None = None
    first: np.ndarray | None = None
    block: bool = False


def _name(sym: np.ndarray, first: np.ndarray, big: np.ndarray, key: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """Names of the next level: joined symbols (``big``) are named by their
    key, others keep their name."""
    out = sym[first]
    names, which = np.unique(key, return_inverse=True)
    out[big] = (fresh + which).astype(np.int32)
    return out, fresh + len(names)


def recompress(seq: np.ndarray) -> list[Level]:
    """Levels of the grammar of ``seq`` up to one without two equal symbols.
    The first and the last symbol must occur only once."""
    levels, cur = [Level(seq.astype(np.int32))], seq.astype(np.int32)
    fresh, turn = int(cur.max(initial=0)) + 1, 0

    def cover(first: np.ndarray, block: bool) -> None:
        start = np.zeros(len(cur), np.int32)
        start[first[1:]] = 1
        levels[-1].up = np.cumsum(start, dtype=np.int32)
        levels[-1].first = np.append(first, len(cur)).astype(np.int32)
        levels[-1].block = block

    while len(np.unique(cur)) < len(cur):
        new = np.flatnonzero(cur[1:] != cur[:-1]) + 1
        if len(new) + 1 < len(cur):
            first = np.concatenate([[0], new])
            size = np.diff(np.append(first, len(cur)))
            big = np.flatnonzero(size > 1)
            key = cur[first[big]].astype(np.int64) << 32 | size[big]
            cover(first, True)
            cur, fresh = _name(cur, first, big, key, fresh)
            levels.append(Level(cur))
        turn += 1
        right = (tb.mix(cur.astype(tb.U) + tb.U(turn * 0x9E3779B97F4A7C15 & (1 << 63) - 1)) & tb.U(1)).astype(bool)
        ahead, back = ~right[:-1] & right[1:], right[:-1] & ~right[1:]
        joined = np.flatnonzero(ahead if ahead.sum() >= back.sum() else back)
        if len(joined):
            keep = np.ones(len(cur), bool)
            keep[joined + 1] = False
            first = np.flatnonzero(keep)
            big = np.searchsorted(first, joined)
            key = cur[joined].astype(np.int64) << 32 | cur[joined + 1]
            cover(first, False)
            cur, fresh = _name(cur, first, big, key, fresh)
            levels.append(Level(cur))
    return levels


def extend(levels: list[Level], x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
    """For each pair of positions, how many symbols agree from there on
    (``back``: how many before there).  x and y differ everywhere."""
    out = np.zeros(len(x), np.int64)
    b = 1 if back else 0
    i, j, who = x.copy(), y.copy(), np.arange(len(x))
    parked: list[tuple] = []
    for lv in levels:                                     # climb while symbols agree
        same = lv.sym[i - b] == lv.sym[j - b]
        stay = [(i[~same], j[~same], who[~same])]
        i, j, who = i[same], j[same], who[same]
        if len(who):
            ci, cj = lv.up[i - b], lv.up[j - b]
            if back:
                ri, rj = i - lv.first[ci], j - lv.first[cj]
                even = (lv.first[ci + 1] == i) & (lv.first[cj + 1] == j)
            else:
                ri, rj = lv.first[ci + 1] - i, lv.first[cj + 1] - j
                even = (lv.first[ci] == i) & (lv.first[cj] == j)
            # up to where both are at an end of a symbol of the next level; blocks of unequal rests differ there
            m = np.where(even, 0, np.minimum(ri, rj))
            odd = ~even & (ri != rj)
            m = -m if back else m
            stay.append(((i + m)[odd], (j + m)[odd], who[odd]))
            go, step = ~odd, (even if back else ~even).astype(np.int64)
            i, j, who = (ci + step)[go], (cj + step)[go], who[go]
        parked.append(tuple(np.concatenate(c) for c in zip(*stay)))
        if not len(who):
            break
    i, j, who = parked[-1]
    for t in range(len(parked) - 1, 0, -1):               # descend to where they differ
        lv = levels[t - 1]
        p, q = lv.first[i], lv.first[j]
        same = lv.sym[p - b] == lv.sym[q - b]
        if lv.block:
            sp, sq = (p - lv.first[i - 1], q - lv.first[j - 1]) if back else (lv.first[i + 1] - p, lv.first[j + 1] - q)
            step = np.where(same, np.minimum(sp, sq), 0)
        else:
            step = same.astype(np.int64)
        step = -step if back else step
        i, j, who = (np.concatenate(c) for c in zip((p + step, q + step, who), parked[t - 1]))
    out[who] = np.abs(i - x[who])
    return out


# --- runs --------------------------------------------------------------------

def candidates(n_words: np.ndarray, at: np.ndarray, min_length: int, min_exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of (position, period) on the harmonic grids of all documents;
    positions count over the slice's words."""
    top = np.where(n_words >= min_length, n_words // min_exponent, 0)
    doc = np.repeat(np.arange(len(n_words)), top)
    q = np.arange(len(doc)) - np.repeat(np.cumsum(top) - top, top) + 1
    step = (min_exponent - 1) * q
    count = (n_words[doc] - 1 - q) // step + 1
    ends, lo = np.cumsum(count), 0
    while lo < len(doc):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK, "right")))
        c = count[lo:hi]
        k = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        yield np.repeat(at[doc[lo:hi]], c) + k * np.repeat(step[lo:hi], c), np.repeat(q[lo:hi], c)
        lo = hi


def find_runs(ids: np.ndarray, at: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of every run, by document, start and
    period; starts count within the document.  ``ids`` names the words of all
    documents, ``at`` their first words (one entry more than documents)."""
    n_words = np.diff(at)
    n_doc = len(n_words)
    if not len(ids) or n_words.max() < min_length:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    doc_of = np.repeat(np.arange(n_doc), n_words)
    place = np.arange(len(ids)) + doc_of + 1              # a separator before every document and at the end
    seq = np.empty(len(ids) + n_doc + 1, np.int64)
    seq[place] = ids
    seq[at + np.arange(n_doc + 1)] = int(ids.max()) + 1 + np.arange(n_doc + 1)
    levels = recompress(seq)
    found = [np.zeros((3, 0), np.int64)]
    for x, q in candidates(n_words, at, min_length, min_exponent):
        hit = ids[x] == ids[x + q]
        x, q = x[hit], q[hit]
        p = place[x]
        ahead, behind = extend(levels, p, p + q), extend(levels, p, p + q, back=True)
        length = ahead + behind + q
        ok = length >= np.maximum(min_length, min_exponent * q)
        found.append(np.stack([(x - behind)[ok], length[ok], q[ok]]))
    start, length, q = np.concatenate(found, axis=1)
    # a stretch is found for its smallest period and for multiples of it
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[first], length[first], q[first]
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    doc = doc_of[start] if len(start) else start
    return doc, start - at[doc], length, q


def joined_words(b: np.ndarray, words: tb.Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of each document's kept words, joined by one space."""
    n_doc = len(words.at) - 1
    start, size, doc = words.start[keep], (words.end - words.start)[keep] + 1, words.doc[keep]
    last = np.ones(len(doc), bool)
    last[:-1] = doc[1:] != doc[:-1]
    size[last] -= 1                                       # no space after a document's last word
    ends = np.cumsum(size)
    src = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
    out = b[np.minimum(src, len(b) - 1)] if len(src) else np.zeros(0, np.uint8)
    out[(ends - 1)[~last]] = 0x20
    off = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=size, minlength=n_doc).astype(np.int64))])
    return out, off


def _names(b: np.ndarray, words: tb.Words) -> np.ndarray:
    """A number for every word, equal for equal words."""
    size = words.end - words.start
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    array = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(off), pa.py_buffer(b[words.mask])])
    return array.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


OUT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``doc_id, n_words``, the ``runs`` of each row's words (by start, then
    period) and ``collapsed``: the words that no run contains after its first
    period, joined by one space.  ``min_exponent`` is 2 or more."""
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 or more")
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batch):
        data, offsets = tb.flat(batch.column(1))
        for i, b, off in tb.slices(data, offsets):
            words = tb.Words(b, off, hashes=False)
            n = len(words.start)
            doc, start, length, period = find_runs(_names(b, words), words.at, min_length, min_exponent)
            cover = np.zeros(n + 1, np.int64)
            np.add.at(cover, words.at[doc] + start + period, 1)
            np.add.at(cover, words.at[doc] + start + length, -1)
            text, ends = joined_words(b, words, np.cumsum(cover)[:n] == 0)
            n_doc = len(off) - 1
            per_doc = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_doc))]).astype(np.int32)
            rows = pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in (start, length, period)],
                                              names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, n_doc), pa.array(np.diff(words.at).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(per_doc), rows),
                 pa.Array.from_buffers(pa.string(), n_doc, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text)])],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return on_text(src, run, fields(OUT))


# --- the query ---------------------------------------------------------------

def planted(doc_id: Column, text: Column) -> Column:
    """The contract's text: with h the crc32 of the decimal id and g = h // 10,
    one document in ten repeats, from word a = g % n on, the p words there.
    A document without an id keeps its text."""
    h = F.crc32(doc_id.cast("long").cast("string").cast("binary"))
    g = F.floor(h / F.lit(10))
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1))               # texts without words are left as they are
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % F.lit(8)))).cast("int")
    block = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    again = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(block), F.lit(1), n - a)), " ")
    return F.when((h % F.lit(10) == 0) & (F.size(words) > 0), again).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    out = periodic_runs(docs)

    def stronger(x: Column, y: Column) -> Column:
        """Greater length / period first, exactly; then smaller start, then period."""
        left, right = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(left != right, F.when(left > right, -1).otherwise(1))
                .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
                .when(x["period"] != y["period"], F.when(x["period"] < y["period"], -1).otherwise(1)).otherwise(0))

    best = F.get(F.array_sort("runs", stronger), F.lit(0))
    milli = F.lit(1000) * best["length"]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        ((milli - milli % best["period"]) / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
