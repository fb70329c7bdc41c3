"""Operator 8: packing token sequences by non-negative least squares.

A document of n tokens is cut into n // W whole windows and one remainder.
Whole windows are sequences by themselves.  The lengths of the remainders
are a histogram of at most W - 1 numbers: shallow combinations of two or
three lengths that fill a window exactly are enumerated, their repeat
counts are solved against the histogram by non-negative least squares and
rounded down, and what is left is packed greedily, the same combination as
often as its lengths last.

Scale: texts are read once and nothing of them is shuffled; per document
only its token count and the checksums of its pieces go on.  The driver
sees the histogram (fewer than W rows) and the combinations in use (at most
``COMBINATIONS``, plus 2 W for the rest), whatever the corpus size.
Remainders of one length are numbered through ranges of a hash, so a length
shared by a third of all documents is spread over many tasks.

Defined cases: a null text is empty; a document always has at least its end
id.  Repeated rows and repeated or null ids are packed row by row.  An empty
table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pieces
from . import textbytes as tb
from .common import fields, on_text, ranked, read, staged

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 1024
END_ID = 0


def cut(df: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``doc_tokens`` (with the end id) and ``crcs``: the checksum
    of each window of the document's ids, the last one shorter."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batch):
        cache = pieces.cache_for("library", path, pieces.library_encoder)
        data, off = tb.flat(batch.column(1))
        for i, b, o in tb.slices(data, off, pieces.SLICE):
            ids, begin = pieces.byte_ids(cache, b, o)
            n = len(o) - 1
            ids = np.insert(ids, begin[1:], end_id).astype("<u4")
            begin = begin + np.arange(n + 1)
            raw = memoryview(ids.tobytes())
            crcs = [[zlib.crc32(raw[4 * x:4 * min(x + window, e)]) for x in range(s, e, window)]
                    for s, e in zip(begin[:-1].tolist(), begin[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, n), pa.array(np.diff(begin)), pa.array(crcs, pa.list_(pa.int64()))],
                names=["doc_id", "doc_tokens", "crcs"])

    return on_text(src, run, fields("doc_id long, doc_tokens long, crcs array<long>"))


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c >= 0, of present lengths (c = 0: a pair) that fill the window."""
    have = np.zeros(window + 1, bool)
    have[present] = True
    b = present[present <= window // 2]
    pairs = np.stack([window - b, b, np.zeros_like(b)], 1)
    pairs = pairs[have[pairs[:, 0]]]
    x, y = np.meshgrid(present, present, indexing="ij")
    z = window - x - y
    ok = (z >= 1) & (z <= y) & (y <= x)
    ok[ok] = have[z[ok]]
    return np.concatenate([pairs, np.stack([x[ok], y[ok], z[ok]], 1)])


COMBINATIONS = WINDOW // 2 + (WINDOW ** 2) // 12 + WINDOW      # of pairs and triples at most


def solve(combo: np.ndarray, count: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 that brings the lengths used by x combinations near ``count`` in
    least squares (accelerated projected gradient; a combination touches at
    most three rows, so a round costs three passes over the combinations)."""
    m = len(combo)
    if not m:
        return np.zeros(0)
    scale = max(count.max(), 1)
    h = count / scale
    use = combo.T                                        # row 0 of the histogram stands for "no third length"

    def forward(x):
        y = sum(np.bincount(u, x, minlength=len(h)) for u in use)
        y[0] = 0
        return y

    def back(r):
        r = r.copy()
        r[0] = 0
        return sum(r[u] for u in use)

    step = 1 / max(back(forward(np.ones(m))).max(), 1e-9)       # row sums bound the largest eigenvalue
    x = z = np.zeros(m)
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(z - step * back(forward(z) - h), 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t2 * (new - x)
        if ((new - x) * (x - z)).sum() > 0:              # overshooting: restart the momentum
            t2, z = 1.0, new
        x, t = new, t2
    return x * scale


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[list[int], int]]:
    """(lengths of one sequence, how many such sequences); uses each remainder once."""
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        if 0 < length < window:
            left[length] = n
    combo = combinations(np.flatnonzero(left), window)
    x = solve(combo, left.astype(float))
    out: list[tuple[list[int], int]] = []
    for i in np.argsort(-x, kind="stable"):
        n = int(x[i])
        if n < 1:
            break
        lengths = [int(v) for v in combo[i] if v]
        n = min(n, *(int(left[v]) // lengths.count(v) for v in lengths))
        if n > 0:
            out.append((lengths, n))
            for v in lengths:
                left[v] -= n
    while True:                                          # each turn uses up a length, or all but a part of a sequence of it
        there = np.flatnonzero(left)
        if not len(there):
            return out
        free, lengths, taken = window, [], {}
        while True:
            fit = there[(there <= free) & (left[there] > [taken.get(int(v), 0) for v in there])]
            if not len(fit):
                break
            v = int(fit[-1])
            k = min(free // v, int(left[v]) - taken.get(v, 0))
            lengths += [v] * k
            taken[v] = taken.get(v, 0) + k
            free -= v * k
        n = min(int(left[v]) // k for v, k in taken.items())
        out.append((lengths, n))
        for v, k in taken.items():
            left[v] -= n * k


class Slots:
    """Where the r-th remainder of each length goes."""

    def __init__(self, made: list[tuple[list[int], int]], window: int):
        entries, base = [], 0
        for lengths, n in made:
            at = 0
            for v in lengths:
                entries.append((v, n, base, at))
                at += v
            base += n
        self.sequences = base
        e = np.array(sorted(entries, key=lambda t: (t[0], t[2], t[3])) or np.zeros((0, 4)), np.int64).reshape(-1, 4)
        first = np.cumsum(e[:, 1]) - e[:, 1]
        self.length_at = np.searchsorted(e[:, 0], np.arange(window + 1))
        self.first, self.base, self.offset = first, e[:, 2], e[:, 3]

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset."""
        if not len(length):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        r = self.first[self.length_at[length]] + rank
        i = np.searchsorted(self.first, r, "right") - 1
        return self.base[i] + r - self.first[i], self.offset[i]


def pack(lengths: DataFrame, window: int = WINDOW) -> DataFrame:
    """Places the pieces of ``doc_id, doc_tokens, crcs``; one row a piece."""
    spark = lengths.sparkSession
    rows = lengths.select("doc_id", "doc_tokens", "crcs", (F.col("doc_tokens") % window).cast("int").alias("rest"),
                          F.floor(F.col("doc_tokens") / window).cast("long").alias("whole"))
    histogram = {r["rest"]: r["count"] for r in rows.groupBy("rest").count().collect()}
    slots = Slots(plan(histogram, window), window)
    shared = spark.sparkContext.broadcast(slots)
    u = F.pmod(F.xxhash64("doc_id", "crcs"), F.lit(1 << 30)) / float(1 << 30)
    # a remainder of 0 only needs the running total of whole windows
    numbered = ranked(rows, ["rest"], u, ["doc_id", "doc_tokens", "crcs"], "rank", sums={"whole": "whole_before"})

    def run(batch):
        s = shared.value
        c = {k: batch.column(i) for i, k in enumerate(batch.schema.names)}
        total, rest, whole, rank, before = (c[k].to_numpy().astype(np.int64) for k in
                                            ("doc_tokens", "rest", "whole", "rank", "whole_before"))
        n = whole + (rest > 0)
        row = np.repeat(np.arange(len(n)), n)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        last = piece >= whole[row]
        sequence = s.sequences + before[row] + piece
        offset = np.zeros(len(row), np.int64)
        sequence[last], offset[last] = s.find(rest[row[last]], rank[row[last]])
        yield pa.RecordBatch.from_arrays(
            [c["doc_id"].take(pa.array(row)), pa.array(piece * window), pa.array(np.where(last, rest[row], window)),
             c["crcs"].flatten().cast(pa.int64()), pa.array(total[row]), pa.array(sequence), pa.array(offset)],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return on_text(numbered, run, fields("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                         "sequence_id long, offset long"))


def packed(docs: DataFrame) -> DataFrame:
    return pack(staged(cut(docs, public_tokenizers.path(VOCABULARY)), "cut"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))
