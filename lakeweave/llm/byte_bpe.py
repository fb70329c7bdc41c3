"""Operator 4: byte-level BPE encoding and decoding.

A pre-token that is no vocabulary entry is merged with a hierarchical-bitmap
rank queue: every neighbouring pair waits in the bucket of its merge rank as
a linked-list position; three levels of 32-bit words say which buckets are
in use, so the next rank is found by three find-first-set steps; entries
whose pair has changed meanwhile are stale and skipped.  The work is
O(n log n) for a pre-token of n bytes, so megabytes without a break are fine.

Scale: one pass without a shuffle; ranks come from a vocabulary file named
by a parameter (``path``), which every executor must see.  Memory follows
the largest single text.

Defined cases: a null text is an empty one and has no ids; any text decodes
to its own bytes.  Equal texts get equal ids, row by row; ids of rows may be
null or repeated.  An empty table gives an empty result.  Only the id and
text columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pieces
from . import textbytes as tb
from .common import fields, on_text, read

VOCABULARY = "byte_bpe_50k.tiktoken"


_BIT = [1 << i for i in range(32)]



class Codec:
    def __init__(self, path: str, pattern: str | None = None):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern or public_tokenizers.PATTERN).findall
        size = max(self.ranks.values()) + 1
        self.low = [0] * (size // 32 + 1)
        self.mid = [0] * (size // 1024 + 1)
        self.bucket: dict[int, int | list[int]] = {}
        entry = [b""] * size
        for t, r in self.ranks.items():
            entry[r] = t
        self.token_bytes = np.frombuffer(b"".join(entry), np.uint8)
        self.token_begin = np.concatenate([[0], np.cumsum([len(t) for t in entry])]).astype(np.int64)

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one pre-token.

        ``bucket[r]`` holds the positions whose pair has rank r (one number,
        or a heap when several wait); ``low``, ``mid`` and ``top`` are the
        bitmaps of buckets, words of low and words of mid in use.  All are
        empty again when the pre-token is done.
        """
        ranks = self.ranks
        whole = ranks.get(raw)
        if whole is not None:
            return [whole]
        n, get = len(raw), ranks.get
        low, mid, bucket, bit, top = self.low, self.mid, self.bucket, _BIT, 0
        after = list(range(1, n + 1))                    # start of the next part
        before = list(range(-1, n - 1))
        wait = [get(raw[i:i + 2], -1) for i in range(n - 1)]     # rank a part's pair with the next waits under
        wait.append(-1)
        new = [i for i in range(n - 1) if wait[i] >= 0]
        while True:
            for i in new:
                r = wait[i]
                there = bucket.get(r)
                if there is None:
                    bucket[r] = i
                    j = r >> 5
                    k = r >> 10
                    low[j] |= bit[r & 31]
                    mid[k] |= bit[j & 31]
                    top |= 1 << k
                elif there.__class__ is list:
                    heappush(there, i)
                else:
                    bucket[r] = [there, i] if there < i else [i, there]
            if not top:
                break
            k = (top & -top).bit_length() - 1            # find first set, three times
            w = mid[k]
            j = (k << 5) + (w & -w).bit_length() - 1
            w = low[j]
            rank = (j << 5) + (w & -w).bit_length() - 1
            there = bucket[rank]
            if there.__class__ is list and len(there) > 1:
                i = heappop(there)
            else:
                i = there[0] if there.__class__ is list else there
                del bucket[rank]
                low[j] = w = w & (w - 1)
                if not w:
                    mid[k] = w = mid[k] & (mid[k] - 1)
                    if not w:
                        top &= top - 1
            new = []
            if wait[i] != rank:
                continue                                 # stale
            gone = after[i]
            nxt = after[gone]
            after[i] = nxt
            wait[gone] = -1
            if nxt < n:
                before[nxt] = i
                wait[i] = r = get(raw[i:after[nxt]], -1)
                if r >= 0:
                    new.append(i)
            else:
                wait[i] = -1
            p = before[i]
            if p >= 0:
                r = get(raw[p:nxt], -1)
                if wait[p] != r:
                    wait[p] = r
                    if r >= 0:
                        new.append(p)
        out, i = [], 0
        while i < n:
            j = after[i]
            out.append(ranks[raw[i:j]])
            i = j
        return out

    def encode_pieces(self, raw: list[bytes]) -> list[list[int]]:
        out = []
        for r in raw:
            if r.isalpha() or (r[:1] == b" " and r[1:].isalpha()):       # one pre-token
                out.append(self.merge(r))
                continue
            ids: list[int] = []
            for t in self.split(r.decode("utf-8", "replace")):
                ids += self.merge(t.encode())
            out.append(ids)
        return out

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, and the offsets of the texts in them."""
        count = self.token_begin[ids + 1] - self.token_begin[ids]
        begin = np.concatenate([[0], np.cumsum(count)])
        return self.token_bytes[pieces.spread(self.token_begin[ids], count)], begin[off]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def per_slice(df: DataFrame, path: str, finish, schema, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every row's whole text and hands each slice to ``finish(ids of
    rows, token ids, offsets)``, which gives the columns of ``schema``."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batch):
        cache = pieces.cache_for("own", path, lambda p: codec(p).encode_pieces)
        data, off = tb.flat(batch.column(1))
        for i, b, o in tb.slices(data, off, pieces.SLICE):
            ids, begin = pieces.byte_ids(cache, b, o)
            yield pa.RecordBatch.from_arrays(finish(batch.column(0).slice(i, len(o) - 1), ids, begin), names=schema.names)

    return on_text(src, run, schema)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of each row's whole text."""
    return per_slice(df, path, lambda rows, ids, begin: [
        rows, pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids))],
        fields("doc_id long, ids array<int>"), id_col, text_col)


def list_parts(col) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of an Arrow list column without nulls."""
    off = col.offsets.to_numpy().astype(np.int64)
    return col.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]].astype(np.int64), off - off[0]


def decode(df: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` as ``encode`` gives them, and ``decoded`` (binary)."""

    def run(batch):
        ids, off = list_parts(batch.column(1))
        step = max(1, int(pieces.SLICE // 4 // max(1, len(ids) // max(1, len(off) - 1))))
        for i in range(0, len(off) - 1, step):
            o = off[i:i + step + 1]
            data, begin = codec(path).decode(ids[o[0]:o[-1]], o - o[0])
            raw = pa.Array.from_buffers(pa.large_binary(), len(o) - 1,
                                        [None, pa.py_buffer(begin.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(o) - 1), batch.column(1).slice(i, len(o) - 1),
                                              raw.cast(pa.binary())], names=["doc_id", "ids", "decoded"])

    return on_text(df.select("doc_id", "ids"), run, fields("doc_id long, ids array<int>, decoded binary"))


@lru_cache(maxsize=2)
def _decimal(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each id as decimal text after a space, and where those texts begin."""
    texts = [b" %d" % i for i in range(size)]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def id_digests(ids: np.ndarray, off: np.ndarray, size: int) -> list[str]:
    """sha256 of the decimal ids of each text joined by one space."""
    chars, begin = _decimal(size)
    count = begin[ids + 1] - begin[ids]
    at = np.concatenate([[0], np.cumsum(count)])[off]
    joined = chars[pieces.spread(begin[ids], count)].tobytes()
    return [hashlib.sha256(joined[s + 1:e]).hexdigest() for s, e in zip(at[:-1].tolist(), at[1:].tolist())]


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)

    def digests(rows, ids, begin):
        ids = ids.astype(np.int64)
        data, at = codec(path).decode(ids, begin)
        raw = memoryview(data.tobytes())
        back = [hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
        sha = id_digests(ids, begin, len(codec(path).token_begin) - 1)
        return [rows, pa.array(np.diff(begin)), pa.array(sha, pa.string()), pa.array(back, pa.string())]

    return per_slice(read(spark, sf_dir, "documents"), path, digests,
                     fields("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
