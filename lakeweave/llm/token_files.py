"""Operator 9: token files of directly addressable codes.

An id is split into chunks of ``CHUNK_BITS`` bits.  Level 0 holds the lowest
chunk of every id and a bitmap that says which ids go on; level 1 the next
chunk of those, and so on.  A directory of the bitmap's ones at every
``DIRECTORY`` bits turns a position of one level into that of the next, so
any token is read without decoding its neighbours.

A file image holds the ids of neighbouring documents: a header, the
documents' ids and starts, then the levels.  Images are rows of a Parquet
folder (columns part, image, n_ids, payload): Spark's commit protocol makes
lost executors and repeated tasks harmless, and any store Spark reaches
will do.

Scale: documents are range-partitioned by id (one shuffle of the texts),
each task tokenises its range and writes images of about ``IMAGE_IDS`` ids,
each with its start in its part.  Only the parts' totals -- a row a
partition -- are added up and broadcast when reading.

Defined cases: a null text has only the end id; null ids come first;
documents with equal ids follow each other in the order of their texts.  An
empty table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch
from . import pieces
from . import textbytes as tb
from .common import fields, read, ship, trimmed

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
CHUNK_BITS = 8
DIRECTORY = 512
IMAGE_IDS = 1 << 20
MAGIC = b"DAC1"
_HEAD = struct.Struct("<4sIQQQI")            # magic, levels, start in part, ids, documents, bytes of null flags
_COUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def image(start: int, doc_ids: np.ndarray, null: np.ndarray, begin: np.ndarray, ids: np.ndarray) -> bytes:
    """A file image: ``begin`` has one entry more than there are documents."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        more = rest >> np.uint64(CHUNK_BITS)
        flags = more > 0
        bits = np.packbits(flags, bitorder="little")
        blocks = np.add.reduceat(_COUNT[bits], np.arange(0, len(bits), DIRECTORY // 8), dtype=np.uint64) if len(bits) else np.zeros(0, np.uint64)
        directory = np.concatenate([np.zeros(1, np.uint64), np.cumsum(blocks, dtype=np.uint64)])
        levels.append(struct.pack("<Q", len(rest)) + (rest & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8).tobytes()
                      + bits.tobytes() + directory.astype("<u8").tobytes())
        rest = more[flags]
        if not len(rest):
            break
    nulls = np.packbits(null, bitorder="little").tobytes()
    return b"".join([_HEAD.pack(MAGIC, len(levels), start, len(ids), len(doc_ids), len(nulls)), nulls,
                     doc_ids.astype("<i8").tobytes(), begin.astype("<u8").tobytes(), *levels])


class TokenFile:
    """Random access to one image."""

    def __init__(self, raw: bytes):
        magic, levels, self.start, self.n, docs, nulls = _HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = _HEAD.size

        def take(dtype, n):
            nonlocal at
            a = np.frombuffer(raw, dtype, n, at)
            at += a.nbytes
            return a

        self.null = np.unpackbits(take(np.uint8, nulls), count=docs, bitorder="little").astype(bool)
        self.doc_ids = take("<i8", docs)
        self.begin = take("<u8", docs + 1).astype(np.int64)
        self.levels = []
        for _ in range(levels):
            n = int(take("<u8", 1)[0])
            chunk, bits = take(np.uint8, n), take(np.uint8, -(-n // 8))
            self.levels.append((chunk, bits, take("<u8", -(-len(bits) // (DIRECTORY // 8)) + 1).astype(np.int64)))

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a level's bitmap before each position: directory, then the bytes of its block."""
        _, bits, directory = self.levels[level]
        byte, block = at >> 3, at // DIRECTORY
        out = directory[block] + _COUNT[bits[byte] & ((1 << (at & 7)) - 1).astype(np.uint8)]
        first = block * (DIRECTORY // 8)
        for k in range(DIRECTORY // 8 - 1):
            inside = first + k < byte
            if not inside.any():
                break
            out[inside] += _COUNT[bits[first[inside] + k]]
        return out

    def get(self, at) -> np.ndarray:
        """The tokens at any positions of this file."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        out, todo = np.zeros(len(at), np.int64), np.arange(len(at))
        for level, (chunk, bits, _) in enumerate(self.levels):
            out[todo] |= chunk[at].astype(np.int64) << (CHUNK_BITS * level)
            more = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            if not more.any():
                break
            todo, at = todo[more], self._rank(level, at[more])
        return out

    def run(self, i: int, j: int) -> np.ndarray:
        """Tokens i to j - 1: one rank a level finds each run's start, the rest follows in order."""
        out, todo = np.zeros(j - i, np.int64), np.arange(j - i)
        for level, (chunk, bits, _) in enumerate(self.levels):
            if i >= j:
                break
            out[todo] |= chunk[i:j].astype(np.int64) << (CHUNK_BITS * level)
            flags = np.unpackbits(bits[i >> 3:(j + 7) >> 3], bitorder="little")[i & 7:(i & 7) + j - i] == 1
            n = int(flags.sum())
            todo = todo[flags]
            if n:
                i = int(self._rank(level, np.array([i]))[0])
            j = i + n
            if not n:
                break
        return out


def write(df: DataFrame, path: str, folder: str, end_id: int = END_ID,
          id_col: str = "doc_id", text_col: str = "text", image_ids: int = IMAGE_IDS) -> None:
    """Token files of the texts in ascending id order, as Parquet rows below ``folder``."""
    spark = df.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        cache = pieces.cache_for("library", path, pieces.library_encoder)
        part, number, start, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def flush():
            doc = np.concatenate([h[0] for h in held])
            null = np.concatenate([h[1] for h in held])
            count = np.concatenate([h[2] for h in held])
            ids = np.concatenate([h[3] for h in held])
            begin = np.concatenate([[0], np.cumsum(count)])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([image(start, doc, null, begin, ids)], pa.binary())], names=["part", "image", "n_ids", "payload"])

        for batch in batches:
            data, off = tb.flat(batch.column(1))
            null = np.asarray(batch.column(0).is_null())
            doc = batch.column(0).fill_null(0).to_numpy()
            for i, b, o in tb.slices(data, off, pieces.SLICE):
                ids, begin = pieces.word_ids(cache, b, o)
                n = len(o) - 1
                ids = np.insert(ids, begin[1:], end_id)
                held.append((doc[i:i + n], null[i:i + n], np.diff(begin) + 1, ids))
                size += len(ids)
                if size >= image_ids:
                    yield flush()
                    number, start, held, size = number + 1, start + size, [], 0
        if held:
            yield flush()

    src.mapInArrow(trimmed(run), fields("part int, image int, n_ids long, payload binary")).write.parquet(folder)


def documents_of(spark: SparkSession, folder: str) -> DataFrame:
    """Reads the files back: doc_id, start, n_tokens and ids of every document."""
    files = spark.read.schema("part int, image int, n_ids long, payload binary").parquet(folder)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))          # a row a partition of the writer
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    src = files.join(F.broadcast(before), "part").select("before", "payload")
    ship(spark)

    def run(batches):
        for batch in batches:
            for before, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                f = TokenFile(raw.as_buffer())
                ids = f.run(0, f.n).astype(np.int32)
                n = len(f.doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.doc_ids, pa.int64(), mask=f.null), pa.array(before + f.start + f.begin[:-1]),
                     pa.array(np.diff(f.begin)), pa.ListArray.from_arrays(pa.array(f.begin.astype(np.int32)), pa.array(ids))],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return src.mapInArrow(run, fields("doc_id long, start long, n_tokens long, ids array<int>"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    write(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), folder)
    back = documents_of(spark, folder)

    def run(batches):
        for batch in batches:
            ids = batch.column(3)
            off = ids.offsets.to_numpy()
            raw = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return back.mapInArrow(run, fields("doc_id long, start long, n_tokens long, ids_crc32 long"))
