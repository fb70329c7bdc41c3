"""Operator 7: approximate nearest neighbours by cross-polytope hashing.

A unit vector is rotated by fast Hadamard pseudo-rotations (three rounds of
random signs and a Walsh-Hadamard transform) and hashed to the nearest
signed axis.  ``TABLES`` independent rotations index every vector; a query
looks into the ``PROBES`` nearest signed axes of each table, and candidates
are ranked by exact cosine in double precision on the original vectors.

Scale: equal vectors are one class (found by a group limit that Spark also
applies before the shuffle), so copies cost one index entry and one search,
whatever their number.  Vectors of each length are searched by themselves.
Lengths of fewer than ``CELL_ROWS`` different vectors, and queries that find
fewer than k neighbours, are searched exactly: the stated queries against
all vectors of their length, in blocks.  Buckets are cut into cells of at most about
``CELL_ROWS`` vectors by ``CELL_QUERIES`` queries, so a hot bucket spreads
over tasks; bucket sizes are a table of at most TABLES * 2 D rows a hashed
length, and a row for any other, which is broadcast.  The query set is a stated part of the rows; nothing is capped.

Defined cases: vectors that are null, empty, all zero, or hold null or
non-finite components take no part, as queries or candidates, and neither do
rows without an id.  A cosine needs equal lengths, so vectors of another
length than the query's are no candidates.  Rows that repeat an id and
a vector count once each.  Equal scores go to the smaller id.  A query with
fewer candidates than k gets all of them; an empty table gives an
empty result.  Only the id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fields, read, ship, staged

TABLES = 16
PROBES = 4
ROUNDS = 3
K = 5
CELL_ROWS = 4096
CELL_QUERIES = 1024
SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row (length a power of two), O(D log D)."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotations(dim: int, tables: int, seed: int = SEED) -> np.ndarray:
    d = 1 << max(0, dim - 1).bit_length()
    return np.random.default_rng(seed).choice([-1.0, 1.0], (tables, ROUNDS, d))


def rotate(unit: np.ndarray, signs: np.ndarray) -> np.ndarray:
    x = np.zeros((len(unit), signs.shape[-1]))
    x[:, :unit.shape[1]] = unit
    for s in signs:
        x = hadamard(x * s)
    return x


def nearest_axes(x: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes, nearest first: 2 * axis + (positive)."""
    both = np.stack([-x, x], axis=2).reshape(len(x), -1)
    probes = min(probes, both.shape[1])
    return np.argsort(-both, axis=1, kind="stable")[:, :probes].astype(np.int32)


def matrix(col) -> np.ndarray:
    """Arrow list column of equally long vectors -> float64 matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    values = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(col), -1)


def unit(x: np.ndarray) -> np.ndarray:
    # divided by the largest component first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _valid(rows: DataFrame) -> DataFrame:
    ok = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
                     & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
                     & F.exists("v", lambda x: x != 0))
    return ok


def _hashed(df: DataFrame, tables: int, probes: int) -> DataFrame:
    """Adds ``codes``: for each table the probed axes of the vector's length."""
    schema = fields("cls long, v array<float>, codes array<array<int>>")
    schema["v"].dataType = df.schema["v"].dataType

    def run(batches):
        signs: dict[int, np.ndarray] = {}
        for batch in batches:
            size = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(size):
                part = batch.filter(pa.array(size == dim))
                if dim not in signs:
                    signs[dim] = rotations(int(dim), tables)
                u = unit(matrix(part.column(1)))
                codes = np.stack([nearest_axes(rotate(u, s), probes) for s in signs[dim]], axis=1)
                p = codes.shape[2]
                inner = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, p, dtype=np.int32)), pa.array(codes.ravel()))
                outer = pa.ListArray.from_arrays(pa.array(np.arange(0, len(u) * tables + 1, tables, dtype=np.int32)), inner)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), outer], names=["cls", "v", "codes"])

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def _cell(key, index: pa.Table, queries: pa.Table) -> pa.Table:
    """Best classes of one cell for each of its queries."""
    keep = K + 1
    if not index.num_rows or not queries.num_rows:
        return pa.table({"query": pa.array([], pa.int64()), "cls": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    a, b = unit(matrix(queries.column("v"))), unit(matrix(index.column("v")))
    cls = index.column("cls").to_numpy()
    s = a @ b.T
    n = min(keep, s.shape[1])
    # everything as near as the n-th (ties and rounding included), scored row by row in one fixed order
    edge = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n] - 1e-12
    i, j = np.nonzero(s >= edge[:, None])
    exact = np.empty(len(i))
    for at in range(0, len(i), 65536):
        exact[at:at + 65536] = (a[i[at:at + 65536]] * b[j[at:at + 65536]]).sum(axis=1)
    order = np.lexsort((cls[j], -exact, i))
    first = np.searchsorted(i[order], np.arange(len(a)))
    place = np.arange(len(order)) - first[i[order]]
    order = order[place < keep]
    return pa.table({"query": pa.array(queries.column("cls").to_numpy()[i[order]]), "cls": pa.array(cls[j[order]]),
                     "score": pa.array(exact[order])})


def _in_cells(index: DataFrame, probe: DataFrame) -> DataFrame:
    """``query, cls, score``: the best classes of each bucket (``d, t, code``)
    for its queries; a bucket is cut into cells of a block of either side."""
    bucket = ["d", "t", "code"]

    def blocks(df, size, name):
        return df.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    size = F.broadcast(blocks(index, CELL_ROWS, "ib").join(blocks(probe, CELL_QUERIES, "qb"), bucket))

    def dealt(df, own, own_at, other, other_at):         # an own block by hash, and a copy for every block of the other side
        return df.join(size, bucket).select(
            *bucket, F.pmod(F.xxhash64("cls"), F.col(own)).cast("int").alias(own_at),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_at), "cls", "v")

    cells = [*bucket, "i", "j"]
    return (dealt(index, "ib", "i", "qb", "j").groupBy(*cells)
            .cogroup(dealt(probe, "qb", "j", "ib", "i").select(*cells, "cls", "v").groupBy(*cells))
            .applyInArrow(_cell, "query long, cls long, score double"))


def search(rows: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
           tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every row for which ``is_query`` holds."""
    if k != K:
        raise ValueError(f"cells keep {K} neighbours")
    ok = _valid(rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"),
                            F.coalesce(is_query, F.lit(False)).alias("q")))
    ok = ok.withColumn("h", F.xxhash64("v"))
    # the k + 1 smallest ids of every vector; the smallest is its class
    small = ok.withColumn("n", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).filter(F.col("n") <= k + 1)
    classes = small.groupBy("h", "v").agg(F.min("id").alias("cls"), F.sort_array(F.collect_list("id")).alias("ids"))
    asked = (ok.filter("q").withColumn("n", F.row_number().over(Window.partitionBy("h", "v").orderBy("id")))
             .filter("n = 1").select(F.col("id").alias("cls"), "v"))
    classes, asked = staged(classes, "classes"), staged(asked, "asked")
    d = F.size("v")
    # lengths of many vectors are hashed; there are at most (rows / CELL_ROWS) of them
    many = [r.d for r in classes.groupBy(d.alias("d")).count().filter(F.col("count") >= CELL_ROWS).collect()]

    def coded(df: DataFrame, n: int) -> DataFrame:
        hashed = _hashed(df.filter(d.isin(many)).select("cls", "v"), tables, n).select("cls", "v", F.posexplode("codes").alias("t", "c"))
        return (hashed.select("cls", "v", d.alias("d"), "t", F.explode("c").alias("code"))
                .unionByName(whole(df.filter(~d.isin(many)))))

    def whole(df: DataFrame) -> DataFrame:               # one bucket a length
        return df.select("cls", "v", d.alias("d"), F.lit(-1).alias("t"), F.lit(0).alias("code"))

    found = staged(_in_cells(coded(classes, 1), coded(asked, probes)), "found")
    seen = (found.select("query", "cls").distinct().join(classes.select("cls", F.size("ids").alias("n")), "cls")
            .groupBy("query").agg(F.sum("n").alias("n")).filter(F.col("n") >= k + 1).select(F.col("query").alias("cls")))
    short = staged(asked.filter(d.isin(many)).join(seen, "cls", "left_anti"), "short")
    if not short.isEmpty():
        sizes = short.select(d.alias("size")).distinct()
        found = found.unionByName(_in_cells(whole(classes.join(sizes, d == F.col("size"), "left_semi")), whole(short)))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "cls")
    best = (found.groupBy("query", "cls").agg(F.max("score").alias("score"))
            .withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k + 1))
    members = best.join(classes.select("cls", "ids"), "cls").select("query", "score", F.explode("ids").alias("vec_id"))
    members = members.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
    lists = (members.filter(F.col("n") <= k + 1).groupBy("query")          # k + 1 rows a query vector
             .agg(F.sort_array(F.collect_list(F.struct(F.col("n"), F.col("vec_id"), F.col("score")))).alias("near")))
    # back to every query row: rows of one vector share its list and leave out themselves
    named = asked.withColumnRenamed("cls", "query").withColumn("h", F.xxhash64("v"))
    mine = ok.filter("q").join(named, ["h", "v"]).select(F.col("id").alias("query_id"), "query")
    out = mine.join(lists, "query").select("query_id", F.filter("near", lambda x: x.vec_id != F.col("query_id")).alias("near"))
    return out.select("query_id", F.posexplode(F.slice("near", 1, k)).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def op7_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
