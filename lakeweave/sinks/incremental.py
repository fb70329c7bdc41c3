"""Incremental loads into a table of key buckets.

A table is a folder of buckets of its keys' hash.  A load reads the source
beyond the table's high-water mark, rewrites the buckets that the new rows
touch beside the old ones (copy-on-write), and ends with a commit that says
which load holds each bucket and how far the source has been read::

    <target>/data/load=<n>/bucket=<b>/...parquet
    <target>/commits/load=<n>/...parquet        (bucket, load, upto, buckets)

A commit counts when its ``_SUCCESS`` file is there, which Spark's file
committer writes last.  Readers take the newest one, so they see a load whole
or not at all.  A load that was killed before its commit leaves files that
nobody reads; repeating it writes the same folder anew.  One load at a time
may run on a table.  Nothing but the commit (one row a bucket) and the list
of touched buckets reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..functions.timefmt import timestamps_as_text
from ..operators.history import history
from ..schemas import with_batch_id
from ..session import list_dir, path_exists, remove
from ..sources.layers import read_layer

BUCKETS = 64             # of a new table; size it to the data, a load rewrites whole buckets
FILES = 8                # tasks, and files at most, that a bucket is written by
_COMMIT = "bucket int, load int, upto long, buckets int"


@dataclass
class Snapshot:
    """What one commit says: ``folders`` maps a bucket to the load that holds it."""

    load: int = -1
    upto: int | None = None
    buckets: int = BUCKETS
    folders: dict[int, int] = field(default_factory=dict)


def snapshot(spark: SparkSession, target: str, buckets: int = BUCKETS) -> Snapshot:
    """The newest commit of a table; an empty one with ``buckets`` if it has none."""
    base = f"{target.rstrip('/')}/commits"
    loads = [int(d.split("=")[1]) for d in list_dir(spark, base) if d.startswith("load=")]
    done = [n for n in loads if path_exists(spark, f"{base}/load={n}/_SUCCESS")]
    if not done:
        return Snapshot(buckets=buckets)
    rows = spark.read.schema(_COMMIT).parquet(f"{base}/load={max(done)}").collect()      # one row a bucket, and one for the table
    whole = next(r for r in rows if r.bucket < 0)
    return Snapshot(max(done), whole.upto, whole.buckets, {r.bucket: r.load for r in rows if r.bucket >= 0})


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, target: str, schema: StructType, snap: Snapshot | None = None,
                 only: set[int] | None = None) -> DataFrame:
    """Rows of a table as of ``snap`` (default: now), of all or ``only`` some buckets."""
    snap = snap or snapshot(spark, target)
    folders = [f"{target.rstrip('/')}/data/load={n}/bucket={b}" for b, n in sorted(snap.folders.items()) if only is None or b in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write_buckets(spark: SparkSession, target: str, rows: DataFrame, keys: list[str], touched: set[int], snap: Snapshot,
                  upto: int | None, before_commit: Callable[[], None] | None = None) -> Snapshot:
    """One load: ``rows`` are the whole new content of the ``touched`` buckets.
    ``before_commit`` runs between data and commit (tests use it to fail)."""
    target, n = target.rstrip("/"), snap.load + 1
    data = f"{target}/data/load={n}"
    out = rows.withColumn("bucket", bucket_of(keys, snap.buckets))
    out.repartition("bucket", F.pmod(F.hash(*keys), F.lit(FILES))).write.mode("overwrite").partitionBy("bucket").parquet(data)
    if before_commit is not None:
        before_commit()
    held = {int(d.split("=")[1]) for d in list_dir(spark, data) if d.startswith("bucket=")}
    folders = {b: at for b, at in snap.folders.items() if b not in touched} | dict.fromkeys(held, n)
    commit = [(-1, n, upto, snap.buckets), *[(b, at, upto, snap.buckets) for b, at in sorted(folders.items())]]
    spark.createDataFrame(commit, _COMMIT).coalesce(1).write.mode("overwrite").parquet(f"{target}/commits/load={n}")
    return Snapshot(n, upto, snap.buckets, folders)


def vacuum(spark: SparkSession, target: str) -> None:
    """Deletes older commits and the bucket folders that only they, or killed
    loads, refer to.  Not while readers use an older snapshot."""
    snap, target = snapshot(spark, target), target.rstrip("/")
    used = {f"load={n}/bucket={b}" for b, n in snap.folders.items()}
    for load in list_dir(spark, f"{target}/data"):
        inside = [f"{load}/{b}" for b in list_dir(spark, f"{target}/data/{load}") if b.startswith("bucket=")]
        for folder in inside:
            if folder not in used:
                remove(spark, f"{target}/data/{folder}")
        if not used.intersection(inside):
            remove(spark, f"{target}/data/{load}")
    for load in list_dir(spark, f"{target}/commits"):
        if load != f"load={snap.load}":
            remove(spark, f"{target}/commits/{load}")


def _touched(rows: DataFrame, keys: list[str], buckets: int) -> set[int]:
    return {r.b for r in rows.select(bucket_of(keys, buckets).alias("b")).distinct().collect()}


def load_increment(spark: SparkSession, folder: str, schema: StructType, keys: list[str], target: str,
                   buckets: int = BUCKETS, before_commit: Callable[[], None] | None = None) -> Snapshot:
    """Folds the batches of the update log ``folder`` that ``target`` has not
    seen (``batch_id`` above its high-water mark: earlier folders are pruned)
    into the table: of each key the row of the latest batch, with its number.

    Only buckets that the new batches touch are read and written.  Rows of a
    key are combined before the shuffle.  Nothing new: nothing is written.
    """
    snap = snapshot(spark, target, buckets)
    logged = with_batch_id(schema)
    log = read_layer(spark, folder, logged)
    if snap.upto is not None:
        log = log.filter(F.col("batch_id") > snap.upto)
    upto = log.agg(F.max("batch_id")).first()[0]
    if upto is None:
        return snap
    log = log.filter(F.col("batch_id") <= upto)          # a batch that arrives meanwhile is the next load's
    touched = _touched(log, keys, snap.buckets)
    values = [c for c in logged.fieldNames() if c not in keys]
    rows = read_buckets(spark, target, logged, snap, touched).unionByName(log)
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(
        *[F.col(k) if k in keys else F.col(f"_v.{k}").alias(k) for k in logged.fieldNames()])
    return write_buckets(spark, target, latest, keys, touched, snap, upto, before_commit)


def read_loaded(spark: SparkSession, target: str, schema: StructType, columns: list[str], text_timestamps: bool = True) -> DataFrame:
    """The loaded table in the warehouse's column order."""
    out = read_buckets(spark, target, with_batch_id(schema)).select(*columns)
    return timestamps_as_text(out) if text_timestamps else out


# --- history with late events ---------------------------------------------------

def _points_schema(events: DataFrame, keys: list[str], at: str, tracked: list[str], order_by: list[str]) -> StructType:
    return events.select(*keys, at, *[c for c in [*order_by, *tracked] if c not in (*keys, at)]).schema


def merge_history(events: DataFrame, keys: list[str], at: str, tracked: list[str], order_by: list[str], target: str,
                  buckets: int = BUCKETS) -> Snapshot:
    """Merges a load of events, late or not, into a stored SCD type 2 table.

    The table keeps its change points (``<target>/points``: one row a key and
    time) beside the versions (``<target>/versions``): a late event splits,
    shortens or joins intervals, which the versions alone cannot tell (a
    joined run does not know its inner times).  Only the buckets of the keys in
    the load are read and rewritten, in both.  The result does not depend on
    how events are dealt to loads or in which order loads come; a load that
    failed half-way, or was already merged, may be merged again.
    """
    spark, target = events.sparkSession, target.rstrip("/")
    schema = _points_schema(events, keys, at, tracked, order_by)
    new = events.select(*schema.fieldNames()).dropna(subset=[*keys, at])
    points, versions = f"{target}/points", f"{target}/versions"
    before = snapshot(spark, points, buckets)
    touched = _touched(new, keys, before.buckets)
    if not touched:
        return snapshot(spark, versions, before.buckets)
    rest = [c for c in schema.fieldNames() if c not in (*keys, at)]
    rows = read_buckets(spark, points, schema, before, touched).unionByName(new)
    one = rows.groupBy(*keys, at).agg(F.max(F.struct(*rest)).alias("_v")).select(*keys, at, *[F.col(f"_v.{c}").alias(c) for c in rest])
    after = write_buckets(spark, points, one.select(*schema.fieldNames()), keys, touched, before, None)
    stored = history(read_buckets(spark, points, schema, after, touched), keys, at, tracked, order_by)
    return write_buckets(spark, versions, stored, keys, touched, snapshot(spark, versions, before.buckets), None)


def versions_schema(events: DataFrame, keys: list[str], at: str, tracked: list[str]) -> StructType:
    time = events.schema[at].dataType
    s = StructType([*[events.schema[c] for c in (*keys, *tracked)]])
    return s.add("version", "long").add("valid_from", time).add("valid_to", time).add("is_current", "boolean")


def read_history(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The stored versions (``schema`` as of ``versions_schema``)."""
    return read_buckets(spark, f"{target.rstrip('/')}/versions", schema)
