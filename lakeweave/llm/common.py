"""Spark-side helpers of the operators: shipping the package to executors,
tables of the test data, intermediate tables in the shared folder, and
ranks without hot partitions."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_scratch, scratch

_shipped: set[str] = set()
_PATH = "_staged_in"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Give executors this package once per application (their Python path
    need not contain the repository)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-code-"), f"{name}-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back with
    its own schema: cuts the lineage, survives lost executors.  The folder
    stays until ``session.clear_scratch``; the shuffle files of the write go
    as soon as it is done."""
    spark = df.sparkSession
    path = scratch(spark, f"llm-{name}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    setattr(out, _PATH, path)
    return out


def drop_staged(*frames: DataFrame | None) -> None:
    """Deletes the folders of tables that ``staged`` gave, once nothing reads them any more."""
    for df in frames:
        path = getattr(df, _PATH, None)
        if path:
            drop_scratch(df.sparkSession, path)


def on_text(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with ``fn`` called batch by batch."""
    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
            del batch
            trim()

    return df.mapInArrow(run, schema)


def trim() -> None:
    """Gives freed memory of a Python worker back: workers stay alive between
    tasks, several to an executor, and would keep their peak."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):                    # not the GNU C library
        pass


def trimmed(fn: Callable) -> Callable:
    """``fn`` for ``mapInArrow``, with ``trim`` when its partition is done."""

    def run(batches):
        yield from fn(batches)
        trim()

    return run


def fields(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name, i = base, 0
    while name.lower() in taken:
        i += 1
        name = f"{base}_{i}"
    return name


def ranked(df: DataFrame, group: list[str], spread: Column, order: list[str], out: str,
           bucket_rows: int = 20_000, sums: dict[str, str] | None = None) -> DataFrame:
    """Exact 0-based rank ``out`` of each row within ``group``, without a task
    that sorts a whole group.

    ``spread`` is a number in [0, 1) that leads the order: rows are cut into
    equal ranges of it, each (group, range) is ranked on its own, and the
    counts of the earlier ranges are added (a table of one row per group and
    range, ordered group by group).  ``sums`` maps a column to the name of
    its running total over the whole table, exclusive, in the order (group,
    spread); that takes one row a group into one task, so it is for few
    groups.
    """
    n = df.count()
    buckets = max(64, -(-n // bucket_rows))
    b, s, base = (fresh(df, x) for x in ("_range", "_spread", "_base"))
    cut = df.withColumn(s, spread).withColumn(b, F.least(F.floor(F.col(s) * buckets), F.lit(buckets - 1)).cast("int"))
    w = Window.partitionBy(*group, b).orderBy(s, *order)
    local = cut.withColumn(out, F.row_number().over(w) - 1)
    totals = {f"{base}_{c}": c for c in (sums or {})}
    run = Window.partitionBy(*group, b).orderBy(s, *order).rowsBetween(Window.unboundedPreceding, -1)
    for c, name in (sums or {}).items():
        local = local.withColumn(name, F.coalesce(F.sum(c).over(run), F.lit(0)))
    counts = cut.groupBy(*group, b).agg(F.count(F.lit(1)).alias(base), *[F.sum(c).alias(k) for k, c in totals.items()])
    before = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    if totals and group:                                 # totals of the earlier groups: a row a group
        ahead = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
        per_group = counts.groupBy(*group).agg(*[F.sum(k).alias(f"{k}_g") for k in totals])
        per_group = per_group.select(*[F.col(g).alias(f"{base}_h{i}") for i, g in enumerate(group)],
                                     *[F.coalesce(F.sum(f"{k}_g").over(ahead), F.lit(0)).alias(f"{k}_a") for k in totals])
        same = reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"{base}_h{i}")) for i, g in enumerate(group)])
        counts = counts.join(per_group, same)
    else:
        counts = counts.withColumns({f"{k}_a": F.lit(0) for k in totals})
    counts = counts.select(*[F.col(g).alias(f"{base}_g{i}") for i, g in enumerate(group)], F.col(b).alias(f"{base}_b"),
                           F.coalesce(F.sum(base).over(before), F.lit(0)).alias(f"{base}_n"),
                           *[(F.coalesce(F.sum(k).over(before), F.lit(0)) + F.col(f"{k}_a")).alias(f"{k}_n") for k in totals])
    on = F.col(b) == F.col(f"{base}_b")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"{base}_g{i}"))
    joined = local.join(counts, on, "left")
    add = {out: F.col(out) + F.col(f"{base}_n")}
    for k, c in totals.items():
        add[sums[c]] = F.col(sums[c]) + F.col(f"{k}_n")
    return joined.select(*df.columns, *[v.cast("long").alias(k) for k, v in add.items()])
