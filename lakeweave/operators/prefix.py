"""Skew-safe scans along an order, per key.

``... OVER (PARTITION BY key ORDER BY o)`` sends every row of a key to one
task.  If one key holds a third of the data, that task sorts and scans a
third of the data alone.  Here a scan is split in two phases:

1. rows are cut into slices: ranges of the *whole* order (its tie-breaks
   included, so equal first columns are split too), with bounds that Spark
   samples, so slices hold about equally many rows whatever the values;
   each slice of a key is scanned locally;
2. one row a (key, slice) -- at most (#slices) rows a key -- gives each slice
   its carry-in from the key's other slices, joined back on (key, slice).

The slices are written once to the shared folder (every branch and retry
sees the same slice numbers), then shuffled once, by (key, slice): the local
windows, the summaries and the carry joins all use that layout, the key
first, by which a sort tells most rows apart.  A task gets about
``TASK_BYTES`` of the written slices, however many there are.  Drop the
folder with ``session.clear_scratch``.

``order`` must be a total order per key (break ties on every column) so the
result does not depend on layout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..session import folder_bytes, scratch

_PART = "_scan_part"
TASK_BYTES = 1 << 24      # of the written slices, for a task of the scan


def _surrogates(keys: list[str]) -> tuple[list[str], list[str]]:
    return [f"_sk{i}" for i in range(len(keys))], [f"_sn{i}" for i in range(len(keys))]


def layout(keys: list[str]) -> list[str]:
    """Columns that rows of ``ranged`` are laid out by."""
    sk, sn = _surrogates(keys)
    return [*sk, *sn, _PART]


def ranged(df: DataFrame, keys: list[str], order_by: list[str], partitions: int | None = None) -> DataFrame:
    """Phase-1 layout: rows in ``partitions`` ranges of the order (default:
    ``spark.sql.shuffle.partitions``, small ones merged by AQE), tagged with
    their slice number and with non-NULL surrogates of the keys
    (``coalesce(key, default)``, ``isnull(key)``).  Grouping on the
    surrogates equals NULL-safe grouping on the keys, and because they are
    plain non-NULL columns, local windows, summaries and carry joins share
    one hash layout (a NULL-safe join would be rewritten to those expressions
    and force a re-shuffle of the large side)."""
    spark = df.sparkSession
    path = scratch(spark, "prefix")
    cut = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    cut.withColumn(_PART, F.spark_partition_id()).write.parquet(path)
    once = spark.read.schema(StructType([*df.schema.fields]).add(_PART, IntegerType())).parquet(path)
    sk, sn = _surrogates(keys)
    tagged = once.select(
        "*",
        *[F.coalesce(F.col(k), F.lit(0).cast(df.schema[k].dataType)).alias(a) for k, a in zip(keys, sk)],
        *[F.col(k).isNull().alias(a) for k, a in zip(keys, sn)],
    )
    # left to itself, Spark keeps to its number of shuffle partitions (merging small ones)
    tasks = folder_bytes(spark, path) // TASK_BYTES
    many = [tasks] if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    return tagged.repartition(*many, *layout(keys))


def local_window(keys: list[str], order_by: list[str]) -> WindowSpec:
    """Rows of one key in one slice, in order."""
    return Window.partitionBy(*layout(keys)).orderBy(*order_by)


def with_carry(sliced: DataFrame, keys: list[str], summary: dict[str, Column],
               carry: Callable[[DataFrame, WindowSpec, WindowSpec], DataFrame], names: list[str]) -> DataFrame:
    """Phase 2: ``summary`` aggregates each (key, slice); ``carry`` gets that
    table and the windows over a key's earlier and later slices and adds the
    columns ``names``, which every row of the slice then has.

    The join is on the layout's columns, in its order: the large side stays
    where it is and only the summary table moves."""
    sk, sn = _surrogates(keys)
    by = layout(keys)
    table = sliced.groupBy(*by).agg(*[c.alias(n) for n, c in summary.items()])
    slices = Window.partitionBy(*sk, *sn).orderBy(_PART)
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    later = slices.rowsBetween(1, Window.unboundedFollowing)
    table = carry(table, earlier, later).select(*by, *names)
    return sliced.join(table, on=by, how="left").select(*sliced.columns, *names)


def drop_layout(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.drop(*layout(keys))


def running_sum(df: DataFrame, keys: list[str], order_by: list[str], value: str | Column,
                out: str, partitions: int | None = None) -> DataFrame:
    """Per-key cumulative sum of ``value`` in ``order_by`` order; a NULL adds nothing."""
    val = F.col(value) if isinstance(value, str) else value
    upto = local_window(keys, order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sliced = ranged(df, keys, order_by, partitions).withColumn("_val", F.coalesce(val, F.lit(0)))
    local = sliced.withColumn("_sum", F.sum("_val").over(upto))
    both = with_carry(local, keys, {"_all": F.sum("_val")},
                      lambda t, earlier, _: t.withColumn("_base", F.sum("_all").over(earlier)), ["_base"])
    total = F.col("_sum") + F.coalesce(F.col("_base"), F.lit(0))
    return drop_layout(both.withColumn(out, total).drop("_val", "_sum", "_base"), keys)


def clamped_running_sum(df: DataFrame, keys: list[str], order_by: list[str], change: str,
                        initial: int, out: str, floor: int = 0,
                        partitions: int | None = None) -> DataFrame:
    """Per key, ``s_i = max(s_{i-1} + change_i, floor)`` with ``s_0 = initial``.

    Closed form (Lindley recursion): with ``P_i = initial + cumsum(change)``,
    ``s_i = P_i - min(floor, min_{k<=i} P_k) + floor``.  A slice hands on the
    pair (its sum, its smallest prefix), so one pass and one carry do.
    """
    upto = local_window(keys, order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sliced = ranged(df, keys, order_by, partitions).withColumn("_val", F.coalesce(F.col(change), F.lit(0)))
    local = sliced.withColumn("_p", F.sum("_val").over(upto)).withColumn("_m", F.min("_p").over(upto))

    def carry(t: DataFrame, earlier: WindowSpec, _: WindowSpec) -> DataFrame:
        based = t.withColumn("_base", F.coalesce(F.sum("_all").over(earlier), F.lit(0)))
        return based.withColumn("_low", F.min(F.col("_base") + F.col("_least")).over(earlier))

    both = with_carry(local, keys, {"_all": F.sum("_val"), "_least": F.min("_p")}, carry, ["_base", "_low"])
    p = F.col("_p") + F.col("_base") + F.lit(initial)
    # least() skips the NULL of a key's first slice
    low = F.least(F.col("_m") + F.col("_base") + F.lit(initial), F.col("_low") + F.lit(initial), F.lit(floor))
    result = p - low + F.lit(floor)
    return drop_layout(both.withColumn(out, result.cast(df.schema[change].dataType)), keys) \
        .drop("_val", "_p", "_m", "_base", "_low")
