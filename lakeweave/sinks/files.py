"""Batch sinks: layer writes and the warehouse full-refresh load (S5, U1,
P9, P10, K4, K7)."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.timefmt import timestamps_as_text
from ..operators.current import current_state
from ..schemas import with_batch_id
from ..session import folder_bytes, move, path_exists, remove
from ..sources.layers import read_layer

LOG = logging.getLogger(__name__)


def write_layer(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: tuple[str, ...] | list[str] = ()) -> None:
    """Batch write of a layer (Parquet).  ``partition_by`` lets readers
    that filter on that column prune whole folders."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def compact_layer(spark: SparkSession, src: str, dst: str, schema: StructType,
                  target_file_bytes: int = 128 * 1024 * 1024,
                  partition_by: tuple[str, ...] | list[str] = ()) -> int:
    """Small-file control: rewrite the layer at ``src`` into ``dst`` with
    files of about ``target_file_bytes`` (frequent append triggers leave many
    small files).  The file count comes from folder metadata; ``coalesce``
    merges input splits without a shuffle.  ``src`` is left as it is;
    readers switch to ``dst``.  Returns the number of output files planned."""
    files = max(1, -(-folder_bytes(spark, src) // target_file_bytes))
    layer = read_layer(spark, src, schema)
    swap_folder(layer.coalesce(files), dst, partition_by)
    return files


def publish(messages: DataFrame, bootstrap: str) -> None:
    """K6 sink: write ``(key, value, topic)`` rows to their topics.  Needs
    the ``spark-sql-kafka`` connector on the classpath."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save()


def create_database(spark: SparkSession, name: str) -> None:
    """K7: idempotent namespace creation."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def swap_folder(df: DataFrame, target: str, partition_by: tuple[str, ...] | list[str] = ()) -> None:
    """Writes ``df`` beside ``target`` and then takes its place, by two
    renames: the old content stays whole if the write fails, but a reader
    that comes between the renames finds no folder and must try again, and a
    driver lost there leaves the old content in ``<target>__old-...``.
    Readers that cannot bear that read a table of ``sinks/incremental.py``,
    whose commits switch by one file."""
    spark, target = df.sparkSession, target.rstrip("/")
    new, old = f"{target}__new-{uuid.uuid4().hex[:8]}", f"{target}__old-{uuid.uuid4().hex[:8]}"
    write_layer(df, new, partition_by=partition_by)
    had = path_exists(spark, target)
    if had:
        move(spark, target, old)
    move(spark, new, target)
    if had:
        remove(spark, old)


def read_log(spark: SparkSession, folder: str, schema: StructType, compacted: str | None = None) -> DataFrame:
    """An update log; with a ``compacted`` folder, that and the later batches."""
    log = read_layer(spark, folder, schema)
    if not compacted or not path_exists(spark, compacted):
        return log
    done = read_layer(spark, compacted, StructType([*schema.fields, StructField("upto", LongType())]))
    upto = done.agg(F.max("upto")).first()[0]
    return log.filter(F.col("batch_id") > (-1 if upto is None else upto)).unionByName(done.select(*schema.fieldNames()))


def compact_log(spark: SparkSession, folder: str, compacted: str, schema: StructType, keys: list[str]) -> int:
    """Folds an update log to one row a key, each with the number of its
    batch and the last batch covered (``upto``); returns that.  The log is
    left as it is; readers skip its folders up to there (partition pruning)."""
    log = read_log(spark, folder, with_batch_id(schema), compacted)
    upto = log.agg(F.max("batch_id")).first()[0]
    if upto is None:
        return -1
    values = [c for c in log.columns if c not in keys]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(
        *keys, *[F.col(f"_v.{c}").alias(c) for c in values])
    swap_folder(latest.select(*log.columns).withColumn("upto", F.lit(upto).cast("long")), compacted)
    return upto


def load_table(spark: SparkSession, folder: str, schema: StructType, keys: list[str],
               columns: list[str], target: str, current: bool = True,
               text_timestamps: bool = True, logged: bool = True,
               jdbc: dict | None = None, compacted: str | None = None) -> DataFrame | None:
    """K4: full refresh of ``target`` from every Parquet file of ``folder``.

    * S5/U1: one scan of the whole folder with the declared schema (files
      are concatenated by column name);
    * K5: with ``current`` (default) an update log is reduced to the latest
      row per ``keys`` by ``batch_id``; ``current=False`` copies the raw
      log, as the original hourly loader did;
    * P9: fixed target column order; P10: timestamps as text;
    * K4: a Parquet target is written to a new folder beside it and then
      exchanged (``swap_folder``), so a failed load leaves the old target
      whole; a catalog table is replaced by ``mode("overwrite")``, which
      drops its files first, so a load that fails there must be repeated.  When the folder is missing or
      holds no rows the target is left untouched, the skip is logged and
      ``None`` returned (the original returned before truncating);
    * rows of ``compacted`` (see ``compact_log``) stand for the batches up
      to its own.

    ``target`` containing ``/`` is a Parquet path, otherwise a table name.
    With ``jdbc`` (``url``, credentials, driver ...) ``target`` is the remote
    table: it is truncated and refilled in one overwrite, keeping its DDL.
    Returns the loaded target as a DataFrame.
    """
    src_schema = with_batch_id(schema) if logged else schema
    if not path_exists(spark, folder):
        LOG.warning("load of %s skipped: no folder %s", target, folder)
        return None
    log = read_log(spark, folder, src_schema, compacted) if logged else read_layer(spark, folder, src_schema)
    if log.isEmpty():
        LOG.warning("load of %s skipped: no rows in %s", target, folder)
        return None
    rows = current_state(log, keys) if (current and logged) else log
    out = rows.select(*columns)
    if text_timestamps:
        out = timestamps_as_text(out)
    if jdbc is not None:
        (out.write.format("jdbc").options(**jdbc).option("dbtable", target)
         .option("truncate", "true").mode("overwrite").save())
        return spark.read.format("jdbc").options(**jdbc).option("dbtable", target).load()
    if "/" in target:
        swap_folder(out, target)
        return spark.read.schema(out.schema).parquet(target)
    out.write.mode("overwrite").saveAsTable(target)
    return spark.table(target)
