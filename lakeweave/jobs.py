"""Runnable jobs: the medallion flow as ``spark-submit`` entry points.

    spark-submit run_job.py bronze  --topic orders --source kafka --bootstrap host:9092 --root s3a://lake
    spark-submit run_job.py silver  --topic payments --root s3a://lake
    spark-submit run_job.py gold    --name revenue --duration "5 minutes" --root s3a://lake
    spark-submit run_job.py load    --name revenue --root s3a://lake --target wh.raw_revenue
    spark-submit run_job.py load    --name revenue --root s3a://lake --incremental --target s3a://wh/revenue
    spark-submit run_job.py counts  --root s3a://lake
    spark-submit run_job.py compact --layer bronze --topic orders --root s3a://lake

(``run_job.py`` at the repository root; ship the package with
``--py-files`` or install it on the cluster.)

Layout under ``--root``: ``bronze/<topic>``, ``silver/<topic>``,
``gold/<name>``, checkpoints in ``_checkpoints/<layer>/<name>``.  Every
layer is read with its declared schema, so any job can start before its
upstream has written anything.  The session comes from ``spark-submit``
(``getOrCreate``); size ``spark.sql.shuffle.partitions`` before the first
start of a stateful job, it is fixed into the checkpoint.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .operators import gold
from .operators.bronze import to_bronze
from .operators.quality import layer_counts
from .operators.silver import silver_entity
from .schemas import ENTITY, GOLD_TABLES, bronze_schema, silver_schema
from .sinks.files import compact_layer, compact_log, load_table
from .sinks.incremental import BUCKETS, load_increment
from .session import configure
from .sources.layers import read_envelope_stream, read_layer, read_layer_stream, read_topic
from .streaming.runner import run_append, run_update

# Trigger intervals and lateness of the original deployment (defaults only).
BRONZE_TRIGGER = "10 seconds"
SILVER_TRIGGER = "15 seconds"
GOLD_TRIGGER = "30 seconds"
DELAY = "10 minutes"


def _paths(root: str, layer: str, name: str) -> tuple[str, str]:
    root = root.rstrip("/")
    return f"{root}/{layer}/{name}", f"{root}/_checkpoints/{layer}/{name}"


def bronze_job(spark: SparkSession, topic: str, envelope: DataFrame, out: str, checkpoint: str,
               trigger: str = BRONZE_TRIGGER, partition_by: tuple[str, ...] = (),
               corrupt_col: str | None = None):
    """S1 -> P1-P4 -> K1 for one topic."""
    bronze = to_bronze(envelope, ENTITY[topic], corrupt_col=corrupt_col)
    return run_append(bronze, out, checkpoint, trigger, partition_by=partition_by,
                      query_name=f"bronze_{topic}")


def silver_job(spark: SparkSession, topic: str, root: str, trigger: str = SILVER_TRIGGER,
               delay: str = DELAY, max_files_per_trigger: int | None = None):
    """S2 -> P5, F6 -> W1 + D1 -> P6 -> K2 for one entity.  Per-rule reject
    counts appear in ``query.lastProgress["observedMetrics"]["<topic>_rejects"]``."""
    src, _ = _paths(root, "bronze", topic)
    out, ckpt = _paths(root, "silver", topic)
    bronze = read_layer_stream(spark, src, bronze_schema(ENTITY[topic]), max_files_per_trigger)
    silver = silver_entity(bronze, topic, delay=delay, observe=f"{topic}_rejects")
    return run_append(silver, out, ckpt, trigger, query_name=f"silver_{topic}")


def gold_job(spark: SparkSession, name: str, duration: str, root: str, trigger: str = GOLD_TRIGGER,
             delay: str = DELAY, exclude_status: tuple[str, ...] = (),
             max_files_per_trigger: int | None = None):
    """S2 -> W2/W3 + A1|A2|A3 -> K3 (update log, one folder per batch)."""
    topic, build = gold.GOLD_BUILDERS[name]
    src, _ = _paths(root, "silver", topic)
    out, ckpt = _paths(root, "gold", name)
    silver = read_layer_stream(spark, src, silver_schema(ENTITY[topic]), max_files_per_trigger)
    kwargs = {"exclude_status": exclude_status} if topic == "orders" else {}
    return run_update(build(silver, duration, delay=delay, **kwargs), out, ckpt, trigger,
                      query_name=f"gold_{name}")


def load_job(spark: SparkSession, name: str, root: str, target: str, current: bool = True):
    """Full refresh of a warehouse table from a gold log."""
    schema, keys, _table, cols = GOLD_TABLES[name]
    folder, _ = _paths(root, "gold", name)
    compacted, _ = _paths(root, "gold_compacted", name)
    return load_table(spark, folder, schema, keys, cols, target, current=current,
                      compacted=compacted if current else None)


def load_incremental_job(spark: SparkSession, name: str, root: str, target: str, buckets: int = BUCKETS):
    """K4 by increments: folds the gold batches since the last load into the
    bucketed table at ``target`` (read it with ``sinks.incremental.read_loaded``)."""
    schema, keys, _table, _cols = GOLD_TABLES[name]
    folder, _ = _paths(root, "gold", name)
    return load_increment(spark, folder, schema, keys, target, buckets)


def compact_job(spark: SparkSession, layer: str, name: str, root: str,
                target_file_bytes: int = 128 * 1024 * 1024) -> str:
    """Small-file compaction of ``<root>/<layer>/<name>`` into
    ``<root>/<layer>_compacted/<name>``; returns the new folder.  A gold log
    is folded to its current rows, and ``load`` reads those plus the batches
    since; ``counts`` reads compacted bronze and silver with ``compacted``."""
    src, _ = _paths(root, layer, name)
    dst, _ = _paths(root, f"{layer}_compacted", name)
    if layer == "gold":
        compact_log(spark, src, dst, GOLD_TABLES[name][0], GOLD_TABLES[name][1])
    else:
        schema = bronze_schema(ENTITY[name]) if layer == "bronze" else silver_schema(ENTITY[name])
        compact_layer(spark, src, dst, schema, target_file_bytes)
    return dst


def counts_job(spark: SparkSession, root: str, topics=("orders", "payments", "inventory"),
               compacted: bool = False) -> DataFrame:
    """A4: bronze vs silver row counts per topic (of the compacted layers, as
    they were when compacted, if asked)."""
    end = "_compacted" if compacted else ""
    layers = {}
    for t in topics:
        layers[t] = (read_layer(spark, _paths(root, f"bronze{end}", t)[0], bronze_schema(ENTITY[t])),
                     read_layer(spark, _paths(root, f"silver{end}", t)[0], silver_schema(ENTITY[t])))
    return layer_counts(layers)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="lakeweave.jobs")
    p.add_argument("job", choices=["bronze", "silver", "gold", "load", "counts", "compact"])
    p.add_argument("--layer", default="bronze", choices=["bronze", "silver", "gold"], help="layer to compact")
    p.add_argument("--compacted", action="store_true", help="counts: read the compacted layers")
    p.add_argument("--root", default=None, help="lake root folder (bronze/silver/gold below it)")
    p.add_argument("--topic", default=None)
    p.add_argument("--name", default=None, help="gold table: revenue | product_units | customer_activity")
    p.add_argument("--duration", default="1 minute", help="tumbling window length")
    p.add_argument("--trigger", default=None)
    p.add_argument("--source", default="kafka", choices=["kafka", "parquet"])
    p.add_argument("--bootstrap", default=None)
    p.add_argument("--envelope", default=None, help="envelope Parquet folder when --source parquet")
    p.add_argument("--out", default=None)
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--target", default=None)
    p.add_argument("--raw", action="store_true", help="load the raw update log, not the current view")
    p.add_argument("--incremental", action="store_true", help="load only gold batches since the last load, into a bucketed folder")
    p.add_argument("--buckets", type=int, default=BUCKETS, help="load --incremental: key buckets of a new table")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None,
                   help="bronze from Kafka: bound each micro-batch")
    p.add_argument("--max-files-per-trigger", type=int, default=None,
                   help="silver / gold / parquet bronze: bound each micro-batch")
    p.add_argument("--corrupt-col", default=None,
                   help="bronze: keep the raw text of unparsable messages in this column")
    p.add_argument("--exclude-status", action="append", default=[],
                   help="order status left out of order-based gold tables (repeatable, e.g. cancelled)")
    a = p.parse_args(argv)

    if a.out and not a.checkpoint:
        p.error("--out needs --checkpoint")
    spark = configure(SparkSession.builder.getOrCreate())
    if a.job == "counts":
        counts_job(spark, a.root, compacted=a.compacted).show(truncate=False)
        return
    if a.job == "compact":
        compact_job(spark, a.layer, a.name if a.layer == "gold" else a.topic, a.root)
        return
    if a.job == "load":
        if a.incremental:
            if not a.target:
                p.error("--incremental needs --target, a folder")
            load_incremental_job(spark, a.name, a.root, a.target, a.buckets)
        elif load_job(spark, a.name, a.root, a.target or GOLD_TABLES[a.name][2], current=not a.raw) is None:
            print(f"load of {a.name} skipped: nothing in its gold folder")
        return
    if a.job == "bronze":
        env = (read_topic(spark, a.bootstrap, a.topic, max_offsets_per_trigger=a.max_offsets_per_trigger)
               if a.source == "kafka" else read_envelope_stream(spark, a.envelope, a.max_files_per_trigger))
        out, ckpt = (a.out, a.checkpoint) if a.out else _paths(a.root, "bronze", a.topic)
        q = bronze_job(spark, a.topic, env, out, ckpt, a.trigger or BRONZE_TRIGGER, corrupt_col=a.corrupt_col)
    elif a.job == "silver":
        q = silver_job(spark, a.topic, a.root, a.trigger or SILVER_TRIGGER,
                       max_files_per_trigger=a.max_files_per_trigger)
    else:
        q = gold_job(spark, a.name, a.duration, a.root, a.trigger or GOLD_TRIGGER,
                     exclude_status=tuple(a.exclude_status), max_files_per_trigger=a.max_files_per_trigger)
    q.awaitTermination()         # W9: run until stopped; restarts belong to the cluster manager


if __name__ == "__main__":
    main()
