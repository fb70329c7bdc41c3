"""Streaming runners.

``run_append`` is the bronze/silver sink (Parquet append, exactly-once via
the file sink log + checkpoint).  ``run_update`` is the gold sink: update
mode through ``foreachBatch``, each micro-batch overwriting its own
``batch_id=<n>`` folder, so replaying a batch after a failure rewrites
the same folder instead of appending a second copy.  ``current_state``
(K5) then reads the latest row per key.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_dir, path_exists


def trigger_kwargs(trigger: str) -> dict:
    """``"availableNow"`` | ``"once"`` | ``"<n> seconds"`` (processing time)."""
    if trigger == "availableNow":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


# Rows a partition of keyed state is sized for: about 400 bytes a key on the heap
# while a commit holds the version before and the new one.
STATE_ROWS = 500_000


@contextmanager
def state_by_task(spark: SparkSession, rows: int) -> Iterator[None]:
    """Settings for stateful queries started inside, over at most about ``rows``
    keys: an executor holds the state of the partitions it is working on, not
    of all that it has worked on, and a partition has at most about
    ``STATE_ROWS`` keys.

    For queries that are restarted for each batch, where a loaded store is of
    little use: every batch loads its state from the checkpoint.  A query
    copies the settings when it starts; the session has its own back afterwards.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // STATE_ROWS))
    conf = {"spark.sql.streaming.stateStore.unloadOnCommit": "true", "spark.sql.shuffle.partitions": str(parts)}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_append(df: DataFrame, path: str, checkpoint: str, trigger: str = "10 seconds",
               partition_by: tuple[str, ...] | list[str] = (), fmt: str = "parquet",
               query_name: str | None = None) -> StreamingQuery:
    """K1/K2: append-mode file sink.  In append mode a stateful query emits a
    window only after the watermark passes its end."""
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(**trigger_kwargs(trigger)))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def batch_writer(path: str, partition_by: tuple[str, ...] | list[str] = ()):
    """foreachBatch body: overwrite ``<path>/batch_id=<n>``.  Runs on the
    driver but only issues a distributed write (no collect)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


def run_update(df: DataFrame, path: str, checkpoint: str, trigger: str = "30 seconds",
               query_name: str | None = None) -> StreamingQuery:
    """K3 + W8: update-mode aggregate -> one idempotent folder per batch.

    Output folder and checkpoint live and die together: a fresh checkpoint
    restarts numbering at 0, which would let stale higher-numbered folders
    win in ``current_state``.  Starting with exactly one of them present is
    refused.
    """
    spark = df.sparkSession
    has_out, has_ckpt = path_exists(spark, path), path_exists(spark, checkpoint)
    if has_out != has_ckpt:
        raise RuntimeError(
            f"output {path!r} and checkpoint {checkpoint!r} must both exist or both be new")
    ensure_dir(spark, path)     # created with the checkpoint, even if no batch runs
    w = (df.writeStream.outputMode("update")
         .foreachBatch(batch_writer(path))
         .option("checkpointLocation", checkpoint)
         .trigger(**trigger_kwargs(trigger)))
    if query_name:
        w = w.queryName(query_name)
    return w.start()
