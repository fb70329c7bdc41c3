"""De-duplication.

D1 is the original streaming behaviour: first row seen per key within
the watermark delay.  The batch forms keep exactly one row per key under
a total order, and are written as a grouped ``min``/``max`` of a struct
rather than ``row_number() OVER (PARTITION BY key ...)``: the aggregate
combines map-side before the shuffle, so a key that holds a large share
of all rows is reduced in every map task instead of being sorted whole
inside one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_stream(df: DataFrame, key: str | list[str], ts: str = "created_at_ts",
                 delay: str = "10 minutes") -> DataFrame:
    """D1 (streaming only): ``withWatermark(ts, delay)`` then
    ``dropDuplicatesWithinWatermark(key)``.

    Guarantee is "at least ``delay``": state for a key is dropped only once
    the watermark passes first-seen + delay, at the end of a micro-batch.

    Streaming de-duplication has no map-side combine: the copies of a key in
    one micro-batch meet in one task.  Bound them with the source's
    ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``.  (A salted first
    level would not do: it remembers rows that the second level rejected,
    so a key could be held back after its own state has expired.)
    """
    if not df.isStreaming:
        raise ValueError("dedup_stream needs a streaming DataFrame; use dedup_first on batch data")
    keys = [key] if isinstance(key, str) else list(key)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def _keep_one(df: DataFrame, keys: list[str], order_by: list[str | Column], pick) -> DataFrame:
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    rest = [c for c in df.columns if c not in keys]
    # Ordering columns first, then every remaining column as a tie-break, so
    # the chosen row is fully determined by the data (no dependence on
    # partitioning or arrival order).
    packed = F.struct(
        *[oc.alias(f"_o{i}") for i, oc in enumerate(order_cols)],
        *[F.col(c) for c in rest],
    )
    out = df.groupBy(*keys).agg(pick(packed).alias("_keep"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_keep.{c}").alias(c) for c in rest]) \
        .select(*df.columns)


def dedup_first(df: DataFrame, key: str | list[str], order_by: list[str | Column],
                tie_break: list[str | Column] | None = None) -> DataFrame:
    """Batch form of D1: per key keep the row that is smallest in
    ``order_by`` (e.g. ``kafka_timestamp, partition, offset`` = first
    arrived), then ``tie_break``, then the remaining columns."""
    keys = [key] if isinstance(key, str) else list(key)
    return _keep_one(df, keys, list(order_by) + list(tie_break or []), F.min)


def dedup_latest(df: DataFrame, key: str | list[str], order_by: list[str | Column],
                 tie_break: list[str | Column] | None = None) -> DataFrame:
    """D2 (batch): per key keep the row that is greatest in ``order_by``
    (e.g. ``ingested_at``), then ``tie_break``, then the remaining columns.

    Works per micro-batch of a stream through ``foreachBatch``.
    """
    if df.isStreaming:
        raise ValueError("dedup_latest is batch-only; call it inside foreachBatch for streams")
    keys = [key] if isinstance(key, str) else list(key)
    return _keep_one(df, keys, list(order_by) + list(tie_break or []), F.max)
