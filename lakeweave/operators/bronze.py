"""Bronze layer (S1, P1-P4): envelope -> typed, flattened rows.

Narrow projection only: no filter, no shuffle.  Works on a static or a
streaming envelope (``spark.readStream.format("kafka")`` where the
connector exists, or any DataFrame with the envelope columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.messages import decode_envelope, flatten_message


def to_bronze(envelope: DataFrame, entity_schema: StructType,
              corrupt_col: str | None = None, stamp: bool = True) -> DataFrame:
    """Decode, parse by ``entity_schema``, flatten, and stamp ``ingested_at``.

    Output: ``kafka_key, <entity fields>, topic, partition, offset,
    kafka_timestamp[, corrupt_col][, ingested_at]``.
    """
    out = flatten_message(decode_envelope(envelope), entity_schema, corrupt_col)
    if stamp:
        out = out.withColumn("ingested_at", F.current_timestamp())
    return out


def corrupt_split(bronze_with_corrupt: DataFrame, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """P2 report: per topic, rows parsed cleanly vs rows with a corrupt record."""
    bad = F.col(corrupt_col).isNotNull()
    return bronze_with_corrupt.groupBy("topic").agg(
        F.count_if(~bad).alias("good_rows"),
        F.count_if(bad).alias("corrupt_rows"),
    )
