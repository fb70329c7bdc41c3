"""Read a layer folder with a declared schema.

No layer is ever read with an inferred schema: an empty folder reads as
zero rows.  A batch read of a missing folder fails (a mistyped path must
not look like no data); a stream can start before its input exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import ENVELOPE
from ..session import ensure_dir, path_exists


def read_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Batch scan of every Parquet file under ``path``.  Filters and
    column selections on the result reach the scan (pushdown, pruning).
    An existing empty folder is zero rows, a missing one an error."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.schema(schema).option("recursiveFileLookup", "false").parquet(path)


def read_layer_stream(spark: SparkSession, path: str, schema: StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over a layer folder, pinned schema; the folder is
    created first so the query can start before any data arrives."""
    ensure_dir(spark, path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def read_envelope_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 stand-in: an envelope-shaped Parquet stream.  With the Kafka
    connector on the classpath use ``spark.readStream.format("kafka")
    .option("subscribe", topic).option("startingOffsets", "earliest")``
    instead; both yield the same columns."""
    return read_layer_stream(spark, path, ENVELOPE, max_files_per_trigger)


def read_topic(spark: SparkSession, bootstrap: str, topic: str, starting: str = "earliest",
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to one topic from ``starting`` offsets.  Needs the
    ``spark-sql-kafka`` connector on the classpath.  ``max_offsets_per_trigger``
    bounds each micro-batch (and the work one hot key can put on a task)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", starting))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()
