"""Message encoding and decoding.

All of it is narrow, per-row and JVM-side (``to_json`` / ``from_json`` /
casts), so it runs inside whole-stage codegen and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def encode_messages(df: DataFrame, topic: str, key_col: str | None,
                    fields: list[str] | None = None, keep: list[str] | tuple = ()) -> DataFrame:
    """K6: rows -> keyed JSON messages ``(key BINARY, value BINARY, topic)``.

    ``value`` is the UTF-8 JSON of ``fields`` (default: every column),
    non-ASCII kept literally and NULL fields written as ``null``; ``key`` is the UTF-8 bytes of ``key_col`` or
    NULL; ``keep`` columns are carried through unchanged.  The result can
    go straight to ``df.write.format("kafka")`` where that connector is
    installed.
    """
    cols = fields or [c for c in df.columns if c not in keep]
    key = F.col(key_col).cast("binary") if key_col else F.lit(None).cast("binary")
    return df.select(
        key.alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        *[F.col(c) for c in keep],
    )


def decode_envelope(envelope: DataFrame) -> DataFrame:
    """BINARY key/value -> text, broker timestamp -> ``kafka_timestamp``."""
    return envelope.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("json_value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )


def parse_json(text: Column, schema: StructType, corrupt_col: str | None = None) -> Column:
    """Permissive JSON parse by a declared schema.

    A bad field becomes NULL, a record that is not a JSON object becomes a
    struct of NULLs.  With ``corrupt_col`` the raw text of any record that
    failed (whole or in one field) is kept in that extra field.
    """
    if corrupt_col is None:
        return F.from_json(text, schema, {"mode": "PERMISSIVE"})
    widened = StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])
    return F.from_json(text, widened, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col})


def flatten_message(decoded: DataFrame, schema: StructType, corrupt_col: str | None = None) -> DataFrame:
    """P2 + P3: parse ``json_value`` once and lay the fields out as
    ``kafka_key, <entity fields>, topic, partition, offset, kafka_timestamp``.
    """
    parsed = decoded.withColumn("_data", parse_json(F.col("json_value"), schema, corrupt_col))
    cols = [F.col("kafka_key")]
    cols += [F.col(f"_data.{f.name}").alias(f.name) for f in schema.fields]
    cols += [F.col("topic"), F.col("partition"), F.col("offset"), F.col("kafka_timestamp")]
    if corrupt_col:
        cols.append(F.col(f"_data.{corrupt_col}").alias(corrupt_col))
    return parsed.select(*cols)
