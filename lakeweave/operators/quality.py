"""A4: row counts per layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layer_counts(layers: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``(topic, bronze_rows, silver_rows)`` for each topic.

    Every layer contributes tagged zero-column rows to one union, counted by
    a single grouped aggregate: partial counts per task, a shuffle of
    (tasks x topics) rows, one job for the whole report.
    """
    parts = []
    spark = None
    for topic, (bronze, silver) in layers.items():
        spark = spark or bronze.sparkSession
        for frame, is_bronze in ((bronze, 1), (silver, 0)):
            parts.append(frame.select(
                F.lit(topic).alias("topic"),
                F.lit(is_bronze).cast("long").alias("_b"),
                F.lit(1 - is_bronze).cast("long").alias("_s"),
            ))
    # one zero row per topic (a handful of literals) so empty layers still report
    zeros = spark.createDataFrame([(t, 0, 0) for t in layers], "topic string, _b long, _s long")
    tagged = reduce(DataFrame.unionByName, parts + [zeros])
    return tagged.groupBy("topic").agg(
        F.sum("_b").alias("bronze_rows"),
        F.sum("_s").alias("silver_rows"),
    )
