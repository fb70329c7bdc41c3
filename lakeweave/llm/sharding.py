"""Operator 6: sharding by proportional stratified interleaving.

Within each source, rows are put in a seeded random order and ranked; a
row's fractional rank (rank + a seeded start of its source) / rows of the
source spreads every source evenly over [0, 1).  All rows are sorted by
fractional rank and the sequence is cut into equal shards, so every shard
has each source in proportion.  The law is ``rows``: shard sizes differ by
one row at most.

Scale: neither a source nor the whole order is sorted in one task.  The
random order and the fractional rank are both uniform numbers in [0, 1), so
equal ranges of them hold equally many rows even if one source has most of
them; rows are ranked inside ranges and the ranges' counts are added
(``common.ranked``).  Texts are reduced to size and checksum before any
shuffle.

Defined cases: a null text has size 1 and checksum 0; a null source is a
source.  Rows equal in id, size, checksum and source are interchangeable
and each gets a slot of its own.  With fewer rows than shards some shards
are empty; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ranked, read

SHARDS = 16
SEED = 42


def _uniform(*cols):
    """A number in [0, 1) from a hash of the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / float(1 << 52)


def shard(rows: DataFrame, source: str, ids: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``; ``ids`` order rows of equal random number."""
    by_source = rows.groupBy(source).agg(F.count(F.lit(1)).alias("_n")).select(F.col(source).alias("_source"), "_n")
    inside = ranked(rows, [source], _uniform(F.lit(seed), *ids), ids, "_rank")
    both = inside.join(by_source, F.col(source).eqNullSafe(F.col("_source")), "left")
    fraction = (F.col("_rank") + _uniform(F.lit(seed + 1), source)) / F.col("_n")
    placed = both.withColumn("_fraction", F.least(fraction, F.lit(1 - 2.0 ** -53))).drop("_source", "_n", "_rank")
    whole = ranked(placed, [], F.col("_fraction"), [source, *ids], "_position").drop("_fraction")
    n = rows.count()
    # shard s takes positions ceil(n * s / shards) to ceil(n * (s + 1) / shards) - 1, in whole numbers
    out = whole.withColumn("shard", F.expr(f"(_position * {shards}L) div {max(n, 1)}L").cast("int"))
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return out.withColumn("slot", F.col("_position") - first).drop("_position")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).cast("long").alias("text_crc32"))
    out = shard(rows, "source", ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source")
