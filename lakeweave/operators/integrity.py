"""Tests of a layer's content: not-null and unique columns, references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP = 32_768          # bits that one row of a bitmap table holds (4 KB)
BITS = 1 << 26           # bits of a key filter: at most 2048 rows, 8 MB, whatever the number of keys


def column_tests(df: DataFrame, not_null: list[str], unique: list[str]) -> DataFrame:
    """``column_name, test, failures, rows``: NULLs of each ``not_null``
    column, and rows of each ``unique`` column whose value (not NULL) another
    row has too, less one of each value.

    One scan answers all tests.  Rows are counted by the value of the
    ``unique`` column, combined in the map tasks first, so a frequent value
    meets nobody as rows; NULLs of the other columns are counted along, and a
    layer that lies by that column already is not shuffled again.  Only
    with several ``unique`` columns does a row give one value each.  Counts
    are exact.
    """
    absent = [F.col(c).isNull().cast("int").alias(f"_null{j}") for j, c in enumerate(not_null)]
    texts = [F.col(c).cast("string") for c in unique]
    if len(unique) > 1:
        each = df.select(*absent, F.posexplode(F.array(*texts)).alias("_i", "_v"))
    else:
        each = df.select(*absent, F.lit(0).alias("_i"), (texts or [F.lit(None).cast("string")])[0].alias("_v"))
    by = ["_i", "_v"] if len(unique) > 1 else ["_v"]
    once = F.col("_i") == 0                               # a row's NULLs count with its first value
    nulls = [f"_null{j}" for j in range(len(not_null))]
    by_value = each.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.count_if(once).alias("_rows"),
                                     *[F.sum(F.when(once, F.col(c)).otherwise(0)).alias(c) for c in nulls])
    place = F.col("_i") if len(unique) > 1 else F.lit(0)
    again = [F.sum(F.when((place == i) & F.col("_v").isNotNull(), F.col("_n") - 1).otherwise(0)).alias(f"_again{i}") for i in range(len(unique))]
    totals = by_value.agg(F.sum("_rows").alias("_rows"), *[F.sum(c).alias(c) for c in nulls], *again)
    tests = [(c, "not_null", f"_null{j}") for j, c in enumerate(not_null)] + [(c, "unique", f"_again{i}") for i, c in enumerate(unique)]
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    listed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"), number(n).alias("failures"),
                                number("_rows").alias("rows")) for c, t, n in tests])
    return totals.select(F.explode(listed).alias("t")).select("t.*")


def layer_tests(layers: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """``column_tests`` of several layers, with their name as ``layer``."""
    parts = [column_tests(df, not_null, unique).select(F.lit(name).alias("layer"), "*") for name, (df, not_null, unique) in layers.items()]
    return reduce(DataFrame.unionByName, parts)


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_filter(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """A Bloom filter of the keys as a table of bitmaps (``_bucket, _bits``):
    at most ``bits / BITMAP`` rows of 4 KB, so it may be broadcast."""
    at = keys.select(_bit(F.col(key), bits).alias("h")).select(F.floor(F.col("h") / BITMAP).alias("_bucket"), (F.col("h") % BITMAP).alias("p"))
    return at.groupBy("_bucket").agg(F.bitmap_construct_agg("p").alias("_bits"))


def with_maybe(df: DataFrame, key: str, bitmaps: DataFrame, bits: int = BITS) -> DataFrame:
    """Adds ``_maybe``: False where the filter is sure not to hold the key."""
    h = _bit(F.col(key), bits)
    p = F.col("_p")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    probed = df.withColumn("_bucket", F.floor(h / BITMAP)).withColumn("_p", (h % BITMAP).cast("int")).join(F.broadcast(bitmaps), "_bucket", "left")
    hit = F.floor(byte / F.pow(F.lit(2), p % 8)).cast("int") % 2 == 1
    return probed.withColumn("_maybe", F.coalesce(hit, F.lit(False))).select(*df.columns, "_maybe")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, bits: int = BITS) -> DataFrame:
    """Rows of ``child`` whose key no row of ``parent`` has (a NULL key
    refers to nothing and is none).

    A filter of the parent's keys, broadcast as bitmaps, tells most orphans
    where they lie; only rows that may have a parent are shuffled, against
    the parent's keys that a filter of the child's keys lets through, each
    once.  The anti join is exact, so the filters only save work; many more
    keys than ``bits`` fill them, and then it is a plain shuffled anti join.
    """
    known = child.filter(F.col(child_key).isNotNull())
    keys = parent.select(F.col(parent_key).alias("_key")).filter(F.col("_key").isNotNull())
    probed = with_maybe(known, child_key, key_filter(keys, "_key", bits), bits)
    sure = probed.filter(~F.col("_maybe")).drop("_maybe")
    asked = with_maybe(keys, "_key", key_filter(known, child_key, bits), bits).filter("_maybe").select("_key").distinct()
    maybe = probed.filter("_maybe").drop("_maybe")
    return sure.unionByName(maybe.join(asked, maybe[child_key] == asked["_key"], "left_anti"))


def orphans_stream(child: DataFrame, child_key: str, child_at: str, parent: DataFrame, parent_key: str, parent_at: str,
                   within: str, delay: str) -> DataFrame:
    """Streaming (append mode): rows of ``child`` for which no row of
    ``parent`` with their key came within ``within`` of their time, before or
    after.  A row waits in state until the watermark (of the slower stream) has
    passed that time, then it is emitted; rows of both sides older than
    that leave the state.  The sides must not share column names."""
    if not (child.isStreaming and parent.isStreaming):
        raise ValueError("orphans_stream needs streaming DataFrames; use orphans on batch data")
    around = F.expr(f"INTERVAL '{within}'")
    c, p = child.withWatermark(child_at, delay), parent.select(parent_key, parent_at).withWatermark(parent_at, delay)
    near = (F.col(parent_at) >= F.col(child_at) - around) & (F.col(parent_at) <= F.col(child_at) + around)
    joined = c.join(p, (F.col(child_key) == F.col(parent_key)) & near, "leftOuter")
    return joined.filter(F.col(parent_key).isNull() & F.col(child_key).isNotNull()).select(*child.columns)
