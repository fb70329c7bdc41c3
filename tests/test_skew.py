"""Skew safety: one-row-per-key operators combine map-side; the prefix scan
cuts a hot key into several slices."""
import contextlib
import io

from pyspark.sql import functions as F

from lakeweave.operators.current import current_state
from lakeweave.operators.dedup import dedup_first, dedup_latest
from lakeweave.operators.prefix import _PART, ranged


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _hot(spark, n=3000):
    # a third of all rows on one key, many copies of it
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.col("id").alias("o"), (F.col("id") * 2).alias("v"))


def test_dedup_and_current_view_combine_map_side(spark):
    df = _hot(spark)
    for out in (dedup_first(df, "k", ["o"]), dedup_latest(df, "k", ["o"]),
                current_state(df.withColumnRenamed("o", "batch_id"), ["k"])):
        plan = _plan(out)
        assert "partial_" in plan                    # aggregate before the exchange
        assert "Window" not in plan                  # no per-key window over a hot key
    rows = {r.k: r.o for r in dedup_first(df, "k", ["o"]).collect()}
    assert rows["hot"] == 0 and len(rows) == 51


def test_prefix_scan_splits_hot_key(spark):
    sliced = ranged(_hot(spark), ["k"], ["o"], partitions=8)
    parts = sliced.filter(F.col("k") == "hot").select(_PART).distinct().count()
    assert parts >= 3
