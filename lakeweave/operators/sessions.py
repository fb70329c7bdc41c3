"""Sessions of activity and the gaps between them (churn).

A session of a key ends when no event follows within ``gap`` of its last one;
the key counts as gone once that much time has passed without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import flatten_window
from .prefix import drop_layout, local_window, ranged, with_carry


def _gap(gap: str) -> Column:
    return F.expr(f"INTERVAL '{gap}'")


def session_gaps(df: DataFrame, keys: list[str], at: str, gap: str, order_by: list[str], totals: dict[str, Column],
                 partitions: int | None = None) -> DataFrame:
    """Batch: one row a session -- ``keys, session`` (from 1), ``session_start``,
    ``session_end`` (last event), ``events``, the ``totals``, ``next_start``,
    ``gone``: the gap has passed, by a later session or by the last event of
    the whole input.

    Keys are followed over slices of the order (``operators/prefix.py``), so a
    hot key is neither sorted nor merged in one task, as it would be by
    ``session_window``.  Events without time or key are left out.
    """
    rows = df.dropna(subset=[at, *keys])
    order = [at, *order_by]
    window = local_window(keys, order)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sliced = ranged(rows, keys, order, partitions)
    edges = {"_lo": F.min(at), "_hi": F.max(at)}
    near = with_carry(sliced, keys, edges, lambda t, earlier, later: t
                      .withColumn("_behind", F.max("_hi").over(earlier)).withColumn("_ahead", F.min("_lo").over(later)), ["_behind", "_ahead"])
    before = F.coalesce(F.lag(at).over(window), F.col("_behind"))
    after = F.coalesce(F.lead(at).over(window), F.col("_ahead"))
    marked = near.withColumn("_before", before).withColumn("_after", after) \
        .withColumn("_start", (F.col("_before").isNull() | (F.col(at) > F.col("_before") + _gap(gap))).cast("int"))
    counted = marked.withColumn("_local", F.sum("_start").over(upto))
    numbered = with_carry(counted, keys, {"_starts": F.sum("_start")}, lambda t, earlier, _: t.withColumn(
        "_base", F.coalesce(F.sum("_starts").over(earlier), F.lit(0))), ["_base"])
    last = F.col("_after").isNull() | (F.col("_after") > F.col(at) + _gap(gap))
    out = drop_layout(numbered, keys).groupBy(*keys, (F.col("_base") + F.col("_local")).cast("long").alias("session")).agg(
        F.min(at).alias("session_start"), F.max(at).alias("session_end"), F.count(F.lit(1)).alias("events"),
        *[c.alias(n) for n, c in totals.items()], F.max(F.when(last, F.col("_after"))).alias("next_start"))
    end = sliced.agg(F.max(at)).first()[0]                # one value
    return out.withColumn("gone", F.col("next_start").isNotNull() | (F.col("session_end") + _gap(gap) <= F.lit(end)))


def sessions_stream(df: DataFrame, keys: list[str], at: str, gap: str, totals: dict[str, Column], delay: str) -> DataFrame:
    """Streaming (append mode): a session is kept as state until the
    watermark has passed its last event by ``gap``, then it is emitted: the key
    is gone.  ``window_end`` is that moment."""
    if not df.isStreaming:
        raise ValueError("sessions_stream needs a streaming DataFrame; use session_gaps on batch data")
    agg = df.withWatermark(at, delay).groupBy(F.session_window(at, gap), *keys).agg(
        F.count(F.lit(1)).alias("events"), *[c.alias(n) for n, c in totals.items()])
    return flatten_window(agg, "session_window")
