"""Versions of slowly changing rows (SCD type 2) and joins as of a time.

Both follow each key along time without bringing a key's rows together: the
order is cut into slices (``operators/prefix.py``), each slice is scanned
locally, and one row a (key, slice) carries the state over the borders.  A
key that holds a third of all rows is spread over as many slices as its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import drop_layout, layout, local_window, ranged, with_carry


def history(events: DataFrame, keys: list[str], at: str, tracked: list[str], order_by: list[str],
            partitions: int | None = None) -> DataFrame:
    """SCD type 2: ``keys, tracked, version, valid_from, valid_to,
    is_current``, one row a version.

    A version is a longest run of neighbouring events of a key with equal
    ``tracked`` columns (NULLs are equal); it holds from its first event's
    ``at`` to the next version's (excluded), the last one without end.  Of
    events of a key at the same time only the last in ``order_by`` counts,
    then in the tracked columns.  Events without time or without one of the
    keys are left out.
    """
    wanted = events.select(*keys, F.col(at).alias("_at"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)], *tracked)
    known = wanted.dropna(subset=["_at", *keys])
    order = ["_at", *[f"_o{i}" for i in range(len(order_by))], *[c for c in tracked if c not in order_by]]
    window = local_window(keys, order)
    sliced = ranged(known, keys, order, partitions)

    # the last event of each time: the next event of the key is later
    first_of = {"_first": F.min("_at")}
    ahead = with_carry(sliced, keys, first_of, lambda t, _, later: t.withColumn("_ahead", F.first("_first").over(later)), ["_ahead"])
    following = F.coalesce(F.lead("_at").over(window), F.col("_ahead"))
    points = ahead.withColumn("_next", following).filter(F.col("_next").isNull() | (F.col("_next") > F.col("_at")))

    # starts of runs: no event before, or another state
    state = F.struct(*tracked)
    last_state = {"_last": F.max_by(state, F.col("_at"))}
    behind = with_carry(points, keys, last_state, lambda t, earlier, _: t.withColumn("_before", F.last("_last").over(earlier)), ["_before"])
    previous = F.coalesce(F.lag(state).over(local_window(keys, ["_at"])), F.col("_before"))
    starts = behind.withColumn("_previous", previous).filter(F.col("_previous").isNull() | ~F.col("_previous").eqNullSafe(state))

    # ends and numbers of versions
    bounds = {"_first": F.min("_at"), "_count": F.count(F.lit(1))}
    edges = with_carry(starts.select(*keys, *tracked, "_at", *layout(keys)), keys, bounds, lambda t, earlier, later: t
                       .withColumn("_after", F.first("_first").over(later))
                       .withColumn("_done", F.coalesce(F.sum("_count").over(earlier), F.lit(0))), ["_after", "_done"])
    by_time = local_window(keys, ["_at"])
    ended = edges.withColumn("_to", F.coalesce(F.lead("_at").over(by_time), F.col("_after"))) \
        .withColumn("_version", F.col("_done") + F.row_number().over(by_time))
    return drop_layout(ended, keys).select(
        *keys, *tracked, F.col("_version").cast("long").alias("version"), F.col("_at").alias("valid_from"),
        F.col("_to").alias("valid_to"), F.col("_to").isNull().alias("is_current"))


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_at: str | Column, right_at: str,
              columns: list[str], partitions: int | None = None) -> DataFrame:
    """Every row of ``left`` with the ``columns`` of the last row of ``right``
    of the same ``keys`` whose ``right_at`` is not after ``left_at``.

    Both sides are merged in time order and the last version is carried
    along: one pass, no range join, no pairs.  Rows of ``left`` without a key
    or time, or before the first version, get NULLs.  Of rows of ``right``
    with equal key and time the greatest in ``columns`` is taken; those
    without key or time are left out.  ``columns`` must not be columns of
    ``left``.
    """
    clash = set(columns) & set(left.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are on both sides")
    time = F.col(left_at) if isinstance(left_at, str) else left_at
    side = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    version = F.struct(*columns)
    kept = [c for c in left.columns if c not in keys]     # the keys are there already
    rows = left.select(*side, time.alias("_at"), F.lit(1).alias("_kind"), F.struct(*(kept or [F.lit(1)])).alias("_row"),
                       F.lit(None).cast(right.select(version).schema[0].dataType).alias("_version"),
                       F.xxhash64(*left.columns).alias("_tie"))
    versions = right.dropna(subset=[*keys, right_at]).select(
        *side, F.col(right_at).alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"),
        version.alias("_version"), F.lit(0).cast("long").alias("_tie"))
    order = ["_at", "_kind", "_version", "_tie"]           # versions before rows of the same time
    sliced = ranged(rows.unionByName(versions), names, order, partitions)
    upto = local_window(names, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = {"_last": F.max_by("_version", F.when(F.col("_kind") == 0, F.struct("_at", "_version")))}
    both = with_carry(sliced, names, last, lambda t, earlier, _: t.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier)),
                      ["_before"])
    found = F.coalesce(F.last("_version", ignorenulls=True).over(upto), F.col("_before"))
    joined = drop_layout(both.withColumn("_found", found), names).filter(F.col("_kind") == 1)
    return joined.select(*[F.col(f"_k{keys.index(c)}" if c in keys else f"_row.{c}").alias(c) for c in left.columns],
                         *[F.when(F.col("_at").isNotNull(), F.col(f"_found.{c}")).alias(c) for c in columns])
