"""Star schema: dimensions with surrogate keys, facts that refer to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .history import asof_join
from .prefix import running_sum

UNKNOWN = 0              # surrogate key of the member that stands for "no such member"


def dimension(members: DataFrame, natural: list[str], key: str, stored: DataFrame | None = None) -> DataFrame:
    """``key`` and the columns of ``members``, one row a natural key, and the
    unknown member (all NULL, key ``UNKNOWN``).

    Keys are stable over loads: members that ``stored`` (an earlier result)
    has keep their key and get the new attributes, those that are gone stay;
    new ones are numbered after its greatest key, in the order of the natural
    key.  Numbering goes over slices of that order with one carry a slice, not
    through one task.  ``members`` must hold each natural key once, without
    NULLs in it.
    """
    columns = members.columns
    unknown = members.sparkSession.range(1).select(F.lit(UNKNOWN).cast("long").alias(key),
                                                   *[F.lit(None).cast(members.schema[c].dataType).alias(c) for c in columns])
    if stored is None:
        new, kept, top = members, None, UNKNOWN
    else:
        known = stored.filter(F.col(key) != UNKNOWN)
        top = known.agg(F.max(key)).first()[0] or UNKNOWN
        new = members.join(known.select(*natural), natural, "left_anti")
        rest = [c for c in columns if c not in natural]
        fresh = members.select(*natural, F.lit(True).alias("_here"), *[F.col(c).alias(f"_new_{c}") for c in rest])
        kept = known.join(fresh, natural, "left").select(
            key, *[F.col(c) if c in natural else F.when(F.col("_here"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns])
    numbered = running_sum(new.select(*columns), [], natural, F.lit(1), key).withColumn(key, (F.col(key) + F.lit(top)).cast("long"))
    out = unknown.unionByName(numbered.select(key, *columns))
    return out if kept is None else out.unionByName(kept)


def resolve(facts: DataFrame, dim: DataFrame, natural: list[str], key: str) -> DataFrame:
    """``facts`` with the surrogate ``key`` of their natural key (``UNKNOWN`` where there is none)."""
    keys = dim.filter(F.col(key) != UNKNOWN).select(*natural, key)
    return facts.join(keys, natural, "left").withColumn(key, F.coalesce(key, F.lit(UNKNOWN).cast("long")))


def resolve_version(facts: DataFrame, dim: DataFrame, natural: list[str], at, key: str, valid_from: str = "valid_from") -> DataFrame:
    """``facts`` with the ``key`` of the member's version at the time ``at``
    (``UNKNOWN`` before the first version), by an as-of join."""
    versions = dim.filter(F.col(key) != UNKNOWN).select(*natural, valid_from, key)
    return asof_join(facts, versions, natural, at, valid_from, [key]).withColumn(key, F.coalesce(key, F.lit(UNKNOWN).cast("long")))
