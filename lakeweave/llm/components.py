"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014).  Every step is a group minimum (pre-aggregated on the map
side) and a join; edges never leave the executors.  Each round is written
to the shared folder, so lineage stays short and lost executors cost at
most one round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, staged


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> ``node, label`` of every node that has an
    edge to another one; the label is the smallest node of the component."""
    e = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .filter("a <> b").distinct(), "edges")
    state, was = _state(e), e
    while state[0]:
        # large star: every node's larger neighbours point to its smallest neighbour
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        e = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: every node's smaller neighbours, and itself, point to the smallest
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        joined = e.join(low, "a")
        before, e = was, staged(joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                                .unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "edges")
        was = e
        drop_staged(before)
        new = _state(e)
        if new == state:
            break
        state = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
