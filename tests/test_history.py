"""Versions and as-of joins against sequential references, with a hot key."""
import contextlib
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeweave.operators.history import asof_join, history
from lakeweave.operators.prefix import _PART, clamped_running_sum, ranged

T0 = dt.datetime(2024, 1, 1)
EVENTS = "k string, t timestamp, o long, city string, segment string, other int"


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def make_events(seed=1, n=1200):
    """A third of the events are of one key; equal times, NULL states, times and keys."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else rng.choice([f"k{j}" for j in range(30)])
        rows.append((None if i % 97 == 0 else k, at(None if i % 89 == 0 else rng.randrange(n)), i,
                     rng.choice(["a", "b", None]), rng.choice(["x", "x", "y"]), i))
    return rows


def versions(rows):
    """(key, city, segment, version, from, to, is_current), sequentially."""
    by_key = {}
    for k, t, o, city, segment, *_ in rows:
        if k is not None and t is not None:
            points = by_key.setdefault(k, {})
            if t not in points or points[t][0] < o:
                points[t] = (o, city, segment)
    out = []
    for k, points in by_key.items():
        runs = []
        for t in sorted(points):
            if not runs or runs[-1][1:] != points[t][1:]:
                runs.append((t, *points[t][1:]))
        ends = [r[0] for r in runs[1:]] + [None]
        out += [(k, c, s, i + 1, t, e, e is None) for i, ((t, c, s), e) in enumerate(zip(runs, ends))]
    return out


@contextlib.contextmanager
def conf(spark, **values):
    old = {k.replace("__", "."): spark.conf.get(k.replace("__", ".")) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k.replace("__", "."), v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_history_matches_sequential_reference(spark, partitions):
    data = make_events()
    got = history(spark.createDataFrame(data, EVENTS), ["k"], "t", ["city", "segment"], ["o"], partitions=partitions)
    assert got.columns == ["k", "city", "segment", "version", "valid_from", "valid_to", "is_current"]
    assert rows_of(got) == sorted(map(str, versions(data)))


def test_history_without_adaptive_execution(spark):
    data = make_events(2)
    with conf(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        got = rows_of(history(spark.createDataFrame(data, EVENTS), ["k"], "t", ["city", "segment"], ["o"], partitions=5))
    assert got == sorted(map(str, versions(data)))


def test_history_of_runs_over_many_slices(spark):
    """One state for a long time: its run has rows in every slice and is one version."""
    data = [("hot", at(i), i, "a" if i < 500 else "b", "x", i) for i in range(600)] + [("hot", at(600), 600, "a", "x", 0)]
    got = history(spark.createDataFrame(data, EVENTS), ["k"], "t", ["city", "segment"], ["o"], partitions=12).orderBy("version").collect()
    assert [(r.city, r.valid_from, r.valid_to) for r in got] == [("a", at(0), at(500)), ("b", at(500), at(600)), ("a", at(600), None)]


def test_history_of_no_events(spark):
    assert history(spark.createDataFrame([], EVENTS), ["k"], "t", ["city", "segment"], ["o"]).count() == 0


@pytest.mark.parametrize("partitions,aqe", [(None, "true"), (9, "false")])
def test_asof_join_matches_sequential_reference(spark, partitions, aqe):
    rng = random.Random(3)
    data = versions(make_events(4))
    orders = [(i, None if i % 61 == 0 else "hot" if i % 3 == 0 else f"k{rng.randrange(34)}", at(None if i % 67 == 0 else rng.randrange(-50, 1300)))
              for i in range(900)] + [(5000, "hot", data[0][4])]
    left = spark.createDataFrame(orders, "id long, k string, placed timestamp")
    right = spark.createDataFrame(data, "k string, city string, segment string, version long, valid_from timestamp, valid_to timestamp, cur boolean")
    with conf(spark, spark__sql__adaptive__enabled=aqe):
        got = rows_of(asof_join(left, right, ["k"], "placed", "valid_from", ["city", "version", "valid_from"], partitions=partitions))
    want = []
    for i, k, t in orders:
        known = [v for v in data if v[0] == k and t is not None and v[4] <= t]
        last = max(known, key=lambda v: v[4], default=None)
        want.append((i, k, t, *((last[1], last[3], last[4]) if last else (None,) * 3)))
    assert got == sorted(map(str, want))


def test_asof_join_refuses_clashing_columns(spark):
    df = spark.createDataFrame([("a", T0)], "k string, t timestamp")
    with pytest.raises(ValueError):
        asof_join(df, df, ["k"], "t", "t", ["t"])


def test_slices_are_even_whatever_the_times(spark):
    """One time in the year 9999, and a third of the rows at one time: slices within 2x of each other."""
    n = 40_000
    df = spark.range(n).select(
        F.lit("hot").alias("k"),
        F.when(F.col("id") == 0, F.lit(dt.datetime(9999, 1, 1))).when(F.col("id") % 3 == 0, F.lit(T0))
        .otherwise(F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit(T0))).alias("t"), "id", F.lit(-1).alias("c"))
    sliced = ranged(df, ["k"], ["t", "id"], partitions=10)
    sizes = [r["count"] for r in sliced.groupBy(_PART).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * min(sizes)
    out = clamped_running_sum(df, ["k"], ["t", "id"], "c", n, "s", partitions=10)
    assert out.agg(F.min("s"), F.max("s"), F.count_distinct("s")).first() == (0, n - 1, n)
