"""Top-N, sessions and gaps, layer tests, references and the star schema."""
import contextlib
import datetime as dt
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeweave.operators.integrity import column_tests, key_filter, layer_tests, orphans, with_maybe
from lakeweave.operators.ranking import top_n
from lakeweave.operators.sessions import session_gaps, sessions_stream
from lakeweave.operators.star import UNKNOWN, dimension, resolve, resolve_version
from lakeweave.streaming.runner import run_append

T0 = dt.datetime(2024, 1, 1)


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


# --- top-N ---------------------------------------------------------------------
def test_top_n_of_a_hot_group(spark):
    """A third of the rows in one window, ties and NULL values."""
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"w{rng.randrange(20)}", f"p{i:05d}", rng.choice([None, 1, 5, 5, 9])) for i in range(4000)]
    rows.append(("hot", None, 9))
    df = spark.createDataFrame(rows, "w string, p string, v int")
    got = top_n(df, ["w"], "v", ["p"], 7)
    want = []
    for w in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == w), key=lambda r: (r[2] is None, -(r[2] or 0), r[1] is not None, r[1] or ""))
        want += [(*r, i + 1) for i, r in enumerate(mine[:7])]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    text = plan(got)
    assert text.count("WindowGroupLimit") >= 2             # parts are cut down before they are shuffled


# --- sessions --------------------------------------------------------------------
def make_orders(seed=2, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else f"k{rng.randrange(25)}"
        minutes = rng.randrange(200) * (30 if k == "hot" else 400)
        rows.append((None if i % 101 == 0 else k, None if i % 103 == 0 else T0 + dt.timedelta(minutes=minutes), i, float(rng.randrange(100))))
    return rows


def sessions(rows, gap):
    rows = [r for r in rows if r[0] is not None and r[1] is not None]
    end, out = max(r[1] for r in rows), []
    for k in {r[0] for r in rows}:
        runs = []
        for r in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])):
            if not runs or r[1] > runs[-1][-1][1] + gap:
                runs.append([])
            runs[-1].append(r)
        for i, run in enumerate(runs):
            after = runs[i + 1][0][1] if i + 1 < len(runs) else None
            out.append((k, i + 1, run[0][1], run[-1][1], len(run), sum(r[3] for r in run), after, after is not None or run[-1][1] + gap <= end))
    return sorted(map(str, out))


@pytest.mark.parametrize("partitions", [None, 1, 11])
def test_session_gaps_match_sequential_reference(spark, partitions):
    rows = make_orders()
    df = spark.createDataFrame(rows, "k string, t timestamp, id long, amount double")
    got = session_gaps(df, ["k"], "t", "2 hours", ["id"], {"spent": F.sum("amount")}, partitions=partitions)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sessions(rows, dt.timedelta(hours=2))


def test_a_session_over_many_slices_is_one(spark):
    rows = [("hot", T0 + dt.timedelta(minutes=i), i, 1.0) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t timestamp, id long, amount double")
    (r,) = session_gaps(df, ["k"], "t", "1 minutes", ["id"], {"spent": F.sum("amount")}, partitions=9).collect()
    assert (r.session, r.events, r.spent, r.next_start, r.gone) == (1, 500, 500.0, None, False)


def test_stream_emits_a_customer_when_the_gap_has_passed(spark, tmp):
    schema = "k string, t timestamp, amount double"

    def feed(i, rows):
        spark.createDataFrame([(k, T0 + dt.timedelta(hours=h), 1.0) for k, h in rows], schema).write.parquet(f"{tmp}/in/part-{i}")
        src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp}/in")
        out = sessions_stream(src, ["k"], "t", "10 hours", {"spent": F.sum("amount")}, "1 hours")
        run_append(out, f"{tmp}/out", f"{tmp}/ckpt", trigger="availableNow").awaitTermination()
        return sorted((r.k, r.events) for r in spark.read.schema(out.schema).parquet(f"{tmp}/out").collect())

    assert feed(0, [("a", 0), ("a", 5), ("b", 6)]) == []
    assert feed(1, [("b", 15)]) == []                      # watermark at 14 h; a's gap ends at 15 h
    assert feed(2, [("c", 20)]) == [("a", 2)]              # 19 h: a is gone, b may still come back until 25 h
    with pytest.raises(ValueError):
        sessions_stream(spark.createDataFrame([], schema), ["k"], "t", "1 hours", {}, "1 hours")


# --- tests of layers ---------------------------------------------------------------
def test_column_tests_count_exactly(spark):
    rng = random.Random(3)
    rows = [(None if i % 3 == 0 else rng.randrange(300), "same" if i % 2 else f"v{i}", None if i == 5 else T0) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, t timestamp")
    got = {(r.column_name, r.test): (r.failures, r.rows) for r in column_tests(df, ["a", "t"], ["a", "b"]).collect()}
    doubles = lambda c: sum(n - 1 for v, n in Counter(r[c] for r in rows).items() if v is not None)
    assert got == {("a", "not_null"): (334, 1000), ("t", "not_null"): (1, 1000), ("a", "unique"): (doubles(0), 1000), ("b", "unique"): (doubles(1), 1000)}


def test_layer_tests_read_a_layer_once_and_know_empty_ones(spark, tmp):
    spark.range(10).selectExpr("id", "id % 4 AS k").write.parquet(f"{tmp}/l")
    df = spark.read.parquet(f"{tmp}/l")
    assert plan(column_tests(df, ["id", "k"], ["id", "k"])).count("Scan parquet") == 2     # once in the tree, once in its description
    out = layer_tests({"x": (df, ["id"], ["k"]), "none": (df.filter("id < 0"), ["id"], ["k"])}).collect()
    assert sorted((r.layer, r.test, r.failures, r.rows) for r in out) == [
        ("none", "not_null", 0, 0), ("none", "unique", 0, 0), ("x", "not_null", 0, 10), ("x", "unique", 6, 10)]


# --- references ---------------------------------------------------------------------
@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
def test_orphans_equal_a_plain_anti_join(spark, bits):
    """Also where the filter is nearly full and most absent keys pass it."""
    child = spark.range(3000).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("o"), (F.col("id") % 2000).cast("string"))).alias("ref"))
    child = child.unionByName(spark.range(1000).select((F.col("id") + 9000).alias("id"), F.lit("o1").alias("ref")))
    parent = spark.range(60_000).filter("id % 5 > 0").select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("key"), F.lit(1).alias("x"))
    parent = parent.unionByName(spark.createDataFrame([(None, 1), ("o1", 2)], "key string, x int"))
    got = {r.id for r in orphans(child, "ref", parent, "key", bits).collect()}
    want = {r.id for r in child.filter("ref is not null").join(parent, F.col("ref") == F.col("key"), "left_anti").collect()}
    assert got == want and want


def test_key_filter_has_no_false_negatives_and_is_bounded(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    bitmaps = key_filter(keys, "k", 1 << 18)
    assert bitmaps.count() <= 8 and bitmaps.agg(F.max(F.length("_bits"))).first()[0] == 4096
    probe = spark.range(20_000).select("id", F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    found = with_maybe(probe, "k", bitmaps, 1 << 18).filter("_maybe")
    assert found.filter("id < 5000").count() == 5000 and found.filter("id >= 5000").count() < 1000


# --- star schema --------------------------------------------------------------------
MEMBER = "id string, since int, city string"


def test_keys_are_stable_over_loads(spark, tmp):
    first = spark.createDataFrame([(f"c{i:03d}", 1, "a") for i in range(0, 100, 2)], MEMBER)
    one = dimension(first, ["id", "since"], "key")
    one.write.parquet(f"{tmp}/one")
    one = spark.read.parquet(f"{tmp}/one")
    keys = {r.id: r.key for r in one.collect()}
    assert keys[None] == UNKNOWN and [keys[f"c{i:03d}"] for i in range(0, 100, 2)] == list(range(1, 51))
    second = spark.createDataFrame([(f"c{i:03d}", 1, "b") for i in range(1, 100)], MEMBER)      # c000 is gone, odd ones are new
    two = {r.id: (r.key, r.city) for r in dimension(second, ["id", "since"], "key", stored=one).collect()}
    assert all(two[i][0] == k for i, k in keys.items()) and two["c000"] == (1, "a") and two["c002"] == (2, "b")
    assert sorted(k for k, _ in two.values()) == list(range(101)) and [two[f"c{i:03d}"][0] for i in (1, 3, 99)] == [51, 52, 100]


def test_facts_without_a_member_get_the_unknown_key(spark):
    dim = dimension(spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], MEMBER), ["id"], "key")
    facts = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "id string, n int")
    assert {r.n: r.key for r in resolve(facts, dim, ["id"], "key").collect()} == {1: 1, 2: UNKNOWN, 3: UNKNOWN}
    versions = dimension(spark.createDataFrame([("a", T0), ("a", T0 + dt.timedelta(days=2))], "id string, valid_from timestamp"), ["id", "valid_from"], "key")
    sold = spark.createDataFrame([(i, "a", T0 + dt.timedelta(days=i)) for i in (-1, 0, 1, 2, 3)] + [(9, "z", T0)], "n int, id string, at timestamp")
    got = {r.n: r.key for r in resolve_version(sold, versions, ["id"], "at", "key").collect()}
    assert got == {-1: UNKNOWN, 0: 1, 1: 1, 2: 2, 3: 2, 9: UNKNOWN}


def test_numbering_goes_over_slices(spark):
    df = spark.range(5000).select(F.format_string("m%05d", "id").alias("id"), F.lit(1).alias("since"), F.lit("x").alias("city"))
    got = dimension(df, ["id", "since"], "key").filter("key > 0")
    assert got.filter(F.col("key") != F.substring("id", 2, 5).cast("long") + 1).count() == 0 and got.count() == 5000


def test_stream_of_orphans(spark, tmp):
    """A payment waits for its order; without one it comes out once the watermark of both streams has passed."""
    from lakeweave.operators.integrity import orphans_stream

    def at(h):
        return T0 + dt.timedelta(hours=h)

    def feed(i, payments, orders):
        for name, rows, ddl in (("pay", payments, "pid string, oid string, paid timestamp"), ("ord", orders, "number string, placed timestamp")):
            spark.createDataFrame([(*r[:-1], at(r[-1])) for r in rows], ddl).write.parquet(f"{tmp}/{name}/part-{i}")
        src = {n: spark.readStream.schema(ddl).option("recursiveFileLookup", "true").parquet(f"{tmp}/{n}")
               for n, ddl in (("pay", "pid string, oid string, paid timestamp"), ("ord", "number string, placed timestamp"))}
        out = orphans_stream(src["pay"], "oid", "paid", src["ord"], "number", "placed", "6 hours", "1 hours")
        run_append(out, f"{tmp}/out", f"{tmp}/ckpt", trigger="availableNow").awaitTermination()
        return sorted(r.pid for r in spark.read.schema(out.schema).parquet(f"{tmp}/out").collect())

    assert feed(0, [("p1", "o1", 0), ("p2", "o2", 1), ("p3", None, 1)], [("o1", 2), ("o1", 3)]) == []
    assert feed(1, [("p4", "o4", 20)], [("o9", 5)]) == []          # orders are slow: o2 may still come
    assert feed(2, [("p5", "o5", 21)], [("o2", 12), ("o9", 30)]) == ["p2"]         # o2 came 11 hours later: too late


def test_one_unique_column_is_counted_without_copies(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), (None, None)], "k string, v int")
    out = column_tests(df, ["k", "v"], ["k"])
    assert {(r.column_name, r.test): (r.failures, r.rows) for r in out.collect()} == {
        ("k", "not_null"): (1, 4), ("v", "not_null"): (2, 4), ("k", "unique"): (1, 4)}
    # one row a row, by its own value: the one explode left lists the three tests
    tree = out._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("Generate explode") <= 1 and "Join" not in tree
    none = column_tests(df.limit(0), ["v"], ["k"]).collect()
    assert sorted((r.test, r.failures, r.rows) for r in none) == [("not_null", 0, 0), ("unique", 0, 0)]
    assert [(r.failures, r.rows) for r in column_tests(df, ["v"], []).collect()] == [(2, 4)]


def test_facts_look_a_version_up_once_an_order(spark, monkeypatch):
    from lakeweave.plans import catalog
    seen, real = [], catalog.resolve_version
    monkeypatch.setattr(catalog, "resolve_version", lambda facts, *a: seen.append(facts) or real(facts, *a))
    facts = catalog.q_fact_order_items(spark, "/root/testdata/sf0.001")
    assert facts.count() > seen[0].count() == seen[0].select("order_id").distinct().count()
