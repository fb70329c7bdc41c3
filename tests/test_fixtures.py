"""Test-table -> message mapping: the bounded item array of hot orders and
partitioned sinks."""
import datetime as dt

import pytest

from pyspark.sql import functions as F

from lakeweave.operators.bronze import to_bronze
from lakeweave.schemas import ENTITY
from lakeweave.sources import testdata


LINE_SCHEMA = ("l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, "
               "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz")


def _tables(spark, root):
    spark.createDataFrame(
        [(1, 7, "F", 100.0, dt.datetime(1995, 1, 1), "1-URGENT"),
         (2, 8, "O", 55.5, dt.datetime(1995, 1, 2), "5-LOW")],          # no lines
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{root}/orders.parquet")
    ship = dt.datetime(1995, 2, 1)
    lines = [(1, 10 + i, i % 7 + 1, 3, float(i + 1), 10.0 * (i + 1), ship) for i in range(9)]   # one "hot" order
    spark.createDataFrame(lines, LINE_SCHEMA).write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(10 + i, f"part{i}") for i in range(9)], "p_partkey long, p_name string") \
        .write.parquet(f"{root}/part.parquet")


def test_orders_are_cut_by_one_rule(spark, tmp, monkeypatch):
    _tables(spark, tmp)
    monkeypatch.setattr(testdata, "PART_LINES", 4)
    rows = to_bronze(testdata.order_messages(spark, tmp), ENTITY["orders"], stamp=False).collect()
    hot = sorted((r for r in rows if r.order_id.startswith("ORD000000000001")), key=lambda r: r.order_id)
    assert [r.order_id for r in hot] == [f"ORD000000000001-{c}" for c in range(3)]
    assert [len(r["items"]) for r in hot] == [4, 4, 1]
    # cut in the order of the part key (all below the number of ranges)
    assert [it.product_id for r in hot for it in r["items"]] == [f"P{10 + i:06d}" for i in range(9)]
    assert [r.total_amount for r in hot] == [100.0, 260.0, 90.0]
    assert len({r.offset for r in hot}) == 3
    assert hot[0].customer_id == "CUST00007" and hot[0].order_status == "shipped"
    assert hot[0].created_at == "1995-01-01T00:00:01.000000+00:00"
    empty = [r for r in rows if r.order_id == "ORD000000000002-0"]
    assert len(empty) == 1 and empty[0]["items"] == [] and empty[0].total_amount == 55.5
    assert empty[0].order_status == "cancelled"


def test_equal_lines_reach_over_parts(spark, tmp, monkeypatch):
    _tables(spark, tmp)
    ship = dt.datetime(1995, 2, 1)
    spark.createDataFrame([(1, 10, i, 3, 1.0, 10.0, ship) for i in range(10)], LINE_SCHEMA) \
        .write.mode("append").parquet(f"{tmp}/lineitem.parquet")          # ten more like the order's first line
    monkeypatch.setattr(testdata, "PART_LINES", 4)
    parts = {r.part: (len(r["items"]), r.total) for r in testdata.order_parts(spark, tmp).collect()}
    assert parts == {0: (4, 40.0), 1: (4, 40.0), 2: (4, 10.0 * 3 + 20.0), 3: (4, 30.0 + 40 + 50 + 60), 4: (3, 70.0 + 80 + 90)}


def test_partitioned_append_sink(spark, tmp):
    from lakeweave.sources.layers import read_layer_stream
    from lakeweave.streaming.runner import run_append
    import os
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").write.parquet(f"{tmp}/src")
    stream = read_layer_stream(spark, f"{tmp}/src", spark.createDataFrame([], "k string, v int").schema)
    q = run_append(stream.withColumn("day", F.lit("2024-01-01")), f"{tmp}/out", f"{tmp}/ckpt",
                   trigger="availableNow", partition_by=("day",))
    q.awaitTermination()
    assert os.path.isdir(f"{tmp}/out/day=2024-01-01")


def test_line_without_part_is_kept(spark, tmp):
    _tables(spark, tmp)
    spark.createDataFrame([(3, 9, "P", 12.5, dt.datetime(1995, 1, 3), "2-HIGH")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string") \
        .write.mode("append").parquet(f"{tmp}/orders.parquet")
    spark.createDataFrame([(3, 999, 1, 1, 1.0, 5.0, dt.datetime(1995, 2, 2))],    # part 999 does not exist
                          LINE_SCHEMA).write.mode("append").parquet(f"{tmp}/lineitem.parquet")
    rows = to_bronze(testdata.order_messages(spark, tmp), ENTITY["orders"], stamp=False).collect()
    orphan = [r for r in rows if r.order_id == "ORD000000000003-0"]
    assert len(orphan) == 1 and orphan[0].total_amount == 5.0
    assert [(i.product_id, i.product_name, i.quantity) for i in orphan[0]["items"]] == [("P000999", None, 1)]
    inv = to_bronze(testdata.inventory_messages(spark, tmp), ENTITY["inventory"], stamp=False).collect()
    assert len(inv) == 10 and [r.product_name for r in inv if r.product_id == "P000999"] == [None]


def test_lineitem_is_scanned_once(spark, tmp):
    _tables(spark, tmp)
    df = testdata.order_messages(spark, tmp)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet [l_orderkey") == 1 and "ReusedExchange" in plan
    assert "partial_count" in plan                       # equal lines are counted before any shuffle


HOT = ["bronze_orders", "silver_orders", "gold_product_units_1m", "gold_customer_activity_1h", "order_total_check",
       "stock_movements", "running_stock", "payable_orders"]


@pytest.fixture(scope="module")
def hot_tables(spark, tmp_path_factory):
    """sf0.001 with a third of lineitem in one order, half of it equal lines."""
    root = str(tmp_path_factory.mktemp("hot"))
    src = "/root/testdata/sf0.001"
    for t in ("part", "orders", "customer", "events"):
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{root}/{t}.parquet")
    li = spark.read.parquet(f"{src}/lineitem.parquet")
    key = spark.read.parquet(f"{src}/orders.parquet").filter(
        "o_orderkey % 83 <> 0 and o_orderkey % 97 <> 0 and o_orderkey % 101 <> 0 and o_orderkey % 89 <> 0").agg(F.min("o_orderkey")).first()[0]
    pick = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(6))
    own = {"l_orderkey": F.lit(key).cast(li.schema["l_orderkey"].dataType)}
    same = {**own, "l_partkey": F.lit(7).cast(li.schema["l_partkey"].dataType), "l_quantity": F.lit(3).cast(li.schema["l_quantity"].dataType),
            "l_extendedprice": F.lit(30.5).cast(li.schema["l_extendedprice"].dataType)}
    hot = li.withColumn("_p", pick)
    for name in same:
        old = F.col(name)
        hot = hot.withColumn(name, F.when(F.col("_p") == 0, same[name]).when((F.col("_p") == 1) & F.lit(name in own), own.get(name, old)).otherwise(old))
    hot.drop("_p").write.parquet(f"{root}/lineitem.parquet")
    return root


@pytest.mark.parametrize("name", HOT)
def test_hot_order_matches_the_oracle(spark, hot_tables, name):
    import duckdb
    from lakeweave.plans.catalog import all_queries
    from lakeweave.plans.oracle import oracle_sql
    from test_entry import _bag
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "customer", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{hot_tables}/{t}.parquet/*.parquet')")
    df = all_queries()[name](spark, hot_tables)
    res = con.sql(oracle_sql()[name])
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(res.columns, res.fetchall())


def test_short_orders_are_not_ranked(spark, tmp):
    # no order is longer than PART_LINES: its lines are counted and collected, nothing else
    _tables(spark, tmp)
    df = testdata.order_parts(spark, tmp)
    assert [len(r["items"]) for r in df.collect()] == [9]
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in plan and plan.count("FileScan parquet [l_orderkey") == 1


@pytest.mark.parametrize("topic", sorted(testdata.MESSAGES))
def test_message_times_are_the_messages_own(spark, topic):
    sf = "/root/testdata/sf0.001"
    ends = lambda df: df.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert ends(testdata.message_times(spark, sf, topic)) == ends(testdata.messages(spark, sf, topic))


def test_order_zero_is_cut_like_any_other(spark, tmp, monkeypatch):
    _tables(spark, tmp)
    ship = dt.datetime(1995, 2, 1)
    spark.createDataFrame([(0, 10 + i, i, 3, 1.0, 10.0, ship) for i in range(6)] + [(4, 10, 1, 3, 1.0, 10.0, ship)], LINE_SCHEMA) \
        .write.mode("append").parquet(f"{tmp}/lineitem.parquet")
    monkeypatch.setattr(testdata, "PART_LINES", 4)
    parts = sorted((r.l_orderkey, r.part, len(r["items"])) for r in testdata.order_parts(spark, tmp).collect())
    assert parts == [(0, 0, 4), (0, 1, 2), (1, 0, 4), (1, 1, 4), (1, 2, 1), (4, 0, 1)]
