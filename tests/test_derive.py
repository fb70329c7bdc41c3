"""R1-R5 business-rule operators."""
import datetime as dt

from helpers import envelope
from lakeweave.operators import derive
from lakeweave.operators.bronze import to_bronze
from lakeweave.schemas import ENTITY

T = dt.datetime
ITEMS = "array<struct<product_id:string,product_name:string,quantity:int,unit_price:double>>"


def _orders(spark, rows):
    return spark.createDataFrame(
        rows, f"order_id string, customer_id string, order_status string, items {ITEMS}, "
              f"total_amount double, created_at string, created_at_ts timestamp")


def test_order_total_check(spark):
    df = _orders(spark, [
        ("O1", "C", "created", [("P1", "A", 2, 1.25), ("P2", "B", 1, 3.0)], 5.5, "t", T(2024, 1, 1)),
        ("O2", "C", "created", [("P1", "A", 1, 1.0)], 9.0, "t", T(2024, 1, 1)),
        ("O3", "C", "created", [], 0.0, "t", T(2024, 1, 1)),
        ("O4", "C", "created", None, 1.0, "t", T(2024, 1, 1))])
    got = {r.order_id: (r.items_total, r.matches) for r in derive.order_total_check(df).collect()}
    assert got == {"O1": (5.5, True), "O2": (1.0, False), "O3": (0.0, True), "O4": (0.0, False)}


def test_stock_movements_and_payable_exclude_cancelled(spark):
    df = _orders(spark, [
        ("O1", "C", "created", [("P1", "A", 2, 1.0), ("P2", "B", 1, 3.0)], 5.0, "t1", T(2024, 1, 1)),
        ("O2", "C", "cancelled", [("P1", "A", 4, 1.0)], 4.0, "t2", T(2024, 1, 1))])
    mv = derive.stock_movements(df).collect()
    assert [(r.product_id, r.quantity_change, r.warehouse_id, r.change_reason) for r in mv] == \
        [("P1", -2, "WH_HN", "sale"), ("P2", -1, "WH_HCM", "sale")]
    pay = derive.payable_orders(df).collect()
    assert [(r.order_id, r.amount) for r in pay] == [("O1", 5.0)]


def test_running_stock_floors_at_zero(spark):
    mv = spark.createDataFrame(
        [("P1", "WH_HN", -300, T(2024, 1, 1, 0, 0, i), f"O{i}", 0) for i in range(3)],
        "product_id string, warehouse_id string, quantity_change int, created_at_ts timestamp, "
        "order_id string, item_pos int")
    got = [r.quantity_on_hand for r in
           derive.running_stock(mv, ["created_at_ts", "order_id", "item_pos"]).orderBy("created_at_ts").collect()]
    assert got == [200, 0, 0]


def test_classify_customers(spark):
    def c(cid, name, seg, ts):
        return {"customer_id": cid, "full_name": name, "email": f"{name}@x", "phone": name, "address": "a" + name,
                "city": "Hà Nội", "segment": seg, "created_at": ts, "updated_at": ts, "event_type": "?"}
    vals = [c("C1", "second", "vip", "2024-01-02T00:00:00+00:00"),
            c("C1", "first", "regular", "2024-01-01T00:00:00+00:00"),
            c("C2", "only", "vip", "2024-01-03T00:00:00+00:00")]
    b = to_bronze(envelope(spark, "customers", vals), ENTITY["customers"], stamp=False)
    rows = {(r.customer_id, r.updated_at): r for r in derive.classify_customers(b).collect()}
    first = rows[("C1", "2024-01-01T00:00:00+00:00")]
    later = rows[("C1", "2024-01-02T00:00:00+00:00")]
    assert (first.event_type, first.segment, first.full_name) == ("customer_created", "new", "first")
    assert (later.event_type, later.segment, later.full_name, later.address) == \
        ("customer_updated", "vip", "first", "asecond")
    assert later.created_at == "2024-01-01T00:00:00+00:00"
    assert rows[("C2", "2024-01-03T00:00:00+00:00")].event_type == "customer_created"


def test_classify_customers_unparsable_time_is_not_first(spark):
    def c(name, ts):
        return {"customer_id": "C1", "full_name": name, "email": "e", "phone": "p", "address": "a",
                "city": "x", "segment": "vip", "created_at": ts, "updated_at": ts, "event_type": "?"}
    b = to_bronze(envelope(spark, "customers", [c("bad", "garbage"), c("good", "2024-01-01T00:00:00+00:00")]),
                  ENTITY["customers"], stamp=False)
    rows = {r.updated_at: r for r in derive.classify_customers(b).collect()}
    assert rows["2024-01-01T00:00:00+00:00"].event_type == "customer_created"
    assert rows["garbage"].event_type == "customer_updated" and rows["garbage"].full_name == "good"


def test_classify_hot_customer_without_adaptive_plans(spark):
    """One customer holds a third of the events; its events are dealt by salt."""
    from pyspark.sql import functions as F
    ev = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 89 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("customer_id"),
        *[F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in ("full_name", "email", "phone", "address", "city", "segment")],
        F.lit("2024-01-01T00:00:00+00:00").alias("created_at"), F.lit("2024-01-01T00:00:00+00:00").alias("updated_at"),
        F.col("id").alias("offset"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = derive.classify_customers(ev).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == ev.filter("customer_id is not null").count()
    hot = [r for r in rows if r.customer_id == "hot"]
    assert len(hot) == 300 and {r.full_name for r in hot} == {"full_name0"}
    assert sum(r.event_type == "customer_created" for r in rows) == 8 and None not in {r.customer_id for r in rows}
