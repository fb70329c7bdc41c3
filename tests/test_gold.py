"""Windowed aggregates and their physical plans."""
import datetime as dt


from lakeweave.operators import gold
from lakeweave.schemas import ENTITY, silver_schema

T = dt.datetime


def _orders(spark, rows):
    """rows: (order_id, customer_id, status, items, total, ts)"""
    schema = "order_id string, customer_id string, order_status string, " \
             "items array<struct<product_id:string,product_name:string,quantity:int,unit_price:double>>, " \
             "total_amount double, created_at_ts timestamp"
    return spark.createDataFrame(rows, schema)


def test_window_edges_start_inclusive_end_exclusive(spark):
    pays = spark.createDataFrame(
        [(10.0, T(2024, 1, 1, 0, 4, 59)), (20.0, T(2024, 1, 1, 0, 5, 0)), (30.0, T(2024, 1, 1, 0, 5, 0))],
        "amount double, created_at_ts timestamp")
    rows = {r.window_start: (r.total_revenue, r.transaction_count)
            for r in gold.revenue(pays, "5 minutes").collect()}
    assert rows == {T(2024, 1, 1, 0, 0): (10.0, 1), T(2024, 1, 1, 0, 5): (50.0, 2)}
    out = gold.revenue(pays, "5 minutes")
    assert out.columns == ["window_start", "window_end", "total_revenue", "transaction_count"]


def test_product_units_explode_skips_null_and_empty(spark):
    it = [("P1", "A", 2, 1.0), ("P2", "B", 1, 1.0)]
    df = _orders(spark, [("O1", "C1", "created", it, 3.0, T(2024, 1, 1, 0, 0, 30)),
                         ("O2", "C1", "created", [], 1.0, T(2024, 1, 1, 0, 0, 40)),
                         ("O3", "C1", "created", None, 1.0, T(2024, 1, 1, 0, 0, 50)),
                         ("O4", "C2", "cancelled", [("P1", "A", 5, 1.0)], 5.0, T(2024, 1, 1, 0, 0, 55))])
    got = {(r.product_id, r.total_quantity_sold) for r in gold.product_units(df, "1 minute").collect()}
    assert got == {("P1", 7), ("P2", 1)}
    paid = {(r.product_id, r.total_quantity_sold)
            for r in gold.product_units(df, "1 minute", exclude_status=("cancelled",)).collect()}
    assert paid == {("P1", 2), ("P2", 1)}


def test_customer_activity(spark):
    df = _orders(spark, [("O1", "C1", "created", [], 3.0, T(2024, 1, 1, 0, 10)),
                         ("O2", "C1", "created", [], 4.0, T(2024, 1, 1, 0, 50)),
                         ("O3", "C2", "created", [], 5.0, T(2024, 1, 1, 1, 0))])
    got = {(r.customer_id, r.window_start): (r.order_count, r.total_spent, r.last_order_at)
           for r in gold.customer_activity(df, "1 hour").collect()}
    assert got == {("C1", T(2024, 1, 1)): (2, 7.0, T(2024, 1, 1, 0, 50)),
                   ("C2", T(2024, 1, 1, 1)): (1, 5.0, T(2024, 1, 1, 1, 0))}


def plan_text(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _read_schema(text: str) -> str:
    return text.split("ReadSchema:")[1].split("\n")[0].strip()


def test_scan_is_pruned_and_aggregation_is_partial(spark, tmp):
    schema = silver_schema(ENTITY["orders"], stamp=False)
    spark.createDataFrame([], schema).write.parquet(f"{tmp}/orders")
    silver = spark.read.schema(schema).parquet(f"{tmp}/orders")

    units = plan_text(gold.product_units(silver, "1 hour"))
    assert "unit_price" not in _read_schema(units)          # nested pruning through arrays_zip
    assert "partial_sum" in units                           # map-side combine before the shuffle

    pschema = silver_schema(ENTITY["payments"], stamp=False)
    spark.createDataFrame([], pschema).write.parquet(f"{tmp}/payments")
    rev = plan_text(gold.revenue(spark.read.schema(pschema).parquet(f"{tmp}/payments"), "5 minutes"))
    assert _read_schema(rev) == "struct<amount:double,created_at_ts:timestamp>"
    assert "partial_count" in rev


def test_silver_keep_prunes_bronze_scan(spark, tmp):
    from lakeweave.operators.silver import silver_entity
    from lakeweave.schemas import bronze_schema
    schema = bronze_schema(ENTITY["payments"], stamp=False)
    spark.createDataFrame([], schema).write.parquet(f"{tmp}/bronze")
    bronze = spark.read.schema(schema).parquet(f"{tmp}/bronze")
    read = _read_schema(plan_text(gold.revenue(silver_entity(bronze, "payments", stamp=False,
                                                             keep=["amount"]), "5 minutes")))
    for unused in ("currency", "payment_method", "customer_id", "event_type", "kafka_key", "topic"):
        assert unused not in read
    for needed in ("payment_id", "amount", "created_at", "payment_status", "offset"):
        assert needed in read
