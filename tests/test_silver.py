"""P5, F1-F6, D1/D2 batch forms: silver rules and reject counts."""
import datetime as dt

from helpers import envelope, inventory, order, payment
from lakeweave.functions.rules import rules_for
from lakeweave.operators.bronze import to_bronze
from lakeweave.operators.dedup import dedup_first, dedup_latest, dedup_stream
from lakeweave.operators.silver import reject_counts, silver_entity, to_silver
from lakeweave.schemas import ENTITY

import pytest


def _bronze(spark, topic, vals):
    return to_bronze(envelope(spark, topic, vals), ENTITY[topic], stamp=False)


def test_payment_rules(spark):
    vals = [
        payment("P0"),                                   # kept
        payment("P1", amount="x"), payment("P2", amount=0), payment("P3", amount=-5),
        payment("P4", amount=None),
        {k: v for k, v in payment("P5").items() if k != "amount"},
        payment("P6", status="failed"), payment("P7", status="pending"), payment("P8", status=None),
        payment("P9", status="SUCCESS"),
        payment("P10", created_at="garbage"), payment("P11", created_at=""),
        payment("P12", oid=None), payment(None),
        payment("P13", amount=float("nan")),              # NaN > 0: kept by default
    ]
    kept = {r.payment_id for r in to_silver(_bronze(spark, "payments", vals), rules_for("payments")).collect()}
    assert kept == {"P0", "P13"}
    strict = to_silver(_bronze(spark, "payments", vals), rules_for("payments", reject_nan=True))
    assert {r.payment_id for r in strict.collect()} == {"P0"}


def test_event_time_parsing(spark):
    vals = [payment("A", created_at="2024-01-01"), payment("B", created_at="2024-01-01T07:00:00+07:00"),
            payment("C", created_at="2024-01-01T00:00:09Z"),
            payment("D", created_at="2024-01-01T00:00:07.179575+00:00")]
    rows = {r.payment_id: r.created_at_ts for r in
            to_silver(_bronze(spark, "payments", vals), rules_for("payments"), stamp=False).collect()}
    assert rows["A"] == dt.datetime(2024, 1, 1)                     # date only -> midnight
    assert rows["B"] == dt.datetime(2024, 1, 1)                     # +07:00 converted to UTC
    assert rows["C"] == dt.datetime(2024, 1, 1, 0, 0, 9)
    assert rows["D"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)


def test_inventory_rules(spark):
    vals = [inventory("I0", on_hand=0), inventory("I1", on_hand=-1), inventory("I2", on_hand=None),
            inventory("I3", pid=None), inventory("I4", on_hand=3)]
    kept = {r.inventory_id for r in to_silver(_bronze(spark, "inventory", vals), rules_for("inventory")).collect()}
    assert kept == {"I0", "I4"}


def test_orders_keep_null_and_empty_items(spark):
    vals = [order("O1", items=[]), order("O2", items=None), order("O3", cid=None), order("O4", total=0)]
    kept = {r.order_id for r in to_silver(_bronze(spark, "orders", vals), rules_for("orders")).collect()}
    assert kept == {"O1", "O2"}


def test_reject_counts(spark):
    vals = [payment("P0"), payment("P1", amount=-1), payment(None, amount=-1, created_at="garbage"),
            payment("P3", status="failed")]
    got = {r.rule: r.rows for r in reject_counts(_bronze(spark, "payments", vals), rules_for("payments")).collect()}
    assert got == {"payment_id_present": 1, "order_id_present": 0, "amount_positive": 2,
                   "event_time_parsed": 1, "payment_status_is_success": 1, "all_rules": 3}


def test_batch_dedup_first_and_latest(spark):
    vals = [payment("P1", amount=1.0), payment("P1", amount=2.0), payment("P2", amount=3.0)]
    clean = to_silver(_bronze(spark, "payments", vals), rules_for("payments"), stamp=False)
    first = {r.payment_id: r.amount for r in dedup_first(clean, "payment_id", ["offset"]).collect()}
    latest = {r.payment_id: r.amount for r in dedup_latest(clean, "payment_id", ["offset"]).collect()}
    assert first == {"P1": 1.0, "P2": 3.0} and latest == {"P1": 2.0, "P2": 3.0}
    assert dedup_first(clean, "payment_id", ["offset"]).columns == clean.columns


def test_dedup_ties_broken_by_remaining_columns(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", 1, "c")], "k string, o int, v string")
    assert dedup_first(df, "k", ["o"]).first().v == "a"
    assert dedup_latest(df, "k", ["o"]).first().v == "c"
    # tie_break is consulted before the remaining columns
    rev = spark.createDataFrame([("k", 1, "a", 3), ("k", 1, "b", 1)], "k string, o int, v string, w int")
    assert dedup_first(rev, "k", ["o"], tie_break=["w"]).first().v == "b"
    assert dedup_latest(rev, "k", ["o"], tie_break=["w"]).first().v == "a"


def test_silver_entity_batch_dedups_first_arrival(spark):
    vals = [payment("P1", amount=1.0), payment("P1", amount=2.0)]
    rows = silver_entity(_bronze(spark, "payments", vals), "payments", stamp=False).collect()
    assert len(rows) == 1 and rows[0].amount == 1.0


def test_stream_only_and_batch_only_guards(spark):
    df = spark.createDataFrame([("k",)], "k string")
    with pytest.raises(ValueError):
        dedup_stream(df, "k")
