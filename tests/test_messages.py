"""Encode / decode / permissive parse edge cases."""
import math

from pyspark.sql import functions as F

from helpers import envelope, payment
from lakeweave.functions.messages import encode_messages
from lakeweave.operators.bronze import corrupt_split, to_bronze
from lakeweave.schemas import ENTITY, PAYMENT, bronze_schema


def test_bronze_columns_and_order(spark):
    b = to_bronze(envelope(spark, "payments", [payment()], keys=["ORD1"]), PAYMENT)
    assert b.columns == bronze_schema(PAYMENT).fieldNames()
    row = b.drop("ingested_at").first()
    assert row.kafka_key == "ORD1" and row.payment_id == "PAY1" and row.amount == 10.0
    assert row.topic == "payments" and row.offset == 0


def test_unparsable_values_give_null_fields(spark):
    vals = ["{bad", "[]", "null", ""]
    b = to_bronze(envelope(spark, "payments", vals), PAYMENT, stamp=False)
    rows = b.collect()
    assert len(rows) == 4
    for r in rows:
        assert all(r[f] is None for f in PAYMENT.fieldNames())


def test_single_bad_field_only_that_field_null(spark):
    vals = [payment(amount="x"), '{"payment_id": 12, "amount": 1.5}', payment(amount=float("nan"))]
    rows = to_bronze(envelope(spark, "payments", vals), PAYMENT, stamp=False).orderBy("offset").collect()
    assert rows[0].amount is None and rows[0].payment_id == "PAY1"
    assert rows[1].payment_id == "12" and rows[1].amount == 1.5       # number read as text
    assert math.isnan(rows[2].amount)


def test_bad_nested_int_nulls_inside_kept_element(spark):
    from helpers import order
    o = order(items=[{"product_id": "P1", "product_name": "A", "quantity": "two", "unit_price": 1}])
    r = to_bronze(envelope(spark, "orders", [o]), ENTITY["orders"], stamp=False).first()
    assert len(r["items"]) == 1 and r["items"][0].quantity is None and r["items"][0].product_id == "P1"


def test_corrupt_column_captures_bad_records(spark):
    vals = [payment(), "{bad", payment(amount="x")]
    b = to_bronze(envelope(spark, "payments", vals), PAYMENT, corrupt_col="_corrupt_record", stamp=False)
    rows = b.orderBy("offset").collect()
    assert rows[0]._corrupt_record is None
    assert rows[1]._corrupt_record == "{bad"
    assert rows[2]._corrupt_record is not None       # single-field failure is captured too
    split = corrupt_split(b).first()
    assert (split.good_rows, split.corrupt_rows) == (1, 2)


def test_encode_decode_round_trip_keeps_non_ascii(spark):
    df = spark.createDataFrame([("P001", "Áo khoác gió", 3)], "product_id string, product_name string, n int")
    enc = encode_messages(df, "inventory", "product_id")
    assert enc.columns == ["key", "value", "topic"]
    r = enc.first()
    assert bytes(r.key) == b"P001"
    assert "Áo khoác gió" in bytes(r.value).decode("utf-8")
    env = enc.withColumn("partition", F.lit(0)).withColumn("offset", F.lit(0).cast("long")) \
        .withColumn("timestamp", F.current_timestamp())
    back = to_bronze(env, ENTITY["inventory"], stamp=False).first()
    assert back.product_name == "Áo khoác gió" and back.kafka_key == "P001"


def test_null_key_encodes_to_null(spark):
    df = spark.createDataFrame([(None, "x")], "customer_id string, v string")
    assert encode_messages(df, "customers", "customer_id").first().key is None
    assert encode_messages(df, "customers", None).first().key is None
