"""Declared schemas for every layer.

Nothing downstream infers a schema from data: an empty upstream folder
reads as zero rows instead of failing, and a stream can start before
its input exists.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# --- message envelope (the Kafka source contract) -------------------------
ENVELOPE = _s(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
)

# --- entity payloads (JSON message bodies) --------------------------------
ORDER_ITEM = _s(
    ("product_id", StringType()),
    ("product_name", StringType()),
    ("quantity", IntegerType()),
    ("unit_price", DoubleType()),
)

ORDER = _s(
    ("order_id", StringType()),
    ("customer_id", StringType()),
    ("order_status", StringType()),
    ("items", ArrayType(ORDER_ITEM)),
    ("total_amount", DoubleType()),
    ("currency", StringType()),
    ("created_at", StringType()),
    ("event_type", StringType()),
)

PAYMENT = _s(
    ("payment_id", StringType()),
    ("order_id", StringType()),
    ("customer_id", StringType()),
    ("amount", DoubleType()),
    ("currency", StringType()),
    ("payment_method", StringType()),
    ("payment_status", StringType()),
    ("created_at", StringType()),
    ("event_type", StringType()),
)

INVENTORY = _s(
    ("inventory_id", StringType()),
    ("product_id", StringType()),
    ("product_name", StringType()),
    ("warehouse_id", StringType()),
    ("quantity_change", IntegerType()),
    ("quantity_on_hand", IntegerType()),
    ("change_reason", StringType()),
    ("created_at", StringType()),
    ("event_type", StringType()),
)

CUSTOMER = _s(
    ("customer_id", StringType()),
    ("full_name", StringType()),
    ("email", StringType()),
    ("phone", StringType()),
    ("address", StringType()),
    ("city", StringType()),
    ("segment", StringType()),
    ("created_at", StringType()),
    ("updated_at", StringType()),
    ("event_type", StringType()),
)

ENTITY = {
    "orders": ORDER,
    "payments": PAYMENT,
    "inventory": INVENTORY,
    "customers": CUSTOMER,
}

# Message key column per topic (what the producer keys each topic by).
MESSAGE_KEY = {
    "orders": "customer_id",
    "payments": "order_id",
    "inventory": "product_id",
    "customers": "customer_id",
}

# De-duplication key per entity that has a silver layer.
ENTITY_KEY = {
    "orders": "order_id",
    "payments": "payment_id",
    "inventory": "inventory_id",
}

# --- derived layer schemas --------------------------------------------------
_ENVELOPE_TAIL = [
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("kafka_timestamp", TimestampType(), True),
]


def bronze_schema(entity: StructType, stamp: bool = True, corrupt_col: str | None = None) -> StructType:
    fields = [StructField("kafka_key", StringType(), True)]
    fields += list(entity.fields)
    fields += _ENVELOPE_TAIL
    if corrupt_col:
        fields.append(StructField(corrupt_col, StringType(), True))
    if stamp:
        fields.append(StructField("ingested_at", TimestampType(), True))
    return StructType(fields)


def silver_schema(entity: StructType, stamp: bool = True) -> StructType:
    fields = list(bronze_schema(entity, stamp=stamp).fields)
    fields.append(StructField("created_at_ts", TimestampType(), True))
    if stamp:
        fields.append(StructField("cleaned_at", TimestampType(), True))
    return StructType(fields)


GOLD_REVENUE = _s(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("total_revenue", DoubleType()),
    ("transaction_count", LongType()),
)

GOLD_PRODUCT_UNITS = _s(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("product_id", StringType()),
    ("product_name", StringType()),
    ("total_quantity_sold", LongType()),
)

GOLD_CUSTOMER_ACTIVITY = _s(
    ("window_start", TimestampType()),
    ("window_end", TimestampType()),
    ("customer_id", StringType()),
    ("order_count", LongType()),
    ("total_spent", DoubleType()),
    ("last_order_at", TimestampType()),
)


def with_batch_id(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField("batch_id", LongType(), True)])


# Gold folder -> (schema, group keys, target table, target column order).
# Column orders are fixed values of the warehouse load; the table names are
# this library's own defaults.
GOLD_TABLES = {
    "revenue": (
        GOLD_REVENUE,
        ["window_start", "window_end"],
        "raw_revenue",
        ["window_start", "window_end", "total_revenue", "transaction_count"],
    ),
    "product_units": (
        GOLD_PRODUCT_UNITS,
        ["window_start", "window_end", "product_id", "product_name"],
        "raw_top_products",
        ["window_start", "window_end", "product_id", "product_name", "total_quantity_sold"],
    ),
    "customer_activity": (
        GOLD_CUSTOMER_ACTIVITY,
        ["window_start", "window_end", "customer_id"],
        "raw_customer_activity",
        ["window_start", "window_end", "customer_id", "order_count", "total_spent", "last_order_at"],
    ),
}
