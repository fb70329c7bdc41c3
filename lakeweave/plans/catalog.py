"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of SURVEY section 2, each reading the whole test tables.

Outputs leave out wall-clock stamps (``ingested_at``, ``cleaned_at``) and
round summed doubles to 2 places so results compare exactly with the SQL
oracle in ``plans/oracle.py``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import rules_for
from ..functions.timefmt import event_time
from ..operators import derive, gold
from ..operators.bronze import corrupt_split, to_bronze
from ..operators.dedup import dedup_latest
from ..operators.history import asof_join, history
from ..operators.integrity import layer_tests, orphans
from ..operators.quality import layer_counts
from ..operators.ranking import top_products
from ..operators.sessions import session_gaps
from ..operators.silver import ARRIVAL_ORDER, reject_counts, silver_entity, to_silver
from ..operators.star import dimension, resolve, resolve_version
from ..schemas import ENTITY, ENTITY_KEY
from ..session import scratch
from ..sinks.files import write_layer
from ..sinks.incremental import merge_history, read_history, versions_schema
from ..sources.layers import read_layer
from ..sources.testdata import messages

CORRUPT = "_corrupt_record"


# --- layer builders over the test tables ----------------------------------
# Columns that silver rules read (besides created_at).
RULE_COLUMNS = {
    "orders": ["order_id", "customer_id", "total_amount"],
    "payments": ["payment_id", "order_id", "amount", "payment_status"],
    "inventory": ["inventory_id", "product_id", "quantity_on_hand"],
}


def bronze(spark: SparkSession, sf_dir: str, topic: str, corrupt_col: str | None = None,
           materialize: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Bronze layer of one topic.

    With ``materialize`` (for consumers that filter, i.e. silver) it is
    written as Parquet to the shared folder, as the bronze job does, and
    read back with its declared schema: the silver predicates then reach
    the Parquet scan instead of being pushed into the JSON parse, where
    Catalyst would evaluate ``from_json`` once per predicate.  ``keep``
    narrows that copy (and the JSON parse) to arrival order, the columns of
    the silver rules and these.  Consumers that only project or aggregate
    read the parse directly (``from_json`` appears once in their plan) and
    skip the write.
    """
    parsed = to_bronze(messages(spark, sf_dir, topic), ENTITY[topic], corrupt_col=corrupt_col, stamp=False)
    if not materialize:
        return parsed
    if keep is not None:
        wanted = {ENTITY_KEY[topic], *ARRIVAL_ORDER, "created_at", *RULE_COLUMNS[topic], *keep}
        parsed = parsed.select(*[c for c in parsed.columns if c in wanted])
    path = scratch(spark, f"bronze-{topic}")
    write_layer(parsed, path)
    return read_layer(spark, path, parsed.schema)


def silver(spark: SparkSession, sf_dir: str, topic: str, bronze_df: DataFrame | None = None,
           keep: list[str] | None = None) -> DataFrame:
    """Silver rows of one topic; ``keep`` narrows them, and the bronze copy,
    to what the consumer reads."""
    src = bronze_df if bronze_df is not None else bronze(spark, sf_dir, topic, keep=keep)
    return silver_entity(src, topic, stamp=False, keep=keep)


# Columns each consumer of silver reads (besides key, arrival order, event time).
NEEDS = {
    "revenue": ["amount"],
    "product_units": ["items", "order_status"],
    "customer_activity": ["customer_id", "total_amount", "order_status"],
    "order_total_check": ["total_amount", "items"],
    "stock_movements": ["order_status", "items", "created_at"],
    "payable_orders": ["customer_id", "total_amount", "order_status"],
}


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(F.col(c), 2).alias(c) if c in cols else F.col(c) for c in df.columns])


# --- bronze -----------------------------------------------------------------
def q_bronze_payments(spark, sf):
    return bronze(spark, sf, "payments", materialize=False)


def q_bronze_orders(spark, sf):
    """Orders bronze, compared one row per item (NULL item fields for an
    order with no or unreadable items)."""
    b = bronze(spark, sf, "orders", materialize=False)
    rest = [c for c in b.columns if c != "items"]
    return b.select(*rest, F.explode_outer("items").alias("item")).select(
        *rest,
        F.col("item.product_id").alias("product_id"),
        F.col("item.product_name").alias("product_name"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.unit_price").alias("unit_price"),
    )


def q_bronze_inventory(spark, sf):
    return bronze(spark, sf, "inventory", materialize=False)


def q_bronze_customers(spark, sf):
    return bronze(spark, sf, "customers", materialize=False)


def q_bronze_corrupt_split(spark, sf):
    parts = [corrupt_split(bronze(spark, sf, t, corrupt_col=CORRUPT, materialize=False), CORRUPT)
             for t in ("orders", "payments", "inventory", "customers")]
    return reduce(DataFrame.unionByName, parts)


# --- silver -----------------------------------------------------------------
def q_silver_payments(spark, sf):
    return silver(spark, sf, "payments")


def q_silver_orders(spark, sf):
    s = silver(spark, sf, "orders")
    return s.select(*[c if c != "items" else F.size("items").alias("item_count") for c in s.columns])


def q_silver_inventory(spark, sf):
    return silver(spark, sf, "inventory")


def q_silver_reject_counts(spark, sf):
    parts = [reject_counts(bronze(spark, sf, t, materialize=False), rules_for(t)).select(
        F.lit(t).alias("entity"), "rule", "rows") for t in ("orders", "payments", "inventory")]
    return reduce(DataFrame.unionByName, parts)


def q_silver_dedup_latest(spark, sf):
    """D2 on inventory: per inventory_id the row with the latest event time,
    then highest offset, then the remaining columns."""
    clean = to_silver(bronze(spark, sf, "inventory"), rules_for("inventory"), stamp=False)
    return dedup_latest(clean, "inventory_id", ["created_at_ts", "offset"])


# --- gold (batch) -----------------------------------------------------------
def _gold(name: str, duration: str):
    topic, build = gold.GOLD_BUILDERS[name]
    money = {"revenue": ("total_revenue",), "customer_activity": ("total_spent",)}.get(name, ())

    def q(spark, sf):
        return _round(build(silver(spark, sf, topic, keep=NEEDS[name]), duration), *money)
    q.__name__ = f"q_gold_{name}_{duration.replace(' ', '')}"
    return q


# --- quality ----------------------------------------------------------------
def q_layer_counts(spark, sf):
    layers = {}
    for t in ("orders", "payments", "inventory"):
        b = bronze(spark, sf, t, keep=[])
        layers[t] = (b, silver(spark, sf, t, bronze_df=b, keep=[]))
    return layer_counts(layers)


# --- business rules ---------------------------------------------------------
def q_order_total_check(spark, sf):
    return derive.order_total_check(silver(spark, sf, "orders", keep=NEEDS["order_total_check"]))


def q_stock_movements(spark, sf):
    return derive.stock_movements(silver(spark, sf, "orders", keep=NEEDS["stock_movements"]))


def q_running_stock(spark, sf):
    mv = derive.stock_movements(silver(spark, sf, "orders", keep=NEEDS["stock_movements"]))
    return derive.running_stock(mv, order_by=["created_at_ts", "order_id", "item_pos"])


def q_customer_classify(spark, sf):
    # read twice (first-event aggregate + join back): materialise, parse once
    return derive.classify_customers(bronze(spark, sf, "customers"))


def q_payable_orders(spark, sf):
    return derive.payable_orders(silver(spark, sf, "orders", keep=NEEDS["payable_orders"]))


# --- versions of customers ----------------------------------------------------
TRACKED = ["city", "segment"]
# The test tables' orders are of 1995 to 2001, their customer events of
# January 2024; order times are scaled onto that month (microseconds, divisor).
ORDERS_FROM, EVENTS_FROM, ORDER_SCALE = 788_918_400_000_000, 1_704_067_200_000_000, 80


def customer_events(spark: SparkSession, sf: str) -> DataFrame:
    """Customer profile events with their time (bronze; the layer has no silver)."""
    return bronze(spark, sf, "customers").select("customer_id", event_time(F.col("updated_at")).alias("at"), *TRACKED, "offset")


def q_customer_history(spark, sf):
    """SCD type 2 of customers: one row a run of equal (city, segment)."""
    return history(customer_events(spark, sf), ["customer_id"], "at", TRACKED, ["offset"])


def q_customer_history_merged(spark, sf):
    """The same table from three loads in mixed order: late events split stored intervals."""
    events = customer_events(spark, sf)
    target = scratch(spark, "customer-history")
    for load in (2, 0, 1):
        merge_history(events.filter(F.pmod("offset", F.lit(3)) == load), ["customer_id"], "at", TRACKED, ["offset"], target)
    return read_history(spark, target, versions_schema(events, ["customer_id"], "at", TRACKED))


def order_time() -> Column:
    """An order's time on the scale of the customer events."""
    return F.expr(f"timestamp_micros({EVENTS_FROM} + (unix_micros(created_at_ts) - {ORDERS_FROM}) div {ORDER_SCALE})")


def _as_of(rows: DataFrame, spark, sf, at) -> DataFrame:
    return asof_join(rows, q_customer_history(spark, sf), ["customer_id"], at, "valid_from", [*TRACKED, "version", "valid_from"])


def q_orders_asof_customer(spark, sf):
    """Each order with the customer's version at its (scaled) time."""
    orders = silver(spark, sf, "orders", keep=["customer_id"]).select("order_id", "customer_id", "created_at_ts")
    return _as_of(orders, spark, sf, order_time())


def q_payments_asof_customer(spark, sf):
    """Each payment with the customer's version at its time (often the very time of a version)."""
    payments = silver(spark, sf, "payments", keep=["customer_id"]).select("payment_id", "customer_id", "created_at_ts")
    return _as_of(payments, spark, sf, "created_at_ts")


# --- tops, tests, gaps, star schema -------------------------------------------
TOP = 10
SESSION_GAP = "60 days"


def q_top_products_1h(spark, sf):
    return top_products(silver(spark, sf, "orders", keep=NEEDS["product_units"]), "1 hour", TOP)


def q_orphan_payments(spark, sf):
    """Payments without a payable order (its id before the part number)."""
    payable = derive.payable_orders(silver(spark, sf, "orders", keep=NEEDS["payable_orders"]))
    orders = payable.select(F.substring_index("order_id", "-", 1).alias("order_number"))
    payments = silver(spark, sf, "payments", keep=["order_id", "amount"]).select("payment_id", "order_id", "amount", "created_at_ts")
    return orphans(payments, "order_id", orders, "order_number")


def q_layer_tests(spark, sf):
    """Not-null and unique tests of bronze and silver keys and references."""
    layers = {}
    for topic, columns in (("orders", ["customer_id"]), ("payments", ["order_id"]), ("inventory", ["product_id"])):
        b = bronze(spark, sf, topic, keep=columns)
        for layer, df in (("bronze", b), ("silver", silver(spark, sf, topic, bronze_df=b, keep=columns))):
            layers[f"{layer}_{topic}"] = (df, [ENTITY_KEY[topic], *columns, "created_at"] if layer == "bronze"
                                          else [ENTITY_KEY[topic], *columns, "created_at_ts"], [ENTITY_KEY[topic]])
    return layer_tests(layers)


def q_customer_gaps(spark, sf):
    """Sessions of a customer's orders; a customer is gone after 60 days without one."""
    orders = silver(spark, sf, "orders", keep=["customer_id", "total_amount"])
    return _round(session_gaps(orders, ["customer_id"], "created_at_ts", SESSION_GAP, ["order_id"], {"spent": F.sum("total_amount")}), "spent")


def _dim_customer(spark, sf):
    versions = q_customer_history(spark, sf).select("customer_id", "valid_from", "valid_to", "is_current", *TRACKED)
    return dimension(versions, ["customer_id", "valid_from"], "customer_key")


def _order_lines(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "customer_id", "created_at_ts", F.posexplode("items").alias("item_pos", "item")).select(
        "order_id", "item_pos", "customer_id", "created_at_ts", "item.product_id", "item.product_name", "item.quantity", "item.unit_price")


def _dim_product(lines: DataFrame) -> DataFrame:
    # different names first: they are combined by hash, a maximum of texts would sort all lines
    named = lines.filter(F.col("product_id").isNotNull()).select("product_id", "product_name").distinct()
    members = named.groupBy("product_id").agg(F.max("product_name").alias("product_name"))
    return dimension(members, ["product_id"], "product_key")


def q_dim_customer(spark, sf):
    """One row a customer version, and the unknown member."""
    return _dim_customer(spark, sf)


def q_dim_product(spark, sf):
    return _dim_product(_order_lines(silver(spark, sf, "orders", keep=["customer_id", "items"])))


def q_fact_order_items(spark, sf):
    """Order lines with the keys of the customer's version at the order's (scaled) time and of the product."""
    orders = silver(spark, sf, "orders", keep=["customer_id", "items"]).select("order_id", "customer_id", "created_at_ts", "items")
    path = scratch(spark, "fact-orders")
    write_layer(orders, path)                             # read by both dimensions' lookups and by the facts
    orders = read_layer(spark, path, orders.schema)
    # the version follows from the order alone: looked up once an order, not once a line
    placed = resolve_version(orders.drop("items"), _dim_customer(spark, sf), ["customer_id"], order_time(), "customer_key")
    keyed = orders.select("order_id", "items").join(placed.select("order_id", "customer_key"), "order_id")
    lines = keyed.select("order_id", "customer_key", F.posexplode("items").alias("item_pos", "item")).select(
        "order_id", "item_pos", "customer_key", "item.product_id", "item.quantity", "item.unit_price")
    facts = resolve(lines, _dim_product(_order_lines(orders)), ["product_id"], "product_key")
    return facts.select("order_id", "item_pos", "customer_key", "product_key", "quantity",
                        F.round(F.col("quantity") * F.col("unit_price"), 2).alias("amount"))


def batch_queries() -> dict:
    return {
        "bronze_payments": q_bronze_payments,
        "bronze_orders": q_bronze_orders,
        "bronze_inventory": q_bronze_inventory,
        "bronze_customers": q_bronze_customers,
        "bronze_corrupt_split": q_bronze_corrupt_split,
        "silver_payments": q_silver_payments,
        "silver_orders": q_silver_orders,
        "silver_inventory": q_silver_inventory,
        "silver_reject_counts": q_silver_reject_counts,
        "silver_dedup_latest": q_silver_dedup_latest,
        "gold_revenue_1m": _gold("revenue", "1 minute"),
        "gold_revenue_5m": _gold("revenue", "5 minutes"),
        "gold_product_units_1m": _gold("product_units", "1 minute"),
        "gold_product_units_1h": _gold("product_units", "1 hour"),
        "gold_customer_activity_1m": _gold("customer_activity", "1 minute"),
        "gold_customer_activity_1h": _gold("customer_activity", "1 hour"),
        "layer_counts": q_layer_counts,
        "order_total_check": q_order_total_check,
        "stock_movements": q_stock_movements,
        "running_stock": q_running_stock,
        "customer_classify": q_customer_classify,
        "payable_orders": q_payable_orders,
        "customer_history": q_customer_history,
        "customer_history_merged": q_customer_history_merged,
        "orders_asof_customer": q_orders_asof_customer,
        "payments_asof_customer": q_payments_asof_customer,
        "top_products_1h": q_top_products_1h,
        "orphan_payments": q_orphan_payments,
        "layer_tests": q_layer_tests,
        "customer_gaps": q_customer_gaps,
        "dim_customer": q_dim_customer,
        "dim_product": q_dim_product,
        "fact_order_items": q_fact_order_items,
    }


def q_flagship(spark, sf):
    """Flagship: payments messages -> bronze -> silver -> 5-minute revenue."""
    return batch_queries()["gold_revenue_5m"](spark, sf)


def all_queries() -> dict:
    from .streams import stream_queries
    return {**batch_queries(), **stream_queries()}
