"""Business rules of the order flow, as batch operators.

R1, R2, R5 are narrow (no shuffle).  R3 uses the skew-safe prefix scan.
R4 finds each customer's first event with a grouped ``min`` of a struct
(map-side combined) and joins it back, instead of a per-customer window;
the events of a customer are dealt over ``SALTS`` tasks for that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import event_time
from .prefix import clamped_running_sum

# Warehouse codes and initial stock per (product, warehouse).
WAREHOUSES = ["WH_HN", "WH_HCM", "WH_DN"]
INITIAL_STOCK = 500

# Tasks that share the events of one customer in R4's join; the one-row-per-
# customer side is copied as often.
SALTS = 8


def _not_cancelled(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(F.col("order_status") != F.lit("cancelled"), F.lit(True)))


def order_total_check(orders: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Σ quantity x unit_price over ``items`` (rounded to 2) vs
    ``total_amount``.  An item without quantity or price adds nothing.
    ``aggregate`` folds the array in place: no explode, no shuffle."""
    folded = F.aggregate(
        F.coalesce(F.col("items"), F.array().cast(orders.schema["items"].dataType)),
        F.lit(0.0).cast("double"),
        lambda acc, it: acc + F.coalesce(it["quantity"] * it["unit_price"], F.lit(0.0)),
    )
    total = F.round(folded, 2)
    return orders.select(
        "order_id",
        "total_amount",
        total.alias("items_total"),
        (F.abs(total - F.col("total_amount")) <= F.lit(tolerance)).alias("matches"),
    )


def default_warehouse(item_pos: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in WAREHOUSES]),
                        (F.pmod(item_pos, F.lit(len(WAREHOUSES))) + 1).cast("int"))


def stock_movements(orders: DataFrame, warehouse=default_warehouse) -> DataFrame:
    """R2: one ``sale`` movement per item of every non-cancelled order.

    ``warehouse`` maps the item position column to a warehouse code.
    """
    items = _not_cancelled(orders).select(
        "order_id", "created_at", "created_at_ts",
        F.posexplode("items").alias("item_pos", "item"))
    return items.select(
        "order_id",
        "item_pos",
        F.col("item.product_id").alias("product_id"),
        F.col("item.product_name").alias("product_name"),
        warehouse(F.col("item_pos")).alias("warehouse_id"),
        (-F.col("item.quantity")).alias("quantity_change"),
        F.lit("sale").alias("change_reason"),
        "created_at",
        "created_at_ts",
    )


def running_stock(movements: DataFrame, order_by: list[str], initial: int = INITIAL_STOCK,
                  keys: tuple[str, ...] = ("product_id", "warehouse_id"),
                  partitions: int | None = None) -> DataFrame:
    """Stock on hand after each movement, per (product, warehouse),
    starting at ``initial``, floored at 0 after every step.

    ``order_by`` must be a total order within a key.
    """
    return clamped_running_sum(movements, list(keys), list(order_by), "quantity_change",
                               initial, "quantity_on_hand", partitions=partitions)


def classify_customers(events: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """First event of a customer -> ``customer_created`` with segment
    ``new``; later events -> ``customer_updated`` keeping the first event's
    full_name, email, phone and created_at.  Events without a customer id
    (broken messages among them) are left out.

    ``order_by`` (default: event time of ``updated_at`` with unparsable
    times last, then ``offset``) must be a total order within a customer.
    """
    if order_by:
        order_cols = [F.col(c) for c in order_by]
    else:
        t = event_time(F.col("updated_at"))
        order_cols = [t.isNull(), t, F.col("offset")]
    keyed = events.filter(F.col("customer_id").isNotNull()).select(
        "*", F.pmod(F.xxhash64(*order_cols), F.lit(SALTS)).alias("_salt"), F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order_cols)]).alias("_ord"))
    firsts = keyed.groupBy("customer_id").agg(F.min(F.struct(
        F.col("_ord"), "full_name", "email", "phone", "created_at")).alias("_first"))
    copies = firsts.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    joined = keyed.join(copies, ["customer_id", "_salt"])
    is_first = F.col("_ord") == F.col("_first._ord")
    keep = lambda c: F.when(is_first, F.col(c)).otherwise(F.col(f"_first.{c}")).alias(c)
    return joined.select(
        "customer_id",
        keep("full_name"), keep("email"), keep("phone"),
        "address", "city",
        F.when(is_first, F.lit("new")).otherwise(F.col("segment")).alias("segment"),
        keep("created_at"),
        "updated_at",
        F.when(is_first, F.lit("customer_created")).otherwise(F.lit("customer_updated")).alias("event_type"),
    )


def payable_orders(orders: DataFrame) -> DataFrame:
    """Orders that get a payment (status not ``cancelled``), amount =
    order total."""
    return _not_cancelled(orders).select(
        "order_id", "customer_id", F.col("total_amount").alias("amount"))
