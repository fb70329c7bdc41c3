"""Test-table -> message mapping (the fixtures every registered query reads).

The driver's tables (TPC-H-like ``orders / lineitem / part`` and an
``events`` log) are shaped into the four message topics of the data model
(orders, payments, inventory, customers) as envelope rows
``(key, value, topic, partition, offset, timestamp)``.  Dirt -- broken JSON,
NULL ids, negative amounts, unparsable times, replayed messages -- is
injected by modulo rules on the source ids, so a SQL oracle can repeat it
exactly.  Everything is a Spark plan over the whole input tables: work
grows with them, nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.messages import encode_messages
from ..operators.derive import WAREHOUSES
from ..functions.timefmt import event_time, iso_utc
from ..schemas import ENTITY, MESSAGE_KEY

# Dirt rules (row is affected when id % n == 0).
DUPLICATE_EVERY = 53      # message replayed once more (next offset)
BROKEN_EVERY = 101        # value is not JSON: all fields NULL
NULL_REF_EVERY = 83       # payments.order_id / orders.customer_id / inventory.product_id NULL
NEGATE_EVERY = 97         # amount / total_amount negated
BAD_TIME_EVERY = 89       # created_at = 'garbage' (customers: updated_at)
NULL_QUANTITY_EVERY = 71  # items of every such part have no quantity
BROKEN_VALUE = "{bad"
# An order is sent in messages of at most so many lines, numbered from 0 in
# the order (part key modulo LINE_RANGES, part key, quantity, price): this
# bounds the nested array whatever share of all lines one order holds.
PART_LINES = 1000
LINE_RANGES = 64
LINE = ["l_partkey", "l_quantity", "l_extendedprice"]
# Messages of one order follow each other in their topic partition.
MAX_PARTS = 1 << 20
TOPIC_PARTITIONS = 4

# Enumerations used when shaping messages (warehouse codes
# are shared with the stock operators, see operators/derive.py).
PAYMENT_METHODS = ["credit_card", "momo", "bank_transfer", "cod"]
SEGMENTS = ["regular", "vip", "new"]
CITIES = ["Riverton", "Oakfield", "Lakeside", "Westbrook"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def _id(prefix: str, num: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(num.cast("string"), width, "0"))


def _every(num: Column, n: int) -> Column:
    return F.pmod(num, F.lit(n)) == 0


def _copies(num: Column) -> Column:
    """0 for every message, plus a replay copy 1 for every DUPLICATE_EVERY-th."""
    return F.explode(F.when(_every(num, DUPLICATE_EVERY), F.array(F.lit(0), F.lit(1)))
                     .otherwise(F.array(F.lit(0))))


def _envelope(records: DataFrame, topic: str, broken: Column) -> DataFrame:
    """Entity columns + ``_partition, _offset, _ts, _broken`` -> envelope."""
    fields = [f.name for f in ENTITY[topic].fields]
    staged = records.withColumn("_broken", broken)
    enc = encode_messages(staged, topic, MESSAGE_KEY[topic], fields=fields,
                          keep=["_partition", "_offset", "_ts", "_broken"])
    return enc.select(
        "key",
        F.when(F.col("_broken"), F.lit(BROKEN_VALUE).cast("binary")).otherwise(F.col("value")).alias("value"),
        "topic",
        F.col("_partition").cast("int").alias("partition"),
        F.col("_offset").cast("long").alias("offset"),
        F.col("_ts").alias("timestamp"),
    )


def payment_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> payments topic (one payment per event)."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", _copies(F.col("event_id")).alias("copy"))
    e = F.col("event_id")
    rec = ev.select(
        _id("PAY", e, 12).alias("payment_id"),
        F.when(_every(e, NULL_REF_EVERY), F.lit(None).cast("string"))
         .otherwise(_id("ORD", e, 12)).alias("order_id"),
        _id("CUST", F.col("user_id"), 5).alias("customer_id"),
        F.when(_every(e, NEGATE_EVERY), -F.col("value")).otherwise(F.col("value")).alias("amount"),
        F.lit("VND").alias("currency"),
        _pick(PAYMENT_METHODS, e).alias("payment_method"),
        F.when(F.col("event_type") == "purchase", "success")
         .when(F.col("event_type") == "error", "failed")
         .otherwise("pending").alias("payment_status"),
        F.when(_every(e, BAD_TIME_EVERY), F.lit("garbage")).otherwise(iso_utc(F.col("ts"))).alias("created_at"),
        F.lit("payment_processed").alias("event_type"),
        F.pmod(e, F.lit(TOPIC_PARTITIONS)).alias("_partition"),
        (e * 2 + F.col("copy")).alias("_offset"),
        event_time(iso_utc(F.col("ts"))).alias("_ts"),
        _every(e, BROKEN_EVERY).alias("_brk"),
    )
    return _envelope(rec, "payments", F.col("_brk"))


def _order_time(key: Column, day: Column) -> Column:
    return F.timestamp_add("SECOND", F.pmod(key, F.lit(86400)), day)


def _line_item() -> Column:
    return F.struct(
        _id("P", F.col("l_partkey"), 6).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(~_every(F.col("l_partkey"), NULL_QUANTITY_EVERY), F.col("l_quantity").cast("int")).alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


def order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each order cut into parts of ``PART_LINES``:
    ``l_orderkey, part, items, total``.

    Equal lines (same part, quantity and price) are counted first, with
    map-side combining, and never ranked one by one.  An order of at most
    PART_LINES lines is one part, whatever their order: its lines are
    collected in one more shuffle.  The others (at most one for PART_LINES
    lines of the table) are cut by ``_cut_parts``.  ``lineitem`` is scanned
    once.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    # all uses of ``lines`` read one exchange: same filters, same columns
    lines = (li.filter(F.col("l_orderkey").isNotNull())
             .groupBy("l_orderkey", *LINE).agg(F.count(F.lit(1)).alias("_n")))
    long_ = (lines.groupBy("l_orderkey").agg(F.sum("_n").alias("_all")).filter(F.col("_all") > PART_LINES)
             .select("l_orderkey", F.lit(True).alias("_long")))
    # never empty (a flag of order 0, false unless it is long): the plan of short orders stays the same without long ones
    flags = (long_.unionByName(spark.range(1).select(F.lit(0).cast("long").alias("l_orderkey"), F.lit(False).alias("_long")))
             .groupBy("l_orderkey").agg(F.bool_or("_long").alias("_long")))
    item = _line_item()
    # Every line becomes an item; a part missing from ``part`` leaves the
    # item's product_name NULL rather than dropping the line.
    named = lambda lines: lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    each = lines.join(F.broadcast(flags), "l_orderkey", "left").filter(~F.coalesce("_long", F.lit(False))).select(
        "l_orderkey", *LINE, F.explode(F.array_repeat(F.lit(True), F.col("_n").cast("int"))))
    short = named(each).groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(item)).alias("items"),
        F.round(F.sum("l_extendedprice"), 2).alias("total"),
    ).select("l_orderkey", F.lit(0).cast("long").alias("part"), "items", "total")
    cut = _cut_parts(lines.join(F.broadcast(long_), "l_orderkey").select("l_orderkey", *LINE, "_n"))
    return short.unionByName(named(cut).groupBy("l_orderkey", "part").agg(
        F.array_sort(F.flatten(F.collect_list(F.array_repeat(item, F.col("_here"))))).alias("items"),
        F.round(F.sum(F.col("l_extendedprice") * F.col("_here")), 2).alias("total")))


def _cut_parts(counted: DataFrame) -> DataFrame:
    """Counted lines of long orders, cut into parts: lines of an order are
    ranked in ``LINE_RANGES`` ranges of their part key and the ranges' counts
    added.  So an order that holds a third of all lines is spread over
    tasks, and an array never exceeds PART_LINES items."""
    own = ["l_orderkey", "_range"]
    lines = counted.withColumn("_range", F.coalesce(F.pmod("l_partkey", F.lit(LINE_RANGES)), F.lit(0)))
    running = Window.partitionBy(*own).orderBy(*LINE).rowsBetween(Window.unboundedPreceding, -1)
    ranked = lines.withColumn("_at", F.coalesce(F.sum("_n").over(running), F.lit(0)))
    # lines in the earlier ranges of the order: at most LINE_RANGES rows an order
    earlier = Window.partitionBy("l_orderkey").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranked.groupBy(*own).agg(F.sum("_n").alias("_all"))
              .select(*own, F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_before")))
    placed = ranked.join(before, own).withColumn("_at", F.col("_at") + F.col("_before"))
    # a counted line may reach over several parts
    first, last = F.expr(f"_at div {PART_LINES}"), F.expr(f"(_at + _n - 1) div {PART_LINES}")
    cut = placed.select("l_orderkey", *LINE, "_at", "_n", F.explode(F.sequence(first, last)).alias("part"))
    here = (F.least(F.col("_at") + F.col("_n"), (F.col("part") + 1) * PART_LINES)
            - F.greatest(F.col("_at"), F.col("part") * PART_LINES)).cast("int")
    return cut.withColumn("_here", here)


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders ⋈ lineitem ⋈ part`` -> orders topic, items nested; every
    order is cut by the same rule (``order_parts``) and its messages are
    ``ORD<key>-<part>``.  An order without lines is one message with an
    empty item array."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    nested = order_parts(spark, sf_dir)
    no_items = F.array().cast(ENTITY["orders"]["items"].dataType)
    per_order = orders.join(nested, orders["o_orderkey"] == nested["l_orderkey"], "left").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
        F.coalesce(F.col("part"), F.lit(0)).alias("part"),
        F.coalesce(F.col("items"), no_items).alias("items"),
        F.coalesce(F.col("total"), F.round(F.col("o_totalprice"), 2)).alias("total"),
    )

    k = F.col("o_orderkey")
    msgs = per_order.select("*", _copies(k).alias("copy"))
    stamp = iso_utc(_order_time(k, F.col("o_orderdate")))
    rec = msgs.select(
        F.concat(_id("ORD", k, 12), F.lit("-"), F.col("part").cast("string")).alias("order_id"),
        F.when(_every(k, NULL_REF_EVERY), F.lit(None).cast("string"))
         .otherwise(_id("CUST", F.col("o_custkey"), 5)).alias("customer_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "cancelled")
         .when(F.col("o_orderstatus") == "F", "shipped")
         .when(F.col("o_orderstatus") == "O", "created")
         .otherwise("confirmed").alias("order_status"),
        "items",
        F.when(_every(k, NEGATE_EVERY), -F.col("total")).otherwise(F.col("total")).alias("total_amount"),
        F.lit("VND").alias("currency"),
        F.when(_every(k, BAD_TIME_EVERY), F.lit("garbage")).otherwise(stamp).alias("created_at"),
        F.lit("order_created").alias("event_type"),
        F.pmod(F.col("o_custkey"), F.lit(TOPIC_PARTITIONS)).alias("_partition"),
        ((k * 2 + F.col("copy")) * MAX_PARTS + F.col("part")).alias("_offset"),
        event_time(stamp).alias("_ts"),
        _every(k, BROKEN_EVERY).alias("_brk"),
    )
    return _envelope(rec, "orders", F.col("_brk"))


def inventory_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem ⋈ part`` -> inventory topic, one stock movement per line.
    (l_orderkey, l_linenumber) repeats in the data, so ``inventory_id``
    has natural duplicates with different payloads."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    lines = li.join(part, li["l_partkey"] == part["p_partkey"], "left")   # keep every line
    k = F.col("l_orderkey")
    qty = F.col("l_quantity").cast("int")
    stamp = iso_utc(_order_time(k, F.col("l_shipdate")))
    rec = lines.select(
        F.concat(_id("INV", k, 10), F.lpad(F.col("l_linenumber").cast("string"), 2, "0")).alias("inventory_id"),
        F.when(_every(k, NULL_REF_EVERY), F.lit(None).cast("string"))
         .otherwise(_id("P", F.col("l_partkey"), 6)).alias("product_id"),
        F.col("p_name").alias("product_name"),
        _pick(WAREHOUSES, F.col("l_suppkey")).alias("warehouse_id"),
        (-qty).alias("quantity_change"),
        (F.lit(25) - qty).alias("quantity_on_hand"),
        F.lit("sale").alias("change_reason"),
        F.when(_every(k, BAD_TIME_EVERY), F.lit("garbage")).otherwise(stamp).alias("created_at"),
        F.lit("inventory_updated").alias("event_type"),
        F.pmod(F.col("l_partkey"), F.lit(TOPIC_PARTITIONS)).alias("_partition"),
        (k * 16 + F.col("l_linenumber")).alias("_offset"),
        event_time(stamp).alias("_ts"),
        _every(k, BROKEN_EVERY).alias("_brk"),
    )
    return _envelope(rec, "inventory", F.col("_brk"))


def customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> customers topic, one profile event per event (signup:
    created, anything else: updated).  Every event carries its own
    name/email/phone; R4 restores the first ones.  Dirt: broken JSON, NULL
    customer ids, unparsable update times."""
    ev = table(spark, sf_dir, "events")
    e, u = F.col("event_id"), F.col("user_id")
    stamp = iso_utc(F.col("ts"))
    rec = ev.select(
        F.when(_every(e, NULL_REF_EVERY), F.lit(None).cast("string")).otherwise(_id("CUST", u, 5)).alias("customer_id"),
        F.concat(F.lit("Customer "), u.cast("string"), F.lit(" #"), e.cast("string")).alias("full_name"),
        F.concat(F.lit("user"), u.cast("string"), F.lit("."), e.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("09"), F.lpad(F.pmod(e, F.lit(100000000)).cast("string"), 8, "0")).alias("phone"),
        F.concat(F.pmod(e, F.lit(997)).cast("string"), F.lit(" Le Loi")).alias("address"),
        _pick(CITIES, e).alias("city"),
        _pick(SEGMENTS, e).alias("segment"),
        stamp.alias("created_at"),
        F.when(_every(e, BAD_TIME_EVERY), F.lit("garbage")).otherwise(stamp).alias("updated_at"),
        F.when(F.col("event_type") == "signup", "customer_created")
         .otherwise("customer_updated").alias("event_type"),
        F.pmod(u, F.lit(TOPIC_PARTITIONS)).alias("_partition"),
        e.alias("_offset"),
        event_time(stamp).alias("_ts"),
        _every(e, BROKEN_EVERY).alias("_brk"),
    )
    return _envelope(rec, "customers", F.col("_brk"))


MESSAGES = {
    "payments": payment_messages,
    "orders": order_messages,
    "inventory": inventory_messages,
    "customers": customer_messages,
}


def messages(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return MESSAGES[topic](spark, sf_dir)


def message_times(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """``timestamp`` of a topic's messages (each at least once), straight
    from the table that sets it: no join, no JSON."""
    name, stamp = {
        "payments": ("events", F.col("ts")),
        "orders": ("orders", _order_time(F.col("o_orderkey"), F.col("o_orderdate"))),
        "inventory": ("lineitem", _order_time(F.col("l_orderkey"), F.col("l_shipdate"))),
        "customers": ("events", F.col("ts")),
    }[topic]
    return table(spark, sf_dir, name).select(event_time(iso_utc(stamp)).alias("timestamp"))
