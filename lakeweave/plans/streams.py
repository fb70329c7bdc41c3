"""Registered streaming queries: bounded Structured Streaming runs over the
test tables, compared with their batch equivalents.

Input reaches a file stream in event-time slices handed over one after the
other, and each slice is consumed by a restart of the same query from its
checkpoint with ``availableNow``: so every run also exercises checkpoint
resume (W7).  Slices are written once, partitioned, and handed over by
renaming their folder.  All folders live under the shared
``spark.checkpoint.dir``; sources are dropped when a run ends, its output
and checkpoint stay until the caller clears them (``session.clear_scratch``;
Spark still uploads state snapshots for a while).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold
from ..operators.bronze import to_bronze
from ..operators.current import current_state
from ..operators.integrity import orphans_stream
from ..operators.sessions import sessions_stream
from ..functions.rules import rules_for
from ..operators.silver import silver_entity, to_silver
from ..schemas import ENTITY, ENTITY_KEY, GOLD_TABLES, bronze_schema, silver_schema, with_batch_id
from ..session import drop_scratch, ensure_dir, move, path_exists, scratch
from ..sinks.files import create_database, load_table, write_layer
from ..sinks.incremental import load_increment, read_loaded
from ..sources.layers import read_envelope_stream, read_layer, read_layer_stream
from ..sources.testdata import message_times, messages
from ..streaming.runner import run_append, run_update, state_by_task

SLICES = 3
DELAY = "10 minutes"


def _run(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


class Slices:
    """``df`` written once in ``slices`` equal event-time ranges between
    ``lo`` and ``hi`` (seconds; rows outside go to the first or last)."""

    def __init__(self, df: DataFrame, ts: str, root: str, lo: float | None, hi: float | None, slices: int = SLICES):
        self.spark, self.root, self.schema, self.n = df.sparkSession, root, df.schema, slices
        width = max(((hi or 0.0) - (lo or 0.0)) / slices, 1e-6)
        at = F.floor((F.col(ts).cast("double") - F.lit(lo or 0.0)) / F.lit(width))
        at = F.least(F.greatest(F.coalesce(at, F.lit(0)), F.lit(0)), F.lit(slices - 1)).cast("int")
        df.withColumn("_slice", at).write.partitionBy("_slice").parquet(f"{root}/parts")
        self.src = f"{root}/src"
        ensure_dir(self.spark, self.src)

    def hand_over(self, i: int) -> None:
        part = f"{self.root}/parts/_slice={i}"
        if path_exists(self.spark, part):                # a range may hold no rows
            move(self.spark, part, f"{self.src}/part-{i}")

    def replay(self, i: int) -> None:
        """Hands the files of slice ``i`` over once more: under another name they are new to the stream."""
        part = f"{self.src}/part-{i}"
        if path_exists(self.spark, part):
            move(self.spark, part, f"{self.src}/replay-{i}")

    def rows(self) -> DataFrame:
        """What was handed over, each row once."""
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.src)

    def stream(self) -> DataFrame:
        ensure_dir(self.spark, self.src)
        return (self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
                .parquet(self.src))


def _silver_slices(spark: SparkSession, sf: str, topic: str, consumer: str, root: str, slices: int = SLICES) -> Slices:
    """Silver rows narrowed to what ``consumer`` reads (see catalog.NEEDS), in slices; the
    bounds come from one column of the bronze copy."""
    from .catalog import NEEDS, bronze, silver
    b = bronze(spark, sf, topic, keep=NEEDS[consumer])
    r = b.agg(F.min("kafka_timestamp").cast("double").alias("lo"), F.max("kafka_timestamp").cast("double").alias("hi")).first()
    return Slices(silver(spark, sf, topic, bronze_df=b, keep=NEEDS[consumer]), "created_at_ts", root, r["lo"], r["hi"], slices)


def stream_gold_log(spark: SparkSession, sf: str, name: str, duration: str,
                    slices: int = SLICES, after_slice=lambda folder: None) -> tuple[str, DataFrame]:
    """Silver (batch) -> time slices -> gold update stream (K3) restarted per
    slice, then ``after_slice(log folder)``.  Returns the log folder and the
    log read with its declared schema (``batch_id`` from the folder names)."""
    topic, build = gold.GOLD_BUILDERS[name]
    root = scratch(spark, f"gold-{name}")
    feed = _silver_slices(spark, sf, topic, name, f"{root}/slices", slices)
    out, ckpt = f"{root}/gold", f"{root}/_checkpoints/gold"
    for i in range(slices):
        feed.hand_over(i)
        _run(run_update(build(feed.stream(), duration, delay=DELAY), out, ckpt, trigger="availableNow"))
        after_slice(out)
    drop_scratch(spark, f"{root}/slices")
    schema = GOLD_TABLES[name][0]
    return out, read_layer(spark, out, with_batch_id(schema))


def q_gold_revenue_stream_current(spark, sf):
    """W2 + W8 + K3 + K5: streamed 5-minute revenue, current view = batch."""
    _, log = stream_gold_log(spark, sf, "revenue", "5 minutes")
    cur = current_state(log, GOLD_TABLES["revenue"][1])
    return cur.withColumn("total_revenue", F.round("total_revenue", 2))


def q_gold_revenue_stream_final(spark, sf):
    """W5 append mode: only windows the watermark has closed are emitted."""
    root = scratch(spark, "gold-final")
    feed = _silver_slices(spark, sf, "payments", "revenue", f"{root}/slices")
    out, ckpt = f"{root}/gold", f"{root}/_checkpoints/gold"
    for i in range(feed.n):
        feed.hand_over(i)
        _run(run_append(gold.revenue(feed.stream(), "5 minutes", delay=DELAY), out, ckpt, trigger="availableNow"))
    drop_scratch(spark, f"{root}/slices")
    res = read_layer(spark, out, GOLD_TABLES["revenue"][0])
    return res.withColumn("total_revenue", F.round("total_revenue", 2))


def q_gold_revenue_stream_late(spark, sf):
    """5-minute revenue in append mode when the first third of the
    events arrives last, after the watermark has passed all of it: those
    rows are dropped and never change a window."""
    root = scratch(spark, "gold-late")
    feed = _silver_slices(spark, sf, "payments", "revenue", f"{root}/slices")
    out, ckpt = f"{root}/gold", f"{root}/_checkpoints/gold"
    for i in [*range(1, feed.n), 0]:
        feed.hand_over(i)
        _run(run_append(gold.revenue(feed.stream(), "5 minutes", delay=DELAY), out, ckpt, trigger="availableNow"))
    drop_scratch(spark, f"{root}/slices")
    res = read_layer(spark, out, GOLD_TABLES["revenue"][0])
    return res.withColumn("total_revenue", F.round("total_revenue", 2))


def _bronze_stream(topic: str, shape=lambda df: df):
    def q(spark, sf):
        root = scratch(spark, f"bronze-stream-{topic}")
        src, out, ckpt = f"{root}/envelope", f"{root}/bronze", f"{root}/_checkpoints/bronze"
        write_layer(messages(spark, sf, topic), src)
        bronze = to_bronze(read_envelope_stream(spark, src), ENTITY[topic], stamp=True)
        _run(run_append(bronze, out, ckpt, trigger="availableNow"))
        drop_scratch(spark, src)
        return shape(read_layer(spark, out, bronze_schema(ENTITY[topic], stamp=True)).drop("ingested_at"))
    q.__name__ = f"q_bronze_{topic}_stream"
    q.__doc__ = "S1 + K1 + P4: envelope stream -> bronze append sink, stamps dropped."
    return q


def _replayed_stream(spark: SparkSession, sf: str, topic: str, slices: int) -> tuple[DataFrame, list, Slices]:
    """``silver_stream`` and the slices it was fed from, which are not dropped."""
    root = scratch(spark, f"silver-stream-{topic}")
    out, ckpt = f"{root}/silver", f"{root}/_checkpoints/silver"
    bronze = to_bronze(messages(spark, sf, topic), ENTITY[topic], stamp=True)
    r = message_times(spark, sf, topic).agg(F.min("timestamp").cast("double").alias("lo"), F.max("timestamp").cast("double").alias("hi"),
                                            F.count(F.lit(1)).alias("n")).first()
    lo, hi = r["lo"] or 0.0, r["hi"] or 0.0
    width = max((hi - lo) / slices, 1e-6)
    # every row is written once
    feed = Slices(bronze, "kafka_timestamp", f"{root}/slices", lo, hi, slices)
    delay = f"{int(3 * width) + 600} seconds"
    progress = []
    for step in range(2 * feed.n):
        # slice i, then its replay together with nothing else
        feed.replay(step // 2) if step % 2 else feed.hand_over(step // 2)
        silver = silver_entity(feed.stream(), topic, delay=delay)
        with state_by_task(spark, r["n"]):
            q = run_append(silver, out, ckpt, trigger="availableNow")
        _run(q)
        progress += [dict(p["stateOperators"][0], slice=step) for p in q.recentProgress if p["stateOperators"]]
    return read_layer(spark, out, silver_schema(ENTITY[topic], stamp=True)), progress, feed


def silver_stream(spark: SparkSession, sf: str, topic: str, slices: int = 4) -> tuple[DataFrame, list]:
    """D1 + K2: bronze rows through the silver stream, each slice of arrival
    order followed in the next batch by its own replay.  The watermark delay
    is longer than two slices, so replayed rows are not late: only their
    keys' state can drop them.  Returns silver and the queries' progress."""
    silver, progress, feed = _replayed_stream(spark, sf, topic, slices)
    drop_scratch(spark, feed.root)
    return silver, progress


def _silver_stream(topic: str, shape=lambda df: df, settled: bool = False):
    def q(spark, sf):
        silver, _, feed = _replayed_stream(spark, sf, topic, 4)
        # of two copies in one micro-batch either may be kept: no offset
        rows = silver.drop("ingested_at", "cleaned_at", "offset")
        if settled:
            return _settled_columns(rows, feed.rows())    # which stay until the caller clears them
        drop_scratch(spark, feed.root)
        return shape(rows)
    q.__name__ = f"q_silver_{topic}_stream"
    q.__doc__ = "D1 + K2: every bronze row fed twice, each key comes out once."
    return q


def _stamps(topic: str):
    def q(spark, sf):
        silver, _ = silver_stream(spark, sf, topic, slices=1)
        return silver.agg(F.count(F.lit(1)).alias("silver_rows"), F.count("ingested_at").alias("ingested"),
                          F.count("cleaned_at").alias("cleaned"),
                          F.count_if(F.col("cleaned_at") >= F.col("ingested_at")).alias("in_order"))
    q.__name__ = f"q_stamps_{topic}"
    q.__doc__ = "P4 + P6: every silver row is stamped by both layers, in order."
    return q


def _load(name: str, duration: str, money: tuple[str, ...], current: bool = True, slices: int = SLICES, table: bool = False):
    def q(spark, sf):
        folder, _ = stream_gold_log(spark, sf, name, duration, slices)
        schema, keys, target, cols = GOLD_TABLES[name]
        if table:
            create_database(spark, "lakeweave_wh")
            target = f"lakeweave_wh.{target}_{scratch(spark, 'wh').rsplit('-', 1)[1]}"
        else:
            target = f"{scratch(spark, f'warehouse-{name}')}/{target}"
        loaded = load_table(spark, folder, schema, keys, cols, target, current=current)
        return loaded.select(*[F.round(c, 2).alias(c) if c in money else F.col(c) for c in loaded.columns])
    q.__name__ = f"q_load_{name}"
    return q


def _load_incremental(name: str, duration: str, money: tuple[str, ...]):
    def q(spark, sf):
        schema, keys, _, cols = GOLD_TABLES[name]
        target = scratch(spark, f"warehouse-{name}")
        stream_gold_log(spark, sf, name, duration, after_slice=lambda log: load_increment(spark, log, schema, keys, target))
        loaded = read_loaded(spark, target, schema, cols)
        return loaded.select(*[F.round(c, 2).alias(c) if c in money else F.col(c) for c in loaded.columns])
    q.__name__ = f"q_load_{name}_incremental"
    q.__doc__ = "K4 by increments: one load after each restart of the gold stream equals one full load at the end."
    return q


def _items(b: DataFrame) -> DataFrame:
    rest = [c for c in b.columns if c != "items"]
    return b.select(*rest, F.explode_outer("items").alias("item")).select(*rest, "item.*")


def _settled_columns(s: DataFrame, bronze: DataFrame) -> DataFrame:
    """Inventory ids repeat with other contents, and of two copies in one
    micro-batch either may be kept: each column of a kept row, where all valid
    bronze rows of its id agree on it (NULL elsewhere), and how many columns that is.
    The kept row is one of those, so they agree where each equals it."""
    key = ENTITY_KEY["inventory"]
    valid = to_silver(bronze, rules_for("inventory"), stamp=False)
    rest = [c for c in s.columns if c != key]
    both = valid.select(key, *[F.col(c).alias(f"_{c}") for c in rest]).join(s, key)
    same = both.groupBy(key).agg(*[F.bool_and(F.col(f"_{c}").eqNullSafe(F.col(c))).alias(f"_{c}") for c in rest])
    settled = sum((F.col(f"_{c}").cast("int") for c in rest), F.lit(0))
    return s.join(same, key).select(key, *[F.when(F.col(f"_{c}"), F.col(c)).alias(c) for c in rest], settled.alias("settled"))


def _item_count(s: DataFrame) -> DataFrame:
    return s.select(*[c if c != "items" else F.size("items").alias("item_count") for c in s.columns])


def q_customer_gaps_stream(spark, sf):
    """Customers as they go: a session of orders is emitted when the watermark has passed its gap."""
    from .catalog import SESSION_GAP
    root = scratch(spark, "customer-gaps")
    feed = _silver_slices(spark, sf, "orders", "customer_activity", f"{root}/slices")
    out, ckpt = f"{root}/gone", f"{root}/_checkpoints/gone"
    for i in range(feed.n):
        feed.hand_over(i)
        gone = sessions_stream(feed.stream(), ["customer_id"], "created_at_ts", SESSION_GAP, {"spent": F.sum("total_amount")}, DELAY)
        _run(run_append(gone, out, ckpt, trigger="availableNow"))
    drop_scratch(spark, f"{root}/slices")
    return read_layer(spark, out, gone.schema).withColumn("spent", F.round("spent", 2))


WITHIN = "5 days"


def q_orphan_payments_stream(spark, sf):
    """Payments for whose order no payable order was placed within 5 days (order times scaled, see catalog)."""
    from .catalog import NEEDS, order_time, silver
    root = scratch(spark, "orphans")
    payments = silver(spark, sf, "payments", keep=["order_id"]).select("payment_id", "order_id", "created_at_ts")
    payable = silver(spark, sf, "orders", keep=NEEDS["payable_orders"]).filter(F.coalesce(F.col("order_status") != "cancelled", F.lit(True)))
    orders = payable.select(F.substring_index("order_id", "-", 1).alias("order_number"), order_time().alias("placed_at"))
    feeds = []
    for df, at, name in ((payments, "created_at_ts", "payments"), (orders, "placed_at", "orders")):
        write_layer(df, f"{root}/once-{name}")
        once = read_layer(spark, f"{root}/once-{name}", df.schema)
        r = once.agg(F.min(at).cast("double").alias("lo"), F.max(at).cast("double").alias("hi")).first()
        feeds.append(Slices(once, at, f"{root}/slices-{name}", r["lo"], r["hi"]))
    out, ckpt = f"{root}/orphans", f"{root}/_checkpoints/orphans"
    for i in range(SLICES):
        for feed in feeds:
            feed.hand_over(i)
        lost = orphans_stream(feeds[0].stream(), "order_id", "created_at_ts", feeds[1].stream(), "order_number", "placed_at", WITHIN, DELAY)
        _run(run_append(lost, out, ckpt, trigger="availableNow"))
    drop_scratch(spark, *[f"{root}/{part}-{name}" for part in ("once", "slices") for name in ("payments", "orders")])
    return read_layer(spark, out, payments.schema)


def stream_queries() -> dict:
    return {
        "bronze_payments_stream": _bronze_stream("payments"),
        "bronze_orders_stream": _bronze_stream("orders", _items),
        "bronze_inventory_stream": _bronze_stream("inventory"),
        "bronze_customers_stream": _bronze_stream("customers"),
        "silver_dedup_stream": _silver_stream("payments"),
        "silver_orders_stream": _silver_stream("orders", _item_count),
        "silver_inventory_stream": _silver_stream("inventory", settled=True),
        "stamps_payments": _stamps("payments"),
        "gold_revenue_stream_current": q_gold_revenue_stream_current,
        "gold_revenue_stream_final": q_gold_revenue_stream_final,
        "gold_revenue_stream_late": q_gold_revenue_stream_late,
        "customer_gaps_stream": q_customer_gaps_stream,
        "orphan_payments_stream": q_orphan_payments_stream,
        "load_revenue": _load("revenue", "5 minutes", ("total_revenue",)),
        "load_revenue_raw": _load("revenue", "5 minutes", ("total_revenue",), current=False, slices=1),
        "load_revenue_table": _load("revenue", "5 minutes", ("total_revenue",), table=True),
        "load_revenue_incremental": _load_incremental("revenue", "5 minutes", ("total_revenue",)),
        "load_products": _load("product_units", "1 hour", ()),
        "load_activity": _load("customer_activity", "1 hour", ("total_spent",)),
    }
