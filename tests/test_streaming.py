"""Streaming: D1 on streams, K3 update log + K5 current view, replay
idempotence, restart from checkpoint, append-mode tail, sink guards."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeweave.operators import gold
from lakeweave.operators.current import current_state
from lakeweave.operators.dedup import dedup_latest, dedup_stream
from lakeweave.schemas import GOLD_REVENUE, with_batch_id
from lakeweave.sources.layers import read_layer, read_layer_stream
from lakeweave.streaming.runner import batch_writer, run_append, run_update

T = dt.datetime
SCHEMA = "payment_id string, amount double, created_at_ts timestamp"


def _write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def _slices():
    base = T(2024, 1, 1)
    out = []
    for s in range(3):                            # three event-time ordered slices
        out.append([(f"P{s}{i}", float(i + 1), base + dt.timedelta(minutes=40 * s + 3 * i)) for i in range(12)])
    return out


def test_update_log_current_view_equals_batch(spark, tmp):
    src, out, ckpt = f"{tmp}/src", f"{tmp}/gold", f"{tmp}/ckpt"
    all_rows = []
    for rows in _slices():
        _write(spark, rows, src)
        all_rows += rows
        stream = read_layer_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
        _run(run_update(gold.revenue(stream, "1 hour", delay="10 minutes"), out, ckpt, trigger="availableNow"))
    log = read_layer(spark, out, with_batch_id(GOLD_REVENUE))
    # one row per window per batch that changed it: more rows than windows
    assert log.count() > log.select("window_start").distinct().count()
    cur = {(r.window_start, r.total_revenue, r.transaction_count)
           for r in current_state(log, ["window_start", "window_end"]).collect()}
    batch = {(r.window_start, r.total_revenue, r.transaction_count)
             for r in gold.revenue(spark.createDataFrame(all_rows, SCHEMA), "1 hour").collect()}
    assert cur == batch

    # restart from the checkpoint with no new input adds nothing
    before = sorted(os.listdir(out))
    stream = read_layer_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
    _run(run_update(gold.revenue(stream, "1 hour", delay="10 minutes"), out, ckpt, trigger="availableNow"))
    assert sorted(os.listdir(out)) == before


def test_replayed_batch_overwrites_itself(spark, tmp):
    out = f"{tmp}/gold"
    df = spark.createDataFrame([(T(2024, 1, 1), T(2024, 1, 1, 1), 5.0, 2)],
                               "window_start timestamp, window_end timestamp, total_revenue double, "
                               "transaction_count long")
    write = batch_writer(out)
    write(df, 3)
    write(df, 3)                                  # replay after a crash
    assert read_layer(spark, out, with_batch_id(GOLD_REVENUE)).count() == 1


def test_run_update_refuses_half_state(spark, tmp):
    os.makedirs(f"{tmp}/gold")
    stream = read_layer_stream(spark, f"{tmp}/src", spark.createDataFrame([], SCHEMA).schema)
    with pytest.raises(RuntimeError):
        run_update(gold.revenue(stream, "1 hour", delay="10 minutes"), f"{tmp}/gold", f"{tmp}/ckpt")


def test_append_mode_withholds_open_windows(spark, tmp):
    src, out, ckpt = f"{tmp}/src", f"{tmp}/gold", f"{tmp}/ckpt"
    rows = [r for s in _slices() for r in s]
    _write(spark, rows, src)
    stream = read_layer_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
    _run(run_append(gold.revenue(stream, "1 hour", delay="10 minutes"), out, ckpt, trigger="availableNow"))
    emitted = read_layer(spark, out, GOLD_REVENUE)
    max_ts = max(r[2] for r in rows)
    assert emitted.count() >= 1
    assert emitted.filter(F.col("window_end") > F.lit(max_ts - dt.timedelta(minutes=10))).count() == 0


def test_stream_dedup_within_watermark(spark, tmp):
    src, out, ckpt = f"{tmp}/src", f"{tmp}/silver", f"{tmp}/ckpt"
    schema = spark.createDataFrame([], SCHEMA).schema
    rows = [("P1", 1.0, T(2024, 1, 1, 0, 0)), ("P1", 2.0, T(2024, 1, 1, 0, 1)), ("P2", 3.0, T(2024, 1, 1, 0, 2))]
    for batch in (rows, rows[:1] + [("P3", 4.0, T(2024, 1, 1, 0, 3))]):     # same id twice, in two batches
        _write(spark, batch, src)
        _run(run_append(dedup_stream(read_layer_stream(spark, src, schema), "payment_id"), out, ckpt,
                        trigger="availableNow"))
    ids = sorted(r.payment_id for r in spark.read.schema(schema).parquet(out).collect())
    assert ids == ["P1", "P2", "P3"]


def test_batch_only_operators_refuse_streams(spark, tmp):
    stream = read_layer_stream(spark, f"{tmp}/src", spark.createDataFrame([], SCHEMA).schema)
    with pytest.raises(ValueError):
        dedup_latest(stream, "payment_id", ["created_at_ts"])
    with pytest.raises(ValueError):
        current_state(stream, ["payment_id"])


def test_dedup_across_batches_is_by_key_not_by_lateness(spark):
    """Replayed rows come in a later batch inside the delay: none is late,
    and D1's state drops every one of them."""
    from lakeweave.plans.streams import silver_stream
    silver, progress = silver_stream(spark, "/root/testdata/sf0.001", "payments")
    assert silver.count() == silver.select("payment_id").distinct().count() > 0
    assert sum(p["numRowsDroppedByWatermark"] for p in progress) == 0
    replays = [p for p in progress if p["slice"] % 2 == 1]
    dropped = sum(p["customMetrics"]["numDroppedDuplicateRows"] for p in replays)
    assert dropped >= silver.count()                    # every key came again
    assert sum(p["numRowsUpdated"] for p in replays) == 0


def test_a_key_comes_again_after_its_state_expired(spark, tmp):
    src, out, ckpt = f"{tmp}/src", f"{tmp}/silver", f"{tmp}/ckpt"
    schema = spark.createDataFrame([], SCHEMA).schema
    base = T(2024, 1, 1)
    rows = [("A", 0), ("A", 8), ("B", 21), ("C", 22), ("A", 23)]
    for key, minute in rows:
        _write(spark, [(key, 1.0, base + dt.timedelta(minutes=minute))], src)
        _run(run_append(dedup_stream(read_layer_stream(spark, src, schema), "payment_id"), out, ckpt, trigger="availableNow"))
    got = sorted((r.payment_id, r.created_at_ts.minute) for r in spark.read.schema(schema).parquet(out).collect())
    assert got == [("A", 0), ("A", 23), ("B", 21), ("C", 22)]


def test_processing_time_trigger_runs_until_stopped(spark, tmp):
    """W6 + W9: a query with a processing-time trigger picks up files as they
    come, batch after batch, and ends only when it is stopped."""
    import time

    schema = "k string, v int"
    src = spark.readStream.schema(schema)
    spark.createDataFrame([("a", 1)], schema).write.parquet(f"{tmp}/in/0")
    q = run_append(src.option("recursiveFileLookup", "true").parquet(f"{tmp}/in"), f"{tmp}/out", f"{tmp}/ckpt", trigger="1 seconds")

    def wait(rows):
        end = time.time() + 90
        while time.time() < end and spark.read.schema(schema).parquet(f"{tmp}/out").count() < rows:
            time.sleep(0.5)
        return spark.read.schema(schema).parquet(f"{tmp}/out").count()

    try:
        assert not q.awaitTermination(1) and wait(1) == 1
        spark.createDataFrame([("b", 2), ("c", 3)], schema).write.parquet(f"{tmp}/in/1")
        assert wait(3) == 3 and q.isActive
        assert {p["batchId"] for p in q.recentProgress if p["numInputRows"]} == {0, 1}
    finally:
        q.stop()
    assert not q.isActive and q.exception() is None


def test_replays_are_not_written_again(spark, monkeypatch):
    from lakeweave.plans import streams
    from lakeweave.sources.testdata import messages
    sf, written, calls = "/root/testdata/sf0.001", [], []

    class Counted(streams.Slices):
        def __init__(self, df, *a, **k):
            written.append(df.count())
            super().__init__(df, *a, **k)

    monkeypatch.setattr(streams, "Slices", Counted)
    monkeypatch.setattr(streams, "messages", lambda *a: calls.append(a) or messages(*a))
    out = streams.stream_queries()["silver_inventory_stream"](spark, sf)
    assert out.count() > 0
    assert written == [messages(spark, sf, "inventory").count()] and len(calls) == 1
    assert "part" not in {f.rsplit("/", 1)[1] for f in out.inputFiles()}     # the tables are not read again


def _inventory_tables(spark, tmp, lines=64):
    """Order k has line 1 on day k; every eighth order has it once more, the next day."""
    base = T(2024, 1, 1)
    rows = [(k, k % 5, k % 3, 1, 3.0, base + dt.timedelta(days=k + again))
            for k in range(1, lines + 1) for again in range(2 if k % 8 == 0 else 1)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp") \
        .write.parquet(f"{tmp}/lineitem.parquet")
    spark.createDataFrame([(k, f"part {k}") for k in range(5)], "p_partkey long, p_name string").write.parquet(f"{tmp}/part.parquet")
    return rows


def test_replayed_streams_keep_no_state_between_batches(spark, tmp, monkeypatch):
    """No batch finds a store that an earlier one left loaded, and a stream
    over more rows gets more partitions; the session keeps its settings."""
    from lakeweave.plans import streams
    from lakeweave.streaming import runner
    rows = _inventory_tables(spark, tmp)
    monkeypatch.setattr(runner, "STATE_ROWS", 10, raising=False)
    keys = ["spark.sql.streaming.stateStore.unloadOnCommit", "spark.sql.shuffle.partitions"]
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = [spark.conf.get(k, None) for k in keys]
    kept = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        silver, progress, feed = streams._replayed_stream(spark, tmp, "inventory", 4)
    finally:
        spark.conf.set(provider, kept)
    assert [spark.conf.get(k, None) for k in keys] == before
    assert len(progress) > 2 * feed.n                   # some restarts run a second batch, without rows
    assert sum(p["customMetrics"]["loadedMapCacheHitCount"] for p in progress) == 0
    assert {p["numShufflePartitions"] for p in progress} == {-(-len(rows) // 10)}
    # ids of valid messages, once each, though every message came twice or more
    ids = [r.inventory_id for r in silver.collect()]
    valid = {f"INV{k:010d}01" for k, *_ in rows if k % 101 and k % 89 and k % 83}
    assert sorted(ids) == sorted(valid)


def test_state_settings_are_put_back(spark):
    from lakeweave.streaming.runner import STATE_ROWS, state_by_task
    parts, unload = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.unloadOnCommit"
    old = spark.conf.get(parts)
    with state_by_task(spark, 0):
        assert (spark.conf.get(parts), spark.conf.get(unload)) == (old, "true")
    with pytest.raises(ValueError):
        with state_by_task(spark, 100 * STATE_ROWS + 1):
            assert spark.conf.get(parts) == "101"
            raise ValueError
    assert spark.conf.get(parts) == old and spark.conf.get(unload, None) is None
