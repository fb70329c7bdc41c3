"""Incremental loads: equal to one full load, safe against kills, late events merged in any order."""
import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from lakeweave.operators.current import current_state
from lakeweave.operators.history import history
from lakeweave.schemas import GOLD_TABLES, with_batch_id
from lakeweave.session import list_dir
from lakeweave.sinks import incremental as inc
from test_history import EVENTS, make_events, rows_of, versions

SCHEMA, KEYS, _, COLUMNS = GOLD_TABLES["revenue"]
T0 = dt.datetime(2024, 1, 1)


def write_batch(spark, log, number, windows, amount):
    rows = [(T0 + dt.timedelta(minutes=5 * w), T0 + dt.timedelta(minutes=5 * w + 5), float(amount + w), 1) for w in windows]
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(f"{log}/batch_id={number}")


def expect(spark, log):
    return rows_of(current_state(spark.read.schema(with_batch_id(SCHEMA)).parquet(log), KEYS).select(*COLUMNS))


def loaded(spark, target):
    return rows_of(inc.read_loaded(spark, target, SCHEMA, COLUMNS, text_timestamps=False))


def test_three_loads_equal_one_full_load(spark, tmp):
    log, target = f"{tmp}/log", f"{tmp}/table"
    for number, (windows, amount) in enumerate([(range(40), 10), (range(30, 60), 100), ([3, 59, 200], 1000)]):
        write_batch(spark, log, number, windows, amount)
        snap = inc.load_increment(spark, log, SCHEMA, KEYS, target, buckets=8)
        assert snap.upto == number and loaded(spark, target) == expect(spark, log)
    once = inc.load_increment(spark, log, SCHEMA, KEYS, f"{tmp}/once", buckets=8)
    assert once.load == 0 and loaded(spark, f"{tmp}/once") == loaded(spark, target)
    assert inc.load_increment(spark, log, SCHEMA, KEYS, target).load == 2           # nothing new: no load


def test_a_load_reads_new_batches_and_writes_touched_buckets_only(spark, tmp):
    log, target = f"{tmp}/log", f"{tmp}/table"
    write_batch(spark, log, 0, range(200), 1)
    first = inc.load_increment(spark, log, SCHEMA, KEYS, target, buckets=16)
    write_batch(spark, log, 1, [7], 5)
    second = inc.load_increment(spark, log, SCHEMA, KEYS, target, buckets=16)
    assert len(first.folders) == 16
    assert sorted(second.folders.values()) == [0] * 15 + [1]
    assert [d for d in list_dir(spark, f"{target}/data/load=1") if d.startswith("bucket=")] == [
        f"bucket={b}" for b, n in second.folders.items() if n == 1]
    # the old batch folder is not needed any more
    write_batch(spark, log, 2, [8], 6)
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(f"{log}/batch_id=0")
    inc.load_increment(spark, log, SCHEMA, KEYS, target)
    assert len(loaded(spark, target)) == 200


def test_killed_between_data_and_commit(spark, tmp):
    log, target = f"{tmp}/log", f"{tmp}/table"
    write_batch(spark, log, 0, range(30), 1)
    inc.load_increment(spark, log, SCHEMA, KEYS, target, buckets=4)
    before = loaded(spark, target)
    write_batch(spark, log, 1, range(20, 50), 7)

    def kill():
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        inc.load_increment(spark, log, SCHEMA, KEYS, target, before_commit=kill)
    assert loaded(spark, target) == before                                          # readers see the old table, whole
    write_batch(spark, log, 2, [100], 9)                                            # meanwhile more arrives
    inc.load_increment(spark, log, SCHEMA, KEYS, target)
    assert loaded(spark, target) == expect(spark, log)


def test_vacuum_keeps_the_current_table(spark, tmp):
    log, target = f"{tmp}/log", f"{tmp}/table"
    for number in range(3):
        write_batch(spark, log, number, range(number, 40), number)
        inc.load_increment(spark, log, SCHEMA, KEYS, target, buckets=4)
    want = loaded(spark, target)
    inc.vacuum(spark, target)
    assert loaded(spark, target) == want and list_dir(spark, f"{target}/commits") == ["load=2"]
    assert [d for d in list_dir(spark, f"{target}/data") if d.startswith("load=")] == ["load=2"]
    write_batch(spark, log, 3, [1], 50)
    inc.load_increment(spark, log, SCHEMA, KEYS, target)
    assert loaded(spark, target) == expect(spark, log)


def test_empty_log(spark, tmp):
    spark.createDataFrame([], with_batch_id(SCHEMA)).write.parquet(f"{tmp}/log/batch_id=0")
    assert inc.load_increment(spark, f"{tmp}/log", SCHEMA, KEYS, f"{tmp}/table").load == -1
    assert loaded(spark, f"{tmp}/table") == []


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[1:4])
def test_late_events_in_any_order_give_the_same_history(spark, tmp, order):
    data = make_events(6, 400)
    events = spark.createDataFrame(data, EVENTS)
    args = (["k"], "t", ["city", "segment"], ["o"])
    for load in order:
        inc.merge_history(events.filter(F.col("o") % 3 == load), *args, tmp, buckets=4)
    inc.merge_history(events.filter(F.col("o") % 3 == order[0]), *args, tmp)         # a load merged twice
    schema = inc.versions_schema(events, *args[:3])
    assert rows_of(inc.read_history(spark, tmp, schema)) == sorted(map(str, versions(data)))
    assert rows_of(history(events, *args)) == sorted(map(str, versions(data)))


def test_a_late_event_splits_a_stored_interval_and_touches_one_bucket(spark, tmp):
    t = [T0 + dt.timedelta(hours=h) for h in range(6)]
    first = [(f"k{i}", t[h], 10 * i + h, "a", "x", 0) for i in range(40) for h in (0, 2, 4)]
    args = (["k"], "t", ["city", "segment"], ["o"])
    events = spark.createDataFrame(first, EVENTS)
    inc.merge_history(events, *args, tmp, buckets=8)
    schema = inc.versions_schema(events, *args[:3])
    late = spark.createDataFrame([("k7", t[1], 999, "b", "x", 0)], EVENTS)
    snap = inc.merge_history(late, *args, tmp)
    assert sorted(snap.folders.values()) == [0] * 7 + [1]
    got = inc.read_history(spark, tmp, schema).filter("k = 'k7'").orderBy("version").collect()
    assert [(r.city, r.valid_from, r.valid_to) for r in got] == [("a", t[0], t[1]), ("b", t[1], t[2]), ("a", t[2], None)]
    assert inc.read_history(spark, tmp, schema).count() == 39 + 3


def test_incremental_load_from_the_command_line(spark, tmp):
    from lakeweave import jobs
    args = ["load", "--name", "revenue", "--root", tmp, "--incremental", "--target", f"{tmp}/table", "--buckets", "4"]
    write_batch(spark, f"{tmp}/gold/revenue", 0, range(9), 1)
    jobs.main(args)
    write_batch(spark, f"{tmp}/gold/revenue", 1, range(5, 12), 2)
    jobs.main(args)
    assert loaded(spark, f"{tmp}/table") == expect(spark, f"{tmp}/gold/revenue")
    assert inc.snapshot(spark, f"{tmp}/table").load == 1
    with pytest.raises(SystemExit):
        jobs.main(args[:6])
