"""S5, P9, P10, K4, K7 warehouse load; A4 layer counts."""
import datetime as dt

from lakeweave.operators.quality import layer_counts
from lakeweave.schemas import GOLD_REVENUE, GOLD_TABLES
from lakeweave.sinks.files import create_database, load_table

T = dt.datetime
COLS = GOLD_TABLES["revenue"][3]
KEYS = GOLD_TABLES["revenue"][1]


def _log(spark, path):
    rows = [(T(2024, 1, 1), T(2024, 1, 1, 0, 5), 5.0, 1, 0),
            (T(2024, 1, 1), T(2024, 1, 1, 0, 5), 9.5, 2, 1),          # later batch: the true total
            (T(2024, 1, 1, 0, 5), T(2024, 1, 1, 0, 10), 1.25, 1, 1)]
    df = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, total_revenue double, "
                                     "transaction_count long, batch_id long")
    df.write.partitionBy("batch_id").parquet(path)


def test_load_current_and_raw(spark, tmp):
    _log(spark, f"{tmp}/gold")
    cur = load_table(spark, f"{tmp}/gold", GOLD_REVENUE, KEYS, COLS, f"{tmp}/target")
    assert cur.columns == COLS
    got = {(r.window_start, r.total_revenue, r.transaction_count) for r in cur.collect()}
    assert got == {("2024-01-01 00:00:00.000000", 9.5, 2), ("2024-01-01 00:05:00.000000", 1.25, 1)}
    raw = load_table(spark, f"{tmp}/gold", GOLD_REVENUE, KEYS, COLS, f"{tmp}/target", current=False)
    assert raw.count() == 3                      # full refresh replaced the previous load


def test_load_from_empty_folder_leaves_target(spark, tmp):
    _log(spark, f"{tmp}/gold")
    load_table(spark, f"{tmp}/gold", GOLD_REVENUE, KEYS, COLS, f"{tmp}/target")
    spark.createDataFrame([], "window_start timestamp").write.parquet(f"{tmp}/empty")
    assert load_table(spark, f"{tmp}/empty", GOLD_REVENUE, KEYS, COLS, f"{tmp}/target") is None
    assert spark.read.parquet(f"{tmp}/target").count() == 2


def test_load_into_table(spark, tmp):
    _log(spark, f"{tmp}/gold")
    create_database(spark, "lw_wh")
    create_database(spark, "lw_wh")              # idempotent
    out = load_table(spark, f"{tmp}/gold", GOLD_REVENUE, KEYS, COLS, "lw_wh.raw_revenue")
    assert out.count() == 2
    spark.sql("DROP TABLE lw_wh.raw_revenue")


def test_layer_counts(spark):
    b = spark.range(10)
    s = spark.range(7)
    got = {r.topic: (r.bronze_rows, r.silver_rows)
           for r in layer_counts({"orders": (b, s), "payments": (s, s)}).collect()}
    assert got == {"orders": (10, 7), "payments": (7, 7)}
    empty = spark.range(0)
    assert [tuple(r) for r in layer_counts({"inventory": (empty, empty)}).collect()] == [("inventory", 0, 0)]


def test_text_timestamps_are_utc_in_any_session_zone(spark):
    from lakeweave.functions.timefmt import timestamps_as_text
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:07.5+00:00' AS t, "
                   "TIMESTAMP_NTZ'2024-01-01 00:00:07.5' AS n")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Ho_Chi_Minh", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = timestamps_as_text(df).first()
            assert (r.t, r.n) == ("2024-01-01 00:00:07.500000", "2024-01-01 00:00:07.500000"), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_compact_layer_merges_small_files(spark, tmp):
    import os
    from lakeweave.sinks.files import compact_layer
    schema = "k long, v string"
    for i in range(6):                                   # six appends -> many small files
        spark.range(i * 10, i * 10 + 10).selectExpr("id AS k", "cast(id AS string) AS v") \
            .repartition(3).write.mode("append").parquet(f"{tmp}/small")
    src_files = [f for f in os.listdir(f"{tmp}/small") if f.endswith(".parquet")]
    st = spark.createDataFrame([], schema).schema
    n = compact_layer(spark, f"{tmp}/small", f"{tmp}/compact", st)
    out_files = [f for f in os.listdir(f"{tmp}/compact") if f.endswith(".parquet")]
    assert n == 1 and len(out_files) == 1 < len(src_files)
    assert sorted(r.k for r in spark.read.parquet(f"{tmp}/compact").collect()) == list(range(60))


def test_shared_root_when_checkpoint_dir_unset():
    from lakeweave import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        applicationId = "app-test-unset"
        registered = None

        def getCheckpointDir(self):
            return self.registered

        def setCheckpointDir(self, d):
            self.registered = d

    class Spark:
        conf = Conf()
        sparkContext = Ctx()

    fake = Spark()
    root = session.shared_root(fake)
    assert root and fake.sparkContext.registered == root
    assert session.shared_root(fake) == root          # registered once, reused


def test_text_times_in_a_daylight_saving_gap(spark):
    from lakeweave.functions.timefmt import iso_utc, timestamps_as_text
    from pyspark.sql import functions as F
    df = spark.sql("SELECT TIMESTAMP'2024-03-10 02:30:00+00:00' AS t, TIMESTAMP_NTZ'2024-03-10 02:30:00' AS n")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = timestamps_as_text(df).first()
        assert (r.t, r.n) == ("2024-03-10 02:30:00.000000",) * 2
        assert df.select(iso_utc(F.col("n")).alias("x")).first().x == "2024-03-10T02:30:00.000000+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_missing_folder_is_an_error_and_an_empty_one_is_not(spark, tmp):
    import os
    import pytest
    from lakeweave.sources.layers import read_layer
    with pytest.raises(FileNotFoundError):
        read_layer(spark, f"{tmp}/mistyped", GOLD_REVENUE)
    os.makedirs(f"{tmp}/empty")
    assert read_layer(spark, f"{tmp}/empty", GOLD_REVENUE).count() == 0
    assert load_table(spark, f"{tmp}/mistyped", GOLD_REVENUE, KEYS, COLS, f"{tmp}/target") is None


def test_failed_load_leaves_the_target(spark, tmp):
    import pytest
    _log(spark, f"{tmp}/gold")
    load_table(spark, f"{tmp}/gold", GOLD_REVENUE, KEYS, COLS, f"{tmp}/target")
    with pytest.raises(Exception):
        load_table(spark, f"{tmp}/gold", GOLD_REVENUE, KEYS, ["no_such_column"], f"{tmp}/target")
    assert spark.read.parquet(f"{tmp}/target").count() == 2


def test_scratch_is_dropped_and_nothing_else(spark, tmp):
    import os
    import pytest
    from lakeweave.session import drop_scratch, scratch
    path = scratch(spark, "t")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    with pytest.raises(ValueError):
        drop_scratch(spark, tmp)


def test_cluster_without_shared_folder_is_refused():
    import pytest
    from lakeweave import session

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Ctx:
        applicationId = "app-cluster-unset"

        def getCheckpointDir(self):
            return None

    class Spark:
        conf, sparkContext = Conf(), Ctx()

    with pytest.raises(RuntimeError):
        session.shared_root(Spark())
