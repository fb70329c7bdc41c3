"""Session settings and the shared scratch folder.

Operators never create or stop a session: callers pass theirs in.  This
module only (a) builds a session for tests / local benches and (b)
resolves the shared folder for materialised intermediate layers,
checkpoints and streaming state from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators assume; all are plain public Spark confs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",          # windows and text times in UTC
    "spark.sql.adaptive.enabled": "true",          # AQE: coalesce, skew-join split
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Stateful streaming: RocksDB keeps large key sets off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Upload only the changelog of each micro-batch, not a full state snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "lakeweave", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs.  On a cluster set the same confs
    at submit time and size ``spark.sql.shuffle.partitions`` to the data
    (it is fixed into a stateful query's checkpoint at first start)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# The settings among them that a running session takes; jobs set them first.
RUNTIME_CONF = {k: v for k, v in DEFAULT_CONF.items() if k.startswith("spark.sql.")}


def configure(spark: SparkSession) -> SparkSession:
    """Sets ``RUNTIME_CONF`` on a session that came from elsewhere
    (``spark-submit``), before its first query."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session (it is a core setting, fixed at start-up).  Only
    when it is unset and the master is local (tests, local runs) a folder is
    created once per application and registered with
    ``SparkContext.setCheckpointDir`` so ``DataFrame.checkpoint`` works; on
    a cluster a machine-local folder would lose data, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
            base = None
    if not base:
        try:
            app = spark.sparkContext.applicationId
        except Exception:  # noqa: BLE001
            app = "connect"
        base = _LOCAL_ROOTS.get(app)
        if base is None:
            if not spark.conf.get("spark.master", "local").startswith("local[") and spark.conf.get("spark.master", "local") != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="lakeweave-ckpt-")
            try:
                spark.sparkContext.setCheckpointDir(base)
            except Exception:  # noqa: BLE001
                pass
    return base.rstrip("/")


_scratch: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one run.  Drop it
    with ``drop_scratch``, or all of them with ``clear_scratch``, when
    nothing reads it any more."""
    path = f"{shared_root(spark)}/lakeweave/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Deletes folders below ones that ``scratch`` gave out in this process."""
    for path in paths:
        if not any(path == p or path.startswith(p + "/") for p in _scratch):
            raise ValueError(f"{path!r} is no scratch folder")
        remove(spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes every scratch folder of this process."""
    drop_scratch(spark, *_scratch)
    _scratch.clear()


def _fs_path(spark: SparkSession, path: str):
    """Hadoop FileSystem + Path for ``path``, or None without JVM access
    (e.g. a Spark Connect client)."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p
    except Exception:  # noqa: BLE001 - no classic JVM gateway
        return None


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return path[len("file:"):]
    return path if "://" not in path else None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of ``path`` (works
    for any scheme the cluster has configured)."""
    fsp = _fs_path(spark, path)
    if fsp is None:
        local = _local(path)
        return bool(local) and os.path.exists(local)
    fs, p = fsp
    return bool(fs.exists(p))


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    fsp = _fs_path(spark, path)
    if fsp is None:
        local = _local(path)
        return sorted(os.listdir(local)) if local and os.path.isdir(local) else []
    fs, p = fsp
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create ``path`` (and parents) if absent, so a layer that has not
    received data yet reads as zero rows and a file stream can start."""
    fsp = _fs_path(spark, path)
    if fsp is None:
        local = _local(path)
        if local:
            os.makedirs(local, exist_ok=True)
        return
    fs, p = fsp
    if not fs.exists(p):
        fs.mkdirs(p)


def move(spark: SparkSession, src: str, dst: str) -> None:
    """Renames a folder within one file system (metadata only)."""
    fsp = _fs_path(spark, src)
    if fsp is None:
        os.rename(_local(src) or src, _local(dst) or dst)
        return
    fs, p = fsp
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)):
        raise OSError(f"could not rename {src!r} to {dst!r}")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder this library has written."""
    fsp = _fs_path(spark, path)
    if fsp is not None:
        fsp[0].delete(fsp[1], True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (file-system metadata only)."""
    fsp = _fs_path(spark, path)
    if fsp is None:
        local = _local(path)
        if not local or not os.path.exists(local):
            return 0
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(local) for f in fs)
    fs, p = fsp
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0
