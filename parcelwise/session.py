"""Session helpers: building a session for tests/bench and finding shared storage.

Library functions never build a session; they take the caller's. Scratch
output (landed tables, stream checkpoints, cut lineage) always goes under the
cluster's shared ``spark.checkpoint.dir``; a directory of our own is set only
when the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "parcelwise") -> SparkSession:
    """Session for tests and the bench; a cluster job receives its session instead.

    Listing parallelism is sized to the cores (Spark's default of 10,000 runs
    one task per partition folder, which a day-partitioned table with years
    of history turns into thousands of tiny tasks).
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(max(8, 4 * shuffle_partitions)))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server's setting is the only one
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on this session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or object storage)")
        configured = tempfile.mkdtemp(prefix="parcelwise-ckpt-")  # local runs only (tests)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/parcelwise/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def session_settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs and queries started inside; restored afterwards."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tidy_shuffles(spark: SparkSession):
    """Jobs started inside give back their shuffle files when they end, not when the driver next collects garbage."""
    return session_settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def _hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects, whatever store the path names."""
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when a file or folder exists at ``path``; asks for that one path and lists nothing."""
    fs, hpath = _hadoop_path(spark, path)
    return fs.exists(hpath)


def write_finished(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a write that Spark has committed (its ``_SUCCESS`` file)."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that a job of ours has made."""
    fs, hpath = _hadoop_path(spark, path)
    fs.delete(hpath, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    fs, hpath = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder, with those above it; one that is there stays."""
    fs, hpath = _hadoop_path(spark, path)
    fs.mkdirs(hpath)


def move_into(spark: SparkSession, source: str, target: str) -> None:
    """Move one file or folder; a target that is there already is an error."""
    fs, hpath = _hadoop_path(spark, source)
    if not fs.rename(hpath, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise RuntimeError(f"cannot move {source} to {target}")


def create_exclusively(spark: SparkSession, path: str, line: str) -> bool:
    """Write a one-line file that must not exist yet; False if it does."""
    fs, hpath = _hadoop_path(spark, path)
    fs.mkdirs(hpath.getParent())
    try:
        out = fs.create(hpath, False)
    except Exception as exc:
        if fs.exists(hpath):
            return False
        raise exc
    out.writeBytes(line + "\n")
    out.close()
    return True


def read_line(spark: SparkSession, path: str) -> str:
    """The first line of a small file."""
    fs, hpath = _hadoop_path(spark, path)
    stream = fs.open(hpath)
    try:
        return stream.readLine()
    finally:
        stream.close()
