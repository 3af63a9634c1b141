"""An incremental target with a key index: a load rewrites the files that hold its known keys and no others.

Layout under the target's folder::

    data/load=<load>/gid=<group>/   rows of one version of one file group
    index/load=<load>/              (key, gid) of the keys that this load added
    manifest/load=<load>/           (gid, load, rows, low_key, high_key): the version of every group that counts
    commits/<number>                one line: the load whose manifest is current after this commit

A file group is a bounded range of rows of the load that first brought them,
in the order of the clustering columns, so the rows of one period lie together.
A key stays in its group for good: the index only grows by unseen keys and is
never rewritten. A load looks its keys up in the index (key and group id only;
an equi-join, to which Spark adds its runtime Bloom filter once the index is
large), merges the rows of known keys into the groups they point to, and
writes new versions of those groups together with groups of unseen keys in one
job. Nothing is copied twice, and readers see the old state until the commit.

A commit is a file that is created only if it does not exist, so of two loads
that started from one state the second stops and must be repeated. What a
broken load left behind is named by no commit; ``vacuum`` removes it together
with versions that no longer count.

Rules: the newest row of a key wins (``dedup.latest_per_key``), also against a
later load that brings an older row; loading a batch again changes no row;
rows with a null key are left out; an empty batch commits nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.operators.dedup import RECENCY, latest_per_key, newest_first
from parcelwise.session import create_exclusively, delete_path, list_names, path_exists, read_line, shared_path

ROWS_PER_GROUP = 2_000_000
LOAD, GROUP = "load", "gid"
_PLACE = [T.StructField(LOAD, T.StringType()), T.StructField(GROUP, T.LongType())]
MANIFEST = "gid long, load string, rows long, low_key string, high_key string"
#: Group ids of commit n start at n times this.
GROUPS_PER_LOAD = 1 << 32


class ConcurrentLoad(RuntimeError):
    """Another load has changed the target since this one read it; load again."""


@dataclass(frozen=True)
class LoadResult:
    """What a load did, in counts taken during its own jobs."""

    commit: int
    new_rows: int
    known_rows: int
    groups_added: int
    groups_rewritten: int
    groups_kept: int


def _commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, load) of every commit in order; a file whose line is not written yet is no commit."""
    names = [n for n in list_names(spark, f"{path}/commits") if n.isdigit()]
    lines = [(int(n), read_line(spark, f"{path}/commits/{n}")) for n in names]
    return [(n, line) for n, line in lines if line]


def _current(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The last commit's number and load; (0, None) for a target without one."""
    done = _commits(spark, path)
    return done[-1] if done else (0, None)


def manifest(spark: SparkSession, path: str, commit: int | None = None) -> DataFrame:
    """One row per file group of the target as of a commit (default: the last one)."""
    load = _current(spark, path)[1] if commit is None else read_line(spark, f"{path}/commits/{commit:08d}")
    if load is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest/load={load}")


def _index(spark: SparkSession, path: str, key: str, loads: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField(GROUP, T.LongType())])
    return spark.read.schema(schema).parquet(*[f"{path}/index/load={x}" for x in loads])


def _versions(spark: SparkSession, path: str, schema: T.StructType, groups: DataFrame) -> DataFrame:
    """The rows of the group versions (gid, load) named by ``groups``; other folders are pruned at run time."""
    rows = spark.read.schema(T.StructType(schema.fields + _PLACE)).parquet(f"{path}/data")
    return rows.join(groups.select(LOAD, GROUP), [LOAD, GROUP], "left_semi")


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, commit: int | None = None) -> DataFrame:
    """The rows of the target, now or as of an earlier commit that ``vacuum`` has not cleared."""
    path = path.rstrip("/")
    if _current(spark, path)[1] is None:
        return spark.createDataFrame([], schema)
    return _versions(spark, path, schema, manifest(spark, path, commit)).select(*schema.fieldNames())


def _added(spark: SparkSession, path: str) -> list[str]:
    """The loads that have an index part, one per commit."""
    return [load for _, load in _commits(spark, path)]


def load_keyed(batch: DataFrame, path: str, key: str = "shipment_id", recency: Sequence[str] = RECENCY,
               cluster: Sequence[str] = ("shipment_date",), rows_per_group: int = ROWS_PER_GROUP) -> LoadResult:
    """Merge a load into the target at ``path``; see the module's text."""
    spark, path = batch.sparkSession, path.rstrip("/")
    number, before = _current(spark, path)
    load = f"{number + 1:08d}-{uuid.uuid4().hex[:12]}"
    columns = batch.columns
    scratch = shared_path(spark, "keyed-load")

    # the load's own rows, one per key, with the group that holds the key: written once, read by both branches below
    newest = latest_per_key(batch.where(F.col(key).isNotNull()), key, recency)
    found = newest.join(_index(spark, path, key, _added(spark, path)), key, "left") if before else newest.withColumn(GROUP, F.lit(None).cast("long"))
    seen = Observation("keyed-load")
    found.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(GROUP).alias("known")).write.parquet(scratch)
    rows, known = seen.get["rows"], seen.get["known"]
    if not rows:
        delete_path(spark, scratch)
        return LoadResult(number, 0, 0, 0, 0, manifest(spark, path).count())
    held = spark.read.schema(found.schema).parquet(scratch)

    parts = []
    if rows > known:
        # few rows short of a full group each; the key ends the sort order, so a hot date is cut into several groups
        groups = -(-(rows - known) // rows_per_group)
        fresh = held.where(F.col(GROUP).isNull()).repartitionByRange(groups, *cluster, key).sortWithinPartitions(*cluster, key)
        parts.append(fresh.withColumn(GROUP, F.lit((number + 1) * GROUPS_PER_LOAD) + F.spark_partition_id()))
    if known:
        changes = held.where(F.col(GROUP).isNotNull())
        touched = changes.select(GROUP).distinct()
        old = _versions(spark, path, batch.schema, manifest(spark, path).join(touched, GROUP, "left_semi"))
        both = old.select(*columns, GROUP).unionByName(changes.select(*columns, GROUP)).repartition(GROUP)
        # rows of a group are together already, so the window needs no shuffle of its own
        first = Window.partitionBy(GROUP, key).orderBy(*newest_first(columns, key, recency))
        merged = both.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")
        parts.append(merged.sortWithinPartitions(GROUP, *cluster, key))
    for part in parts:
        (part.select(*columns, GROUP).withColumn(LOAD, F.lit(load)).write.mode("append").partitionBy(LOAD, GROUP).parquet(f"{path}/data"))

    # only what this load wrote is read for the index and the manifest
    written = spark.read.schema(T.StructType(batch.schema.fields + [_PLACE[1]])).parquet(f"{path}/data/load={load}")
    (written.where(F.col(GROUP) >= (number + 1) * GROUPS_PER_LOAD).select(F.col(key).cast("string").alias(key), GROUP)
        .write.parquet(f"{path}/index/load={load}"))
    versions = written.groupBy(GROUP).agg(F.count(F.lit(1)).alias("rows"), F.min(key).cast("string").alias("low_key"),
                                          F.max(key).cast("string").alias("high_key")).withColumn(LOAD, F.lit(load))
    names = ["gid", "load", "rows", "low_key", "high_key"]
    kept = manifest(spark, path)
    counted = Observation("keyed-manifest")
    mine = (F.col(LOAD) == load)
    fresh_ids = F.col(GROUP) >= (number + 1) * GROUPS_PER_LOAD
    (kept.join(versions.select(GROUP), GROUP, "left_anti").select(*names).unionByName(versions.select(*names)).coalesce(1)
        .observe(counted, F.count(F.when(mine & fresh_ids, 1)).alias("added"), F.count(F.when(mine & ~fresh_ids, 1)).alias("rewritten"),
                 F.count(F.when(~mine, 1)).alias("kept"))
        .write.parquet(f"{path}/manifest/load={load}"))
    if not create_exclusively(spark, f"{path}/commits/{number + 1:08d}", load):
        raise ConcurrentLoad(f"{path} has been changed by another load; load again")
    delete_path(spark, scratch)
    done = counted.get
    return LoadResult(number + 1, rows - known, known, done["added"], done["rewritten"], done["kept"])


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove group versions that the last commit does not name, and what broken loads left; returns how many folders went.

    Not to be run beside a load or a reader of an earlier commit.
    """
    path = path.rstrip("/")
    current = {(r[LOAD], r[GROUP]) for r in manifest(spark, path).select(LOAD, GROUP).collect()}  # one row per file group
    committed = set(_added(spark, path))
    gone = 0
    for name in list_names(spark, f"{path}/data"):
        load = name.removeprefix("load=")
        for group in list_names(spark, f"{path}/data/{name}"):
            if group.startswith("gid=") and (load, int(group.removeprefix("gid="))) not in current:
                delete_path(spark, f"{path}/data/{name}/{group}")
                gone += 1
    for part in ("index", "manifest"):
        for name in list_names(spark, f"{path}/{part}"):
            if name.startswith("load=") and name.removeprefix("load=") not in committed:
                delete_path(spark, f"{path}/{part}/{name}")
                gone += 1
    return gone


def target_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/commits")
