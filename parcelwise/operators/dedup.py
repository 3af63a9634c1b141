"""Deduplication for incremental loads: one row per key, the newest wins within and across loads.

Newest is the greatest ``ingested_at``, then ``shipment_date``, then every
other column as a total tie-break, so the survivor never depends on task
order. It is ``row_number() = 1`` over the key: Spark limits each key to one
row per task before the shuffle (a window group limit), so a key that holds a
third of all rows is not sorted whole inside one task.

An incremental target is a Parquet folder partitioned by a hash bucket of the
key. A load is compared with the target by key, recency and a digest of each
row, narrow columns only. Rows that the target has, or has newer, go no
further; rows of unseen keys become new files of their buckets; only buckets
that hold the older row of a key of the load (or very many files) are
rewritten, with their old and new rows merged. All of it is staged first and then moved in by renames (a
store without renames copies). A run that was cut off while moving is finished
by the next one from what is still staged, so no row is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.session import create_exclusively, delete_path, list_names, make_folder, move_into, path_exists, shared_path

RECENCY = ("ingested_at", "shipment_date")
BUCKET = "key_bucket"
#: A bucket of so many files is rewritten as one by the next load.
MOST_FILES = 64


def newest_first(columns: Sequence[str], key: str, recency: Sequence[str] = RECENCY) -> list[Column]:
    """Sort columns that put a key's newest row first: the recency columns, then all others as a total tie-break."""
    order = [c for c in recency if c in columns]
    order += [c for c in columns if c != key and c not in order]
    return [F.desc_nulls_last(c) for c in order]


def latest_per_key(df: DataFrame, key: str = "shipment_id", recency: Sequence[str] = RECENCY) -> DataFrame:
    """One row per key: the greatest by (recency columns, remaining columns)."""
    newest = Window.partitionBy(key).orderBy(*newest_first(df.columns, key, recency))
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def _apply(spark: SparkSession, staging: str, path: str) -> None:
    """Bring what is staged into the target; can be repeated: what has been moved is no longer staged.

    ``whole`` holds buckets that replace the target's, ``more`` files that join it.
    """
    if not path_exists(spark, path):
        make_folder(spark, path)
    for name in list_names(spark, f"{staging}/whole"):
        if name.startswith(f"{BUCKET}="):
            delete_path(spark, f"{path}/{name}")
            move_into(spark, f"{staging}/whole/{name}", f"{path}/{name}")
    for name in list_names(spark, f"{staging}/more"):
        if name.startswith(f"{BUCKET}="):
            make_folder(spark, f"{path}/{name}")
            for part in list_names(spark, f"{staging}/more/{name}"):
                if part.startswith("part-"):  # names are unique to the job that wrote them
                    move_into(spark, f"{staging}/more/{name}/{part}", f"{path}/{name}/{part}")
    delete_path(spark, staging)
    spark.catalog.refreshByPath(path)


def _digest(columns: Sequence[str]) -> list[Column]:
    """128 bits of a row."""
    nulls = [F.col(c).isNull() for c in columns]  # the hash of a row skips its nulls
    return [F.xxhash64(*columns, *nulls).alias("_d1"), F.xxhash64(F.lit(1), *nulls, *reversed(columns)).alias("_d2")]


def _stage(spark: SparkSession, merged: DataFrame, staging: str, kind: str) -> None:
    merged.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{staging}/{kind}")


def merge_latest(batch: DataFrame, path: str, buckets: int, key: str = "shipment_id", recency: Sequence[str] = RECENCY) -> None:
    """Merge a load into the target at ``path``: unseen keys are added, known keys keep their newest row.

    ``buckets`` (the same for every load of a target) sets how much one task
    rewrites; choose it so that a bucket of the whole target fits a task.
    Loading the same batch again changes nothing.
    """
    spark, path = batch.sparkSession, path.rstrip("/")
    staging = f"{path}__merged"
    if path_exists(spark, f"{staging}/ready"):
        _apply(spark, staging, path)
    delete_path(spark, staging)
    load = latest_per_key(batch, key, recency)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)
    scratch = None
    if not path_exists(spark, path):
        _stage(spark, load.select("*", bucket).repartition(BUCKET), staging, "more")
    else:
        order = [c for c in recency if c in batch.columns]
        held = read_target(spark, path, batch.schema).select(
            F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in order], *_digest(batch.columns))
        mine = load.select("*", *[d.alias(f"_my_d{n}") for n, d in enumerate(_digest(batch.columns), 1)])
        same = (F.col("_d1") == F.col("_my_d1")) & (F.col("_d2") == F.col("_my_d2"))
        older, level = F.lit(False), F.lit(True)
        for c in order:  # a null is older than any value
            ours, theirs = F.col(c), F.col(f"_{c}")
            older = older | (level & F.coalesce(ours < theirs, ours.isNull() & theirs.isNotNull()))
            level = level & ours.eqNullSafe(theirs)
        # a null key has no equi-join: its row is merged
        found = mine.join(held, mine[key] == held["_key"], "left").where(F.col("_key").isNull() | ~(same | older))
        known = (F.col("_key").isNotNull() | F.col(key).isNull()).alias("_known")
        scratch = shared_path(spark, "merge-load")
        found.select(*batch.columns, bucket, known).write.parquet(scratch)  # the load's rows that change the target, computed once
        changes = spark.read.schema(T.StructType(batch.schema.fields + [
            T.StructField(BUCKET, T.IntegerType()), T.StructField("_known", T.BooleanType())])).parquet(scratch)
        touched = [r[0] for r in changes.where("_known").select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
        touched += [n for n in range(buckets) if n not in touched and len(list_names(spark, f"{path}/{BUCKET}={n}")) >= MOST_FILES]
        again = F.col(BUCKET).isin(touched)
        if touched:
            target = read_target(spark, path, batch.schema, with_bucket=True).where(again)
            both = target.unionByName(changes.where(again).drop("_known")).repartition(BUCKET)
            # rows of a bucket are together already, so the window needs no shuffle of its own
            newest = Window.partitionBy(BUCKET, key).orderBy(*newest_first(batch.columns, key, recency))
            _stage(spark, both.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank"), staging, "whole")
        more = changes.where(~again) if touched else changes
        _stage(spark, more.drop("_known").repartition(BUCKET), staging, "more")
    create_exclusively(spark, f"{staging}/ready", "all is staged")
    _apply(spark, staging, path)
    if scratch:
        delete_path(spark, scratch)


def read_target(spark: SparkSession, path: str, schema: T.StructType, with_bucket: bool = False) -> DataFrame:
    """The rows of an incremental target."""
    full = T.StructType(schema.fields + [T.StructField(BUCKET, T.IntegerType())])
    rows = spark.read.schema(full).parquet(path)
    return rows if with_bucket else rows.drop(BUCKET)
