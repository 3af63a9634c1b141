"""KPIs from mergeable partial states: one small state per day, renewed only for the days of a load.

A day's state holds, for every group of the published KPIs, the counts and sums
that their averages are made of: one row per block, per route and per
(category, mode), bounded by the number of groups. A load rewrites the days it
names in the landed table, reads those days back (the others are pruned) and
appends their new states under its own number; of a day the state with the
highest number counts. KPIs merge the states of all days and go through the
same finish as a full run (``kpis.kpis_from_rollup``). A correction of an old
day is a load of that day. Rows without a date have a day of their own.
``compact`` drops states that no longer count.

An average of merged states is the sum of the days' sums over the sum of
their counts, as a full scan would have it, up to the order in which doubles
are added; results are rounded to two places.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.functions import month_start
from parcelwise.operators import kpis as A
from parcelwise.operators.clean import clean
from parcelwise.session import delete_path, list_names, write_finished
from parcelwise.sources.readers import read_landed

DAY = "shipment_date"
_NAMES = list(A.MEASURES)
STATE_SCHEMA = T.StructType(
    [T.StructField(k, T.StringType()) for k in A.ROLLUP_KEYS]
    + [T.StructField("gid", T.LongType())]
    + [T.StructField(f"{m}_{part}", kind) for m in _NAMES for part, kind in (("count", T.LongType()), ("sum", T.DoubleType()))]
    + [T.StructField(DAY, T.DateType())])
LOAD = "load"


def day_states(clean_rows: DataFrame) -> DataFrame:
    """The state of every day of ``clean_rows``: one scan, one grouping-sets aggregation with partial sums per task."""
    sets = [[DAY, *keys] for keys in A.rollup_sets()]  # the day comes first and is in every set, so grouping ids are those of the rollup
    parts = []
    for m, (how, column) in A.MEASURES.items():
        total = F.lit(None).cast("double") if how is F.count else F.sum(F.col(column).cast("double"))
        parts += [F.count(column).alias(f"{m}_count"), total.alias(f"{m}_sum")]
    grouped = clean_rows.groupingSets(sets, DAY, *A.ROLLUP_KEYS).agg(F.grouping_id().alias("gid"), *parts)
    return grouped.select(*STATE_SCHEMA.fieldNames())


def touched_days(load: DataFrame) -> list[dt.date | None]:
    """The days that a load names: at most one row per calendar day."""
    return [r[0] for r in load.select(DAY).distinct().collect()]


def on_days(days: list[dt.date | None]) -> Column:
    """A filter on the partition column that keeps these days only."""
    known = sorted(d for d in days if d is not None)
    found = F.col(DAY).isin(known) if known else F.lit(False)
    return found | F.col(DAY).isNull() if None in days else found


def landed_days(spark: SparkSession, landed: str, days: list[dt.date | None]) -> DataFrame:
    """Rows of the landed table for these days; other partitions are pruned."""
    return read_landed(spark, landed).where(on_days(days))


def _loads(spark: SparkSession, states: str) -> list[int]:
    """Numbers of the loads whose states are written to the end."""
    found = [int(n.removeprefix("load=")) for n in list_names(spark, states) if n.startswith("load=")]
    return [n for n in found if write_finished(spark, f"{states}/load={n:08d}")]


def update_states(spark: SparkSession, landed: str, days: list[dt.date | None], states: str) -> int:
    """Append new states of ``days`` from the landed table; may be repeated after a failure. Returns the load's number.

    A day that the landed table no longer has any clean row of gets a state
    without a group, so what it counted before is gone.
    """
    fresh = day_states(clean(landed_days(spark, landed, days)))
    blank = spark.createDataFrame([(d,) for d in days], f"{DAY} date").select(
        *[(F.lit(None).cast(f.dataType) if f.name != DAY else F.col(DAY)).alias(f.name) for f in STATE_SCHEMA.fields])
    number = max(_loads(spark, states), default=0) + 1
    fresh.unionByName(blank).write.mode("overwrite").parquet(f"{states}/load={number:08d}")
    return number


def read_states(spark: SparkSession, states: str) -> DataFrame:
    """The states that count: of every day those of its last load."""
    loads = _loads(spark, states)
    if not loads:
        return spark.createDataFrame([], STATE_SCHEMA)
    schema = T.StructType(STATE_SCHEMA.fields + [T.StructField(LOAD, T.LongType())])
    rows = spark.read.schema(schema).option("basePath", states).parquet(*[f"{states}/load={n:08d}" for n in loads])
    last = rows.groupBy(F.col(DAY).alias("day")).agg(F.max(LOAD).alias("last"))  # one row per day
    return rows.join(last, rows[DAY].eqNullSafe(last["day"]) & (rows[LOAD] == last["last"]), "left_semi").where("gid is not null").drop(LOAD)


def compact(spark: SparkSession, states: str) -> None:
    """Write the states that count as one load and delete the others. Not to be run beside a load."""
    loads = _loads(spark, states)
    if len(loads) > 1:
        read_states(spark, states).coalesce(1).write.parquet(f"{states}/load={loads[-1] + 1:08d}")  # one row per day and group
        for n in loads:
            delete_path(spark, f"{states}/load={n:08d}")


def _merged(states: DataFrame, *keys: str) -> DataFrame:
    """Measures per group as a full scan computes them, from the states of all days."""
    sums = [F.sum(f"{m}_{part}").alias(f"{m}_{part}") for m in _NAMES for part in ("count", "sum")]
    merged = states.groupBy("gid", *keys).agg(*sums)
    measures = []
    for m, (how, _) in A.MEASURES.items():
        count, total = F.col(f"{m}_count"), F.col(f"{m}_sum")
        value = {F.count: count, F.sum: total, F.avg: F.when(count > 0, total / count)}[how]
        measures.append(value.alias(m))
    return merged.select("gid", *keys, *measures)


def kpis_from_states(spark: SparkSession, states: str) -> dict[str, DataFrame]:
    """The published KPI tables from the states of all days."""
    return A.kpis_from_rollup(_merged(read_states(spark, states), *A.ROLLUP_KEYS))


def monthly_from_states(spark: SparkSession, states: str) -> DataFrame:
    """Category KPIs per calendar month from the states of the days."""
    by_month = read_states(spark, states).where(F.col("gid") == A.set_id(A.CATEGORY)).withColumn("shipment_month", month_start(DAY))
    return A.finished(_merged(by_month, *A.CATEGORY_MONTH.keys), A.CATEGORY_MONTH)

