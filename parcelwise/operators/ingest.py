"""Ingestion: type the source text, drop rows without a key, stamp the run time.

One narrow projection + filter; no shuffle. Counts are taken in the same
pass as the write through ``Observation`` rather than a second scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise import schema as S
from parcelwise.functions import lenient_cast, lenient_date, missing_to_null, second_precision_now


def typed_columns(date_formats: tuple[str, ...] = ()) -> list[Column]:
    """The source columns conformed to the declared types, as column expressions.

    Missing-value tokens become NULL in every column; malformed numbers and
    dates become NULL instead of failing the job.
    """
    cols = []
    for name, data_type, _ in S.RAW_FIELDS:
        raw = missing_to_null(F.col(name))
        if isinstance(data_type, T.StringType):
            typed = raw
        elif isinstance(data_type, T.DateType):
            typed = lenient_date(raw, date_formats)
        else:
            typed = lenient_cast(raw, data_type)
        cols.append(typed.alias(name))
    return cols


def conform(text: DataFrame, date_formats: tuple[str, ...] = ()) -> DataFrame:
    """Conform source text to the declared source schema (no rows dropped)."""
    return text.select(*typed_columns(date_formats))


def run_timestamp(run_ts: str | dt.datetime | None = None) -> Column:
    """The ingest time of a run: a fixed value when given, else now (seconds)."""
    if run_ts is None:
        return second_precision_now()
    return F.lit(run_ts).cast(T.TimestampType())


def drop_missing_key(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["shipment_id"])


def ingest(text: DataFrame, run_ts: str | dt.datetime | None = None,
           date_formats: tuple[str, ...] = ()) -> DataFrame:
    """Source text -> raw_shipments rows (typed, keyed, stamped)."""
    typed = drop_missing_key(conform(text, date_formats))
    return typed.withColumn("ingested_at", run_timestamp(run_ts))


def ingest_counts(text: DataFrame) -> DataFrame:
    """One row: source rows, rows kept by the key check, rows rejected."""
    key = missing_to_null(F.col("shipment_id"))
    return text.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count(key).alias("valid_rows"),
    ).withColumn("rejected_rows", F.col("source_rows") - F.col("valid_rows"))


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row/column counter that fills when the frame's action runs."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
