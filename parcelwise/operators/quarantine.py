"""Reject quarantine: every malformed field leaves a trace, and one write parts accepted from rejected rows.

Ingestion turns a malformed number or date into NULL. Here the same typing also
yields a bitmask of the fields that failed (bit i is column i of the source)
and the raw text of those fields. A row is rejected when its key is missing
or, under the strict rule, when any field failed. One job writes all rows,
typed, partitioned by ``status``; source, accepted and rejected rows and the
failures of every field are counted in that write, so nothing is scanned twice.

A missing-value token is missing, not malformed, except in the key. Readers of
the accepted rows prune the rejected folder.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise import schema as S
from parcelwise.functions import missing_to_null
from parcelwise.operators.ingest import run_timestamp, typed_columns
from parcelwise.session import path_exists

KEY = "shipment_id"
ACCEPTED, REJECTED = "accepted", "rejected"
QUARANTINE_SCHEMA = T.StructType([T.StructField(f.name, f.dataType) for f in S.RAW_SCHEMA.fields] + [  # a rejected key is null
    T.StructField("failed_fields", T.LongType()),
    T.StructField("raw_text", T.MapType(T.StringType(), T.StringType())),
    T.StructField("status", T.StringType()),
])


@dataclass(frozen=True)
class Landed:
    """Counts observed in the write; ``failures`` has one entry per source field."""

    source_rows: int
    accepted_rows: int
    rejected_rows: int
    failures: dict[str, int]


def field_bit(name: str) -> int:
    return 1 << S.SOURCE_COLUMNS.index(name)


def failed(text: Column, typed: Column, name: str) -> Column:
    """True where a field's text could not be typed, or the key is missing."""
    if name == KEY:
        return missing_to_null(text).isNull()
    return missing_to_null(text).isNotNull() & typed.isNull()


def classified(text: DataFrame, strict: bool = False, date_formats: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows with ``failed_fields``, ``raw_text`` (the failed fields' texts, null if none) and ``status``."""
    names = S.SOURCE_COLUMNS
    # source and typed columns share names, so both travel in one field each
    both = text.select(F.struct(*[F.col(n) for n in names]).alias("source"), F.struct(*typed_columns(date_formats)).alias("typed"))
    bad = {n: failed(F.col(f"source.{n}"), F.col(f"typed.{n}"), n) for n in names if n == KEY or not isinstance(S.RAW_SCHEMA[n].dataType, T.StringType)}
    mask = sum((F.when(test, F.lit(field_bit(n))).otherwise(F.lit(0)).cast("long") for n, test in bad.items()), F.lit(0).cast("long"))
    entries = F.array_compact(F.array(*[F.when(test, F.struct(F.lit(n).alias("key"), F.col(f"source.{n}").alias("value"))) for n, test in bad.items()]))
    rejected = mask != 0 if strict else mask.bitwiseAND(F.lit(field_bit(KEY))) != 0
    return both.select(
        "typed.*", mask.alias("failed_fields"), F.when(mask != 0, F.map_from_entries(entries)).alias("raw_text"),
        F.when(rejected, F.lit(REJECTED)).otherwise(F.lit(ACCEPTED)).alias("status"))


def land_with_quarantine(text: DataFrame, path: str, run_ts: str | dt.datetime | None = None, strict: bool = False,
                         date_formats: tuple[str, ...] = ()) -> Landed:
    """Write source text to ``path`` as accepted and rejected rows in one job, and return its counts."""
    rows = classified(text, strict, date_formats).withColumn("ingested_at", run_timestamp(run_ts))
    seen = Observation("quarantine")
    has = lambda n: F.col("failed_fields").bitwiseAND(F.lit(field_bit(n))) != 0
    counted = rows.select(*QUARANTINE_SCHEMA.fieldNames()).observe(
        seen, F.count(F.lit(1)).alias("source"), F.count(F.when(F.col("status") == ACCEPTED, 1)).alias("accepted"),
        F.count(F.when(F.col("status") == REJECTED, 1)).alias("rejected"), *[F.count(F.when(has(n), 1)).alias(f"field_{n}") for n in S.SOURCE_COLUMNS])
    counted.write.mode("overwrite").partitionBy("status").parquet(path)
    got = seen.get
    return Landed(got["source"], got["accepted"], got["rejected"], {n: got[f"field_{n}"] for n in S.SOURCE_COLUMNS})


def _read(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"nothing has been landed at {path}")
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(path)


def accepted_rows(spark: SparkSession, path: str) -> DataFrame:
    """The accepted rows as the raw table declares them."""
    return _read(spark, path).where(F.col("status") == ACCEPTED).select(*S.RAW_SCHEMA.fieldNames())


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """One row per failed field: shipment_id, field, raw_text and the row's status."""
    return _read(spark, path).where("failed_fields <> 0").select(KEY, F.explode("raw_text").alias("field", "raw_text"), "status")


def rejected_text(spark: SparkSession, path: str) -> DataFrame:
    """The rejected rows as source text again, to be typed once more under other rules: typed fields as text, failed ones raw."""
    rows = _read(spark, path).where(F.col("status") == REJECTED)
    return rows.select(*[F.coalesce(F.col("raw_text")[n], F.col(n).cast("string")).alias(n) for n in S.SOURCE_COLUMNS])
