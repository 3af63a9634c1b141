"""Data-quality checks as Spark jobs that return (or assert on) small DataFrames.

All counts are aggregations over the data (Parquet row counts are served
from file footers); the only rows that reach the driver are the per-output
count rows - one per output, a bounded handful.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelwise import schema as S
from parcelwise.functions import missing_to_null
from parcelwise.session import path_exists, write_finished
from parcelwise.sources.readers import read_source_csv


class QualityError(RuntimeError):
    """A pipeline check failed; the run must stop."""


def require_source(spark: SparkSession, path: str) -> None:
    """Q1: the source exists."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"nothing to ingest: {path} does not exist")


def require_rows(spark: SparkSession, path: str, multi_line: bool = False) -> None:
    """Q1 + Q2: the source exists and holds at least one record (reads only the first rows)."""
    require_source(spark, path)
    if read_source_csv(spark, path, multi_line=multi_line).isEmpty():
        raise QualityError(f"no records below the header of {path}")


def source_row_count(spark: SparkSession, path: str, multi_line: bool = False) -> int:
    """Q2 + Q3: count source records, header excluded. A quoted line break belongs to its record
    if ``multi_line`` is set, as in the reader; no record at all stops the run."""
    require_source(spark, path)
    n = read_source_csv(spark, path, multi_line=multi_line).count()
    if n == 0:
        raise QualityError(f"no records below the header of {path}")
    return n


def count_row(df: DataFrame, check: str) -> DataFrame:
    """One row (check_name, observed) counting ``df``."""
    return df.agg(F.count(F.lit(1)).alias("observed")).select(F.lit(check).alias("check_name"), "observed")


def output_counts(spark: SparkSession, outputs: dict[str, str]) -> DataFrame:
    """Q5: one row per output with its row count; reading a missing output fails."""
    if not outputs:
        raise QualityError("the run names no outputs to check")
    missing = [name for name, path in outputs.items() if not write_finished(spark, path)]
    if missing:
        raise QualityError(f"not written, or not to the end: {', '.join(missing)}")
    rows = [count_row(spark.read.parquet(path), f"{name}_rows") for name, path in outputs.items()]
    return reduce(DataFrame.unionByName, rows)


def require_non_empty(counts: DataFrame) -> dict[str, int]:
    """Q6: every counted output must hold rows (``SELECT COUNT(*) .. > 0``)."""
    observed = {r["check_name"]: r["observed"] for r in counts.collect()}
    empty = [k for k, v in observed.items() if not v]
    if empty:
        raise QualityError(f"empty outputs: {empty}")
    return observed


def quality_report(spark: SparkSession, source_path: str, landed_path: str, outputs: dict[str, str],
                   source_counts: tuple[int, int] | None = None) -> DataFrame:
    """All checks of a run as rows: check_name, observed, status (PASS/FAIL).

    Source and landed counts must agree on the keyed rows; every output must
    be non-empty. ``source_counts`` (source rows, keyed rows) are the counts a
    run observed while it landed the source; without them the source is
    counted again. The landed table and the outputs are always counted from
    storage (Parquet row counts), i.e. after the write.
    """
    if source_counts is None:
        source = read_source_csv(spark, source_path)
        key = missing_to_null(F.col("shipment_id"))
        head = [count_row(source, "source_rows"), count_row(source.filter(key.isNotNull()), "valid_rows")]
    else:
        observed = [("source_rows", int(source_counts[0])), ("valid_rows", int(source_counts[1]))]
        head = [spark.createDataFrame(observed, "check_name string, observed bigint")]
    counts = head + [
        count_row(spark.read.schema(S.RAW_SCHEMA).parquet(landed_path), "landed_rows"),
        output_counts(spark, outputs),
    ]
    rows = reduce(DataFrame.unionByName, counts)
    # The landed count must equal the keyed source count; the frame holds one
    # row per check, so this whole-frame window is a handful of rows.
    valid = F.max(F.when(F.col("check_name") == "valid_rows", F.col("observed"))).over(Window.partitionBy())
    ok = F.when(F.col("check_name") == "landed_rows", F.col("observed") == valid).otherwise(F.col("observed") > 0)
    report = rows.withColumn("ok", ok)
    return report.select("check_name", "observed",
                         F.when(F.col("ok"), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))
