"""Reconciliation by content: equal counts are not enough, so rows and amounts are compared as well.

A table's rows are summed up in an order-independent checksum, the decimal sum
of a 64-bit hash of every row (a repeated row counts as often as it occurs, so
a swapped value, a lost row and a doubled row all show). Amounts are added as
decimals, exactly and in any order. Both are taken per day in one aggregation
with partial sums per task, and the three sides of a run are compared: the
typed source, the landed table and the KPI outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise import schema as S
from parcelwise.plans.quality import QualityError

DAY = "shipment_date"
AMOUNT = "decimal(38,4)"


def row_hash(columns: list[str]) -> Column:
    """A 64-bit hash of a whole row; which fields are null is part of it (a null field alone would leave the hash as it is)."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return F.xxhash64(nulls, *[F.col(c) for c in columns])


def day_checksums(rows: DataFrame, day: str = DAY, columns: list[str] | None = None) -> DataFrame:
    """Per day: rows, checksum, and the exact total of the cost and weight columns."""
    columns = columns or S.SOURCE_COLUMNS
    return rows.groupBy(day).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(row_hash(columns).cast("decimal(38,0)")).alias("checksum"),
        F.coalesce(F.sum(F.col("cost_of_product").cast("decimal(20,4)")), F.lit(0)).cast(AMOUNT).alias("cost"),
        F.coalesce(F.sum("weight_in_gms"), F.lit(0)).cast("long").alias("grams"))


def reconciled(source: DataFrame, landed: DataFrame, day: str = DAY) -> DataFrame:
    """One row per day of either side: rows, cost and grams of both, and status OK, MISSING, EXTRA, COUNT, AMOUNT or CONTENT.

    ``source`` are the typed rows that should have landed. A day whose counts
    and amounts agree and whose checksum differs holds other rows: CONTENT.
    """
    a, b = (day_checksums(x, day).select(F.col(day).alias(f"{p}_day"), F.lit(True).alias(f"{p}_here"), *[F.col(c).alias(f"{p}_{c}") for c in ("rows", "checksum", "cost", "grams")])
            for p, x in (("source", source), ("landed", landed)))
    both = a.join(b, a["source_day"].eqNullSafe(b["landed_day"]), "full")
    differs = lambda c: F.col(f"source_{c}") != F.col(f"landed_{c}")
    status = (F.when(F.col("landed_here").isNull(), "MISSING").when(F.col("source_here").isNull(), "EXTRA").when(differs("rows"), "COUNT")
              .when(differs("cost") | differs("grams"), "AMOUNT").when(differs("checksum"), "CONTENT").otherwise("OK"))
    return both.select(F.coalesce("source_day", "landed_day").alias(day), *[F.coalesce(f"{p}_{c}", F.lit(0)).alias(f"{p}_{c}") for c in ("rows", "cost", "grams") for p in ("source", "landed")],
                       status.alias("status"))


def kpi_totals(clean: DataFrame, outputs: dict[str, DataFrame]) -> DataFrame:
    """One row per KPI output: the shipments it counts in all groups against those of the clean rows."""
    names = {"warehouse_kpis": "total_shipments", "route_kpis": "total_shipments", "category_kpis": "shipment_count"}
    expected = clean.agg(F.count("shipment_id")).scalar()
    rows = None
    for name, df in outputs.items():
        one = df.agg(F.coalesce(F.sum(names[name]), F.lit(0)).cast("long").alias("observed")).select(F.lit(name).alias("output"), "observed")
        rows = one if rows is None else rows.unionByName(one)
    return rows.select("output", "observed", expected.alias("expected")).select("*", F.when(F.col("observed") == F.col("expected"), "OK").otherwise("COUNT").alias("status"))


def require_reconciled(report: DataFrame) -> None:
    """Stop the run if any day or output differs; the error names the first few."""
    wrong = report.where("status <> 'OK'")
    first = wrong.limit(5).collect()
    if first:
        raise QualityError(f"content differs: {[tuple(r) for r in first]}")
