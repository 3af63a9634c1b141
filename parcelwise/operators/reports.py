"""The five analytical reports, over the landed raw rows (not the clean ones).

They differ from the KPI jobs on purpose: delay is NULL when either day
count is unknown (so it is skipped by AVG), NULL keys are ordinary groups,
ranking and banding use unrounded averages, and cost stays 64-bit.

Each report is "standard aggregates per group key -> report finish". The
aggregation is a partial + final hash aggregate around one exchange on the
key. Windows then run on aggregated rows only: the report-1 rank over
warehouse blocks, the report-3 share within a category, and the report-5
rolling average over days - one row per calendar day, so a bounded row
count however large the shipments table grows.

``report_rollup`` computes the standard aggregates of all five reports in
one scan and one grouping-sets aggregation; ``reports_from_rollup`` applies
the same finishes to it, so a daily job reads the landed table once for
all five reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise import schema as S
from parcelwise.functions import month_start, risk_band, strict_delay_days

# Group keys of each report, in output order.
KEYS = {
    "on_time_by_warehouse": ["warehouse_block"],
    "high_risk_routes": ["route"],
    "rating_distribution": ["product_category", "customer_rating"],
    "monthly_volume": ["shipment_month", "mode_of_shipment"],
    "rolling_delay": ["shipment_date"],
}


def _inputs(raw: DataFrame) -> DataFrame:
    """The columns the reports aggregate, with the month and the strict delay derived."""
    return raw.select(
        "warehouse_block", "route", "product_category", "customer_rating",
        month_start("shipment_date").alias("shipment_month"), "mode_of_shipment", "shipment_date",
        "shipment_id", "on_time_delivery", strict_delay_days().alias("strict_delay"), "cost_of_product",
    )


def _standard_aggs():
    return (
        F.count("shipment_id").alias("n_id"),
        F.count(F.lit(1)).alias("n_all"),
        F.avg("on_time_delivery").alias("on_time"),
        F.avg("strict_delay").alias("delay"),
        F.sum("cost_of_product").alias("revenue"),
    )


def _aggregate(raw: DataFrame, name: str) -> DataFrame:
    return _inputs(raw).groupBy(*KEYS[name]).agg(*_standard_aggs())


# --- finishes: aggregated rows -> report rows ---------------------------------

def _finish_on_time(agg: DataFrame) -> DataFrame:
    ranking = Window.orderBy(F.desc("on_time"))
    return (agg.select(
                "warehouse_block",
                F.col("n_id").alias("total_shipments"),
                F.round(F.col("on_time") * 100, 2).alias("on_time_pct"),
                F.round("delay", 2).alias("avg_delay_days"),
                F.rank().over(ranking).cast("bigint").alias("warehouse_rank"))
            .orderBy(F.desc("on_time_pct")))


def _finish_high_risk(agg: DataFrame) -> DataFrame:
    rate = (1 - F.col("on_time")) * 100
    return (agg.select(
                "route",
                F.col("n_id").alias("total_shipments"),
                F.round(rate, 2).alias("delay_rate_pct"),
                F.round("delay", 2).alias("avg_delay_days"),
                risk_band(rate).alias("risk_level"))
            .filter(F.col("delay_rate_pct") > S.HIGH_RISK_ROUTE_PCT)
            .orderBy(F.desc("delay_rate_pct")))


def _finish_rating(agg: DataFrame) -> DataFrame:
    in_category = Window.partitionBy("product_category")
    share = F.col("n_all") * F.lit(100.0) / F.sum("n_all").over(in_category)
    return (agg.select("product_category", "customer_rating",
                       F.col("n_all").alias("shipment_count"),
                       F.round(share, 2).alias("pct_of_category"))
            .orderBy("product_category", "customer_rating"))


def _finish_monthly(agg: DataFrame) -> DataFrame:
    return (agg.select("shipment_month", "mode_of_shipment",
                       F.col("n_id").alias("total_shipments"),
                       F.round(F.col("on_time") * 100, 2).alias("on_time_pct"),
                       F.round("revenue", 2).alias("total_revenue"))
            .orderBy("shipment_month", "mode_of_shipment"))


def _finish_rolling(agg: DataFrame, window_rows: int = S.ROLLING_WINDOW_ROWS) -> DataFrame:
    frame = Window.orderBy(F.asc_nulls_first("shipment_date")).rowsBetween(-(window_rows - 1), Window.currentRow)
    return (agg.select(
                "shipment_date",
                F.col("n_id").alias("daily_shipments"),
                F.round("delay", 2).alias("avg_delay"),
                F.round(F.avg("delay").over(frame), 2).alias("rolling_7d_avg_delay"))
            .orderBy(F.asc_nulls_first("shipment_date")))


FINISH = {
    "on_time_by_warehouse": _finish_on_time,
    "high_risk_routes": _finish_high_risk,
    "rating_distribution": _finish_rating,
    "monthly_volume": _finish_monthly,
    "rolling_delay": _finish_rolling,
}


# --- one report at a time ---------------------------------------------------

def report(raw: DataFrame, name: str) -> DataFrame:
    """The report of that name."""
    return FINISH[name](_aggregate(raw, name))


def on_time_by_warehouse(raw: DataFrame) -> DataFrame:
    """Report 1: on-time rate per block, ranked on the unrounded average."""
    return report(raw, "on_time_by_warehouse")


def high_risk_routes(raw: DataFrame) -> DataFrame:
    """Report 2: band on the unrounded rate, keep routes whose rounded rate > 30."""
    return report(raw, "high_risk_routes")


def rating_distribution(raw: DataFrame) -> DataFrame:
    """Report 3: each rating's share of its category's shipments."""
    return report(raw, "rating_distribution")


def monthly_volume(raw: DataFrame) -> DataFrame:
    """Report 4: monthly shipments, on-time % and revenue per shipping mode."""
    return report(raw, "monthly_volume")


def rolling_delay(raw: DataFrame, window_rows: int = S.ROLLING_WINDOW_ROWS) -> DataFrame:
    """Report 5: daily volume and delay, plus the average of the last 7 *present*
    days' averages (a rows frame, not a calendar week; the NULL date sorts first).
    """
    return _finish_rolling(_aggregate(raw, "rolling_delay"), window_rows)


# --- all five from one scan -------------------------------------------------

_ROLLUP_KEYS = ["warehouse_block", "route", "product_category", "customer_rating",
                "shipment_month", "mode_of_shipment", "shipment_date"]


def _gid(keys: list[str]) -> int:
    """grouping_id of a set: bit i (first key = highest bit) is 1 when key i is not grouped."""
    n = len(_ROLLUP_KEYS)
    return sum(1 << (n - 1 - i) for i, k in enumerate(_ROLLUP_KEYS) if k not in keys)


def report_rollup(raw: DataFrame) -> DataFrame:
    """Standard aggregates of all five reports in one scan (GROUPING SETS); ``gid`` tells them apart.

    One row per block, route, (category, rating), (month, mode) and day -
    bounded by the number of groups, not by the data volume.
    """
    sets = [KEYS[name] for name in FINISH]
    return _inputs(raw).groupingSets(sets, *_ROLLUP_KEYS).agg(F.grouping_id().alias("gid"), *_standard_aggs())


def reports_from_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    """Apply each report's finish to its slice of a ``report_rollup``."""
    out = {}
    for name, finish in FINISH.items():
        part = rollup.filter(F.col("gid") == _gid(KEYS[name])).select(
            *KEYS[name], "n_id", "n_all", "on_time", "delay", "revenue")
        out[name] = finish(part)
    return out
