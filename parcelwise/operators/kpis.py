"""KPI aggregations over clean (and, for the strict variants, typed source) rows.

There is one table of measures and one table of KPI specifications. A KPI is
"measures per group, then a finish that names, rounds and ranks them". The
daily job computes the measures of all three published KPIs in one scan by
grouping sets; a single KPI computes them for its own keys. Both go through
the same finish, so there is no second implementation.

Every aggregation is partial per input task and final after one exchange on
the group keys, so a block or route with a third of all rows crosses the
shuffle as one row per task. Windows run on aggregated rows only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise import schema as S
from parcelwise.functions import miss_pct, month_start, pct, risk_band, strict_delay_days

# measure -> (aggregate, input column)
MEASURES = {
    "n": (F.count, "shipment_id"),
    "on_time": (F.avg, "on_time_delivery"),
    "delay": (F.avg, "delay_days"),
    "rating": (F.avg, "customer_rating"),
    "cost": (F.avg, "cost_of_product"),
    "discount": (F.avg, "discount_offered"),
    "revenue": (F.sum, "cost_of_product"),
    "high_value": (F.sum, "is_high_value"),
}


def _two_places(measure: str) -> Column:
    return F.round(measure, 2)


def _on_time_pct(measure: str) -> Column:
    return pct(F.col(measure))


def _late_pct(measure: str) -> Column:
    return miss_pct(F.col(measure))


def _whole(measure: str) -> Column:
    return F.col(measure).cast("bigint")


@dataclass(frozen=True)
class Kpi:
    """Group keys and, per output column, the measure it shows and how."""

    keys: tuple[str, ...]
    shows: dict[str, tuple[str, object]]

    def without(self, *columns: str) -> Kpi:
        return Kpi(self.keys, {k: v for k, v in self.shows.items() if k not in columns})


_CATEGORY_SHOWS = {
    "shipment_count": ("n", _whole),
    "on_time_pct": ("on_time", _on_time_pct),
    "avg_rating": ("rating", _two_places),
    "avg_discount": ("discount", _two_places),
    "total_revenue": ("revenue", _two_places),
}
WAREHOUSE = Kpi(("warehouse_block",), {
    "total_shipments": ("n", _whole),
    "on_time_delivery_pct": ("on_time", _on_time_pct),
    "avg_delay_days": ("delay", _two_places),
    "avg_customer_rating": ("rating", _two_places),
    "avg_product_cost": ("cost", _two_places),
    "high_value_shipments": ("high_value", _whole),
})
ROUTE = Kpi(("route",), {
    "total_shipments": ("n", _whole),
    "delay_rate_pct": ("on_time", _late_pct),
    "avg_delay_days": ("delay", _two_places),
})
CATEGORY = Kpi(("product_category", "mode_of_shipment"), _CATEGORY_SHOWS)
CATEGORY_MONTH = Kpi(("shipment_month", "product_category", "mode_of_shipment"), _CATEGORY_SHOWS)


def _measured(grouped, kpi: Kpi, *more: Column) -> DataFrame:
    names = dict.fromkeys(measure for measure, _ in kpi.shows.values())
    return grouped.agg(*more, *[MEASURES[m][0](MEASURES[m][1]).alias(m) for m in names])


def finished(measures: DataFrame, kpi: Kpi) -> DataFrame:
    return measures.select(*kpi.keys, *[show(measure).alias(column) for column, (measure, show) in kpi.shows.items()])


def _kpi(rows: DataFrame, kpi: Kpi) -> DataFrame:
    return finished(_measured(rows.groupBy(*kpi.keys), kpi), kpi)


def _ranked(warehouses: DataFrame) -> DataFrame:
    """Rank blocks by the rounded on-time percentage, best first; ties share a rank, gaps follow."""
    best_first = Window.orderBy(F.desc("on_time_delivery_pct"))
    return warehouses.withColumn("warehouse_rank", F.rank().over(best_first).cast("bigint"))


def _banded(routes: DataFrame) -> DataFrame:
    """Risk band on the rounded delay rate."""
    return routes.withColumn("risk_level", risk_band("delay_rate_pct"))


def warehouse_kpis(clean: DataFrame) -> DataFrame:
    """Per block: volume, on-time %, delay, rating, cost, high-value count, rank."""
    return _ranked(_kpi(clean, WAREHOUSE))


def warehouse_performance(clean: DataFrame) -> DataFrame:
    """Volume against delay per block, with the block's rank."""
    return warehouse_kpis(clean).select("warehouse_block", "total_shipments", "avg_delay_days", "warehouse_rank")


def route_kpis(clean: DataFrame) -> DataFrame:
    """Per route (NULL route is a group): volume, delay rate, delay, risk band."""
    return _banded(_kpi(clean, ROUTE))


def high_risk_routes(route_kpi: DataFrame) -> DataFrame:
    """Routes whose delay rate is strictly above the high-risk threshold."""
    return route_kpi.filter(F.col("delay_rate_pct") > S.HIGH_RISK_ROUTE_PCT)


def category_kpis(clean: DataFrame) -> DataFrame:
    """Per (category, shipping mode): volume, on-time %, rating, discount, revenue."""
    return _kpi(clean, CATEGORY)


def category_kpis_monthly(clean: DataFrame) -> DataFrame:
    """Category KPIs per calendar month of the shipment date."""
    return _kpi(clean.withColumn("shipment_month", month_start("shipment_date")), CATEGORY_MONTH)


def _strict(typed: DataFrame, key: str) -> DataFrame:
    """Rows with a key, unknown delays NULL (and so skipped by the averages)."""
    return typed.where(F.col(key).isNotNull()).withColumn("delay_days", strict_delay_days())


def warehouse_kpis_strict(typed: DataFrame) -> DataFrame:
    """Null-skipping warehouse KPIs over typed source rows (64-bit cost); no high-value count, no rank."""
    return _kpi(_strict(typed, "warehouse_block"), WAREHOUSE.without("high_value_shipments"))


def route_kpis_strict(typed: DataFrame) -> DataFrame:
    """Null-skipping route KPIs; no risk band."""
    return _kpi(_strict(typed, "route"), ROUTE)


# published KPI -> (specification, what follows its finish)
PUBLISHED = {
    "warehouse_kpis": (WAREHOUSE, _ranked),
    "route_kpis": (ROUTE, _banded),
    "category_kpis": (CATEGORY, lambda df: df),
}
ROLLUP_KEYS = [k for kpi, _ in PUBLISHED.values() for k in kpi.keys]
_ALL = Kpi(tuple(ROLLUP_KEYS), {f"{name}.{c}": v for name, (kpi, _) in PUBLISHED.items() for c, v in kpi.shows.items()})


def set_id(kpi: Kpi) -> int:
    """Spark's grouping id of a grouping set: a 1 bit for each key that is not grouped, first key highest."""
    return int("".join("0" if k in kpi.keys else "1" for k in ROLLUP_KEYS), 2)


def rollup_sets() -> list[list[str]]:
    """The grouping sets of the published KPIs."""
    return [list(kpi.keys) for kpi, _ in PUBLISHED.values()]


def kpi_rollup(clean: DataFrame) -> DataFrame:
    """The measures of all published KPIs in one scan; ``gid`` tells the grouping sets apart.

    One row per block, route and (category, mode): bounded by the number of
    groups, not by the data volume.
    """
    return _measured(clean.groupingSets(rollup_sets(), *ROLLUP_KEYS), _ALL, F.grouping_id().alias("gid"))


def kpis_from_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    """The published KPI tables from a ``kpi_rollup``."""
    return {name: after(finished(rollup.where(F.col("gid") == set_id(kpi)), kpi)) for name, (kpi, after) in PUBLISHED.items()}
