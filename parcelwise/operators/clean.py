"""Cleaning: key filter, 32-bit narrowing, derived columns.

A single Filter + Project over the raw rows (map-only, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise import schema as S
from parcelwise.functions import (
    delay_days,
    high_value_flag,
    high_value_flag_from_bool,
    lenient_cast,
    strict_delay_days,
    weight_kg,
)


def clean(raw: DataFrame) -> DataFrame:
    """raw_shipments -> clean rows (+ delay_days, weight_kg, is_high_value)."""
    df = raw.dropna(subset=["shipment_id", "warehouse_block"])
    narrowed = []
    for name in df.columns:
        if name in S.CLEAN_INT_COLUMNS:
            narrowed.append(lenient_cast(name, T.IntegerType()).alias(name))
        elif name == S.CLEAN_FLOAT_COLUMN:
            narrowed.append(lenient_cast(name, T.FloatType()).alias(name))
        else:
            narrowed.append(F.col(name))
    df = df.select(*narrowed)
    return df.select(
        "*",
        delay_days().alias("delay_days"),
        weight_kg().alias("weight_kg"),
        high_value_flag().alias("is_high_value"),
    )


def with_strict_delay(raw: DataFrame) -> DataFrame:
    """Raw rows with both delay rules and both high-value forms side by side."""
    return raw.select(
        "shipment_id", "actual_days", "scheduled_days", "cost_of_product",
        delay_days().alias("delay_days"),
        strict_delay_days().alias("strict_delay_days"),
        high_value_flag().alias("is_high_value"),
        high_value_flag_from_bool().alias("is_high_value_flag"),
    )
