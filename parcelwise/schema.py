"""Declared schemas and the fixed values the KPIs depend on.

Every type here is stated once and reused by readers, ingestion, sinks and
DDL, so no step infers a schema from data (inference costs a full scan and
turns a column with one bad value into a string).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for right results.
# ---------------------------------------------------------------------------
HIGH_VALUE_COST = 2500          # is_high_value: cost strictly above this
RISK_HIGH_PCT = 40              # risk_level HIGH: delay rate strictly above
RISK_MEDIUM_PCT = 20            # risk_level MEDIUM: delay rate strictly above
HIGH_RISK_ROUTE_PCT = 30        # high-risk route filter: delay rate strictly above
ROLLING_WINDOW_ROWS = 7         # rolling delay: current row and 6 preceding rows
SAMPLE_ROWS = 5                 # first-n sample of an output
RISK_LABELS = ("HIGH", "MEDIUM", "LOW")

# Text that the reference's CSV loader (pandas read_csv defaults) treats as a
# missing value; Spark's CSV reader only treats the empty string that way.
# Fixed values, in the order pandas documents them.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Dataset and table names used by the reference's warehouse layout.
DATASET = "ecommerce_dw"
RAW_TABLE = "raw_shipments"
STREAM_TABLE = "realtime_events"
PIPELINE_NAME = "ecommerce_shipment_pipeline"

# ---------------------------------------------------------------------------
# Raw shipments: 16 source columns + ingested_at.
# ---------------------------------------------------------------------------
RAW_FIELDS: list[tuple[str, T.DataType, bool]] = [
    ("shipment_id", T.StringType(), False),
    ("customer_id", T.StringType(), True),
    ("product_category", T.StringType(), True),
    ("warehouse_block", T.StringType(), True),
    ("mode_of_shipment", T.StringType(), True),
    ("route", T.StringType(), True),
    ("customer_care_calls", T.LongType(), True),
    ("customer_rating", T.LongType(), True),
    ("cost_of_product", T.DoubleType(), True),
    ("prior_purchases", T.LongType(), True),
    ("discount_offered", T.DoubleType(), True),
    ("weight_in_gms", T.LongType(), True),
    ("scheduled_days", T.LongType(), True),
    ("actual_days", T.LongType(), True),
    ("on_time_delivery", T.LongType(), True),
    ("shipment_date", T.DateType(), True),
]

SOURCE_COLUMNS = [name for name, _, _ in RAW_FIELDS]

# What a CSV file holds before typing: every column as text.
SOURCE_TEXT_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in SOURCE_COLUMNS])

# The landed raw table (DDL: shipment_id NOT NULL).
RAW_SCHEMA = T.StructType(
    [T.StructField(n, t, nullable) for n, t, nullable in RAW_FIELDS]
    + [T.StructField("ingested_at", T.TimestampType(), True)]
)

# Columns the cleaning step narrows to 32-bit int, and the one it narrows to float.
CLEAN_INT_COLUMNS = (
    "customer_care_calls", "customer_rating", "weight_in_gms",
    "scheduled_days", "actual_days", "on_time_delivery",
)
CLEAN_FLOAT_COLUMN = "cost_of_product"

# Published KPI tables (DDL order and INT64 as bigint), before computed_at.
WAREHOUSE_KPI_SCHEMA = T.StructType([
    T.StructField("warehouse_block", T.StringType()),
    T.StructField("total_shipments", T.LongType()),
    T.StructField("on_time_delivery_pct", T.DoubleType()),
    T.StructField("avg_delay_days", T.DoubleType()),
    T.StructField("avg_customer_rating", T.DoubleType()),
    T.StructField("avg_product_cost", T.DoubleType()),
    T.StructField("high_value_shipments", T.LongType()),
    T.StructField("warehouse_rank", T.LongType()),
])

ROUTE_KPI_SCHEMA = T.StructType([
    T.StructField("route", T.StringType()),
    T.StructField("total_shipments", T.LongType()),
    T.StructField("delay_rate_pct", T.DoubleType()),
    T.StructField("avg_delay_days", T.DoubleType()),
    T.StructField("risk_level", T.StringType()),
])

CATEGORY_KPI_SCHEMA = T.StructType([
    T.StructField("product_category", T.StringType()),
    T.StructField("mode_of_shipment", T.StringType()),
    T.StructField("shipment_count", T.LongType()),
    T.StructField("on_time_pct", T.DoubleType()),
    T.StructField("avg_rating", T.DoubleType()),
    T.StructField("avg_discount", T.DoubleType()),
    T.StructField("total_revenue", T.DoubleType()),
])

KPI_SCHEMAS = {
    "warehouse_kpis": WAREHOUSE_KPI_SCHEMA,
    "route_kpis": ROUTE_KPI_SCHEMA,
    "category_kpis": CATEGORY_KPI_SCHEMA,
}


def ddl(schema: T.StructType) -> str:
    """Column list of a StructType as SQL DDL text (for CREATE TABLE)."""
    cols = []
    for f in schema.fields:
        cols.append(f"{f.name} {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}")
    return ", ".join(cols)
