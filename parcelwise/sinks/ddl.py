"""Idempotent DDL: dataset, partitioned raw table, KPI tables.

Every object gets an explicit LOCATION under shared storage, so nothing
lands in a driver-local warehouse folder. The database is always named by the
caller: tables of that name that exist already are kept and written to.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from parcelwise import schema as S


def _q(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(name)}{loc}")


def drop_database(spark: SparkSession, name: str) -> None:
    """Forget a database and its tables (their files stay, as every table has its own location)."""
    spark.sql(f"DROP DATABASE IF EXISTS {_q(name)} CASCADE")


def ensure_raw_table(spark: SparkSession, location: str, database: str, table: str = S.RAW_TABLE) -> str:
    """Raw table partitioned by shipment_date (clustering comes from the writer's sort)."""
    name = f"{database}.{table}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_q(name)} ({S.ddl(S.RAW_SCHEMA)}) "
        f"USING parquet PARTITIONED BY (shipment_date) LOCATION '{location}'"
    )
    return name


def ensure_kpi_tables(spark: SparkSession, base: str, database: str) -> dict[str, str]:
    """KPI tables as their DDL declares them, plus ``computed_at``."""
    names = {}
    for table, schema in S.KPI_SCHEMAS.items():
        full = T.StructType(schema.fields + [T.StructField("computed_at", T.TimestampType())])
        name = f"{database}.{table}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_q(name)} ({S.ddl(full)}) "
            f"USING parquet LOCATION '{base.rstrip('/')}/{table}'"
        )
        names[table] = name
    return names
