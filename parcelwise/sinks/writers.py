"""Sinks: KPI outputs, raw landing, partitioned full refresh, catalog publish, append.

Scale notes
- The partitioned landing does not ``repartition('shipment_date')``: that
  sends each date to one task, so a date holding a third of all rows would
  be written by a single task. It asks for a *rebalance* on the date
  instead (AQE keeps rows of a date together where it can and splits
  oversized partitions), then sorts within partitions by date and block,
  which gives few files per date and block-clustered row groups (min/max
  skipping for block filters).
- Output files are capped by ``maxRecordsPerFile`` so a hot date never
  produces one giant file.
- Writes are plain overwrite/append jobs; a lost executor's tasks are
  re-run by Spark and the commit protocol keeps the output whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise import schema as S

MAX_RECORDS_PER_FILE = 5_000_000


def write_output(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """KPI output: full overwrite of ``path``."""
    df.write.mode("overwrite").format(fmt).save(path)


def land_raw(df: DataFrame, path: str) -> None:
    """Raw landing as one unpartitioned Parquet table (full overwrite)."""
    df.write.mode("overwrite").parquet(path)


def land_partitioned(df: DataFrame, path: str, dynamic: bool = False,
                     partition_col: str = "shipment_date", cluster_col: str = "warehouse_block") -> None:
    """Full refresh (or, with ``dynamic``, replace only the dates present) of a
    date-partitioned, block-clustered Parquet table.

    A NULL date lands in the default partition and reads back as NULL.
    The overwrite mode is a per-write option, so the session is not touched.
    """
    (df.hint("rebalance", partition_col)
       .sortWithinPartitions(partition_col, cluster_col)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy(partition_col)
       .parquet(path))


def table_location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]


def land_partitioned_table(df: DataFrame, table: str, dynamic: bool = False,
                           partition_col: str = "shipment_date", cluster_col: str = "warehouse_block") -> None:
    """The same refresh into a catalog table created by the DDL step.

    Files are written to the table's location with a per-write overwrite
    mode (``insertInto`` would need a setting of the whole session), then the
    catalog takes over the partitions that appeared or went, so readers prune
    partitions from the catalog instead of listing every folder.
    """
    spark = df.sparkSession
    columns = [f for f in spark.table(table).schema.fields]
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns])
    land_partitioned(typed, table_location(spark, table), dynamic, partition_col, cluster_col)
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def conform_kpis(df: DataFrame, table: str, computed_at) -> DataFrame:
    """Order and type a KPI frame as its DDL declares, adding ``computed_at``."""
    schema = S.KPI_SCHEMAS[table]
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    stamp = computed_at if not isinstance(computed_at, str) else F.lit(computed_at).cast("timestamp")
    return df.select(*cols, stamp.alias("computed_at"))


def publish_table(df: DataFrame, table: str, fmt: str | None = None, **options: str) -> None:
    """Overwrite a warehouse table's rows.

    With no ``fmt`` the table is a catalog table created by the DDL step and
    rows are inserted by position (its declared schema is kept); with a
    connector format name the frame is saved through that connector.
    """
    if fmt is None:
        df.write.insertInto(table, overwrite=True)
    else:
        df.write.format(fmt).option("table", table).options(**options).mode("overwrite").save()


def append_table(df: DataFrame, table: str, fmt: str, **options: str) -> None:
    """Add rows to a table through a connector."""
    df.write.format(fmt).option("table", table).options(**options).mode("append").save()


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row; NULL is an empty field, and spaces, quotes, commas and line breaks survive."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
