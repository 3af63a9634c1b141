"""Readers for the shipment source and the landed tables.

Every reader passes an explicit schema, so no read runs an inference job;
schema inference is offered only as the explicit ``read_csv_inferred``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise import schema as S
from parcelwise.session import write_finished


def read_source_csv(spark: SparkSession, path: str | list[str], corrupt_column: str | None = None,
                    multi_line: bool = False) -> DataFrame:
    """A shipments CSV with a header row, every column as text (typed later by ingestion).

    Columns are bound by their header name: their order in the file does not
    matter, missing ones are NULL, others are ignored. A file whose header
    differs from the first file's stops the job instead of shifting columns.
    A quote inside a quoted field is doubled. ``multi_line`` reads quoted line
    breaks as part of the field; it is off by default, as such a file cannot
    be split and is read by one task.

    PERMISSIVE mode: a short or broken line yields NULL fields, never a failed
    job. With ``corrupt_column`` such a line is also kept whole in that column
    (NULL for well-formed lines), for reject reporting.
    """
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", multi_line)
              .option("escape", '"').option("enforceSchema", False))
    found = reader.csv(path).schema  # reads the first header line
    if corrupt_column:
        found = T.StructType(found.fields + [T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    rows = reader.schema(found).csv(path)
    wanted = S.SOURCE_COLUMNS + ([corrupt_column] if corrupt_column else [])
    return rows.select(*[F.col(c) if c in found.names else F.lit(None).cast("string").alias(c) for c in wanted])


def read_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header + inferred types (costs one extra pass; a bad value turns a column to text)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The landed raw table (flat or partitioned by shipment_date) in the declared column order."""
    return spark.read.schema(S.RAW_SCHEMA).parquet(path).select(*S.RAW_SCHEMA.fieldNames())


def load_raw(spark: SparkSession, landed_path: str, csv_path: str, multi_line: bool = False) -> tuple[DataFrame, str]:
    """Prefer the landed Parquet table; fall back to the source CSV.

    A folder counts as landed once its write is committed; an empty or
    unfinished one does not. Returns the frame and which one was used
    ("parquet" or "csv"); the CSV branch returns text columns for ingestion
    to type.
    """
    if write_finished(spark, landed_path):
        return read_landed(spark, landed_path), "parquet"
    return read_source_csv(spark, csv_path, multi_line=multi_line), "csv"


def read_table(spark: SparkSession, name: str, fmt: str | None = None, **options: str) -> DataFrame:
    """A catalog table, or a table through a named connector format (``option('table', ..)``)."""
    if fmt is None:
        return spark.read.table(name)
    return spark.read.format(fmt).option("table", name).options(**options).load()


def read_query(spark: SparkSession, query: str) -> DataFrame:
    """A query read (``SELECT * FROM dataset.table``) through Spark SQL."""
    return spark.sql(query)


def landing_path(prefix: str, ds: str) -> str:
    """Date-addressed landing folder: ``{prefix}/{ds}`` (one folder per run date)."""
    return f"{prefix.rstrip('/')}/{ds}"


def file_folder() -> Column:
    """The name of the folder that holds a row's file, without a regular expression per row."""
    return F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)


def read_landing(spark: SparkSession, prefix: str, ds: str | None = None) -> DataFrame:
    """One run date's drop, or the whole history with the run date as a column ``ds``.

    The whole-history read is one scan over a glob; the date comes from each
    file's folder name, so no per-date loop runs on the driver.
    """
    if ds is not None:
        return read_source_csv(spark, landing_path(prefix, ds)).withColumn("ds", F.lit(ds))
    df = read_source_csv(spark, f"{prefix.rstrip('/')}/*")
    return df.withColumn("ds", file_folder())
