"""Layout maintenance of landed tables: compaction of day partitions, clustering on two columns, Bloom filters.

``compact_days`` rewrites only the days that hold more files than their rows
need. ``land_clustered`` writes files that are small rectangles in two columns
at once: each column's values are cut into ranges of about equal rows, the bits
of the two range numbers are interleaved, and rows are range-partitioned and
sorted by that number, so a filter on either column skips most row groups by
their minimum and maximum. Parquet Bloom filters on an id column skip row
groups for a point lookup where ranges cannot. All of it is built-in
expressions; cuts come from one aggregation with a mergeable sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise import schema as S
from parcelwise.session import delete_path, shared_path
from parcelwise.sinks.writers import MAX_RECORDS_PER_FILE

ROWS_PER_FILE = 1_000_000
#: Bits of a column's range number.
BITS = 6
DAY = "shipment_date"


def day_files(spark: SparkSession, path: str, day: str = DAY) -> DataFrame:
    """(day, files, rows) of a date-partitioned table: one aggregation over file names, no column is read."""
    rows = spark.read.schema(S.RAW_SCHEMA).parquet(path).select(day, F.col("_metadata.file_path").alias("file"))
    by_file = rows.groupBy(day, "file").agg(F.count(F.lit(1)).alias("rows"))
    return by_file.groupBy(day).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))


def crowded_days(spark: SparkSession, path: str, rows_per_file: int = ROWS_PER_FILE, day: str = DAY) -> list:
    """Days with more files than their rows fill: at most one row per calendar day."""
    needed = F.ceil(F.col("rows") / F.lit(rows_per_file))
    return [r[0] for r in day_files(spark, path, day).where(F.col("files") > needed).select(day).collect()]


def compact_days(spark: SparkSession, path: str, rows_per_file: int = ROWS_PER_FILE, day: str = DAY, cluster: Sequence[str] = ("warehouse_block",)) -> int:
    """Rewrite the crowded days, each into as few files as its rows need; returns how many days. Other days stay as they are."""
    days = crowded_days(spark, path, rows_per_file, day)
    if not days:
        return 0
    known = [d for d in days if d is not None]
    wanted = F.col(day).isin(known) if known else F.lit(False)
    wanted = wanted | F.col(day).isNull() if None in days else wanted
    rows = spark.read.schema(S.RAW_SCHEMA).parquet(path).where(wanted)
    # a day's rows go to as many tasks as it gets files (or to fewer that cut files, a quarter over the mark so that none is left
    # with a rest); the salt comes from the row, so a repeated task deals alike
    parts = rows.join(day_files(spark, path, day).where(wanted).select(F.col(day).alias("_day"), F.ceil(F.col("rows") / F.lit(rows_per_file)).alias("_files")),
                      F.col(day).eqNullSafe(F.col("_day")))
    dealt = parts.withColumn("_part", F.pmod(F.xxhash64(*S.SOURCE_COLUMNS), F.col("_files"))).repartition(day, "_part")
    (dealt.sortWithinPartitions(day, "_part", *cluster).select(*S.RAW_SCHEMA.fieldNames())
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file + rows_per_file // 4)
       .partitionBy(day).parquet(path))
    return len(days)


def _cuts_and_rows(df: DataFrame, columns: Sequence[str], bits: int) -> tuple[dict[str, list], int]:
    """The cuts of every column and the number of rows, from one scan."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.percentile_approx(_number(df, c), shares, 10_000).alias(f"cuts{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(row[f"cuts{i}"] or [])) for i, c in enumerate(columns)}, row["rows"]


def range_cuts(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Per column the values that cut it into 2^bits ranges of about equal rows, from one scan.

    Text is cut by its first eight bytes as a number, which keeps its order.
    """
    return _cuts_and_rows(df, columns, bits)[0]


def _number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column's values."""
    kind = df.schema[column].dataType.typeName()
    c = F.col(f"`{column}`")
    if kind == "string":
        return F.conv(F.hex(F.rpad(F.substring(F.encode(c, "utf-8"), 1, 7), 7, F.unhex(F.lit("00")))), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    return c.cast("double")


def _by_range(number: Column, cuts: list, values: list[int]) -> Column:
    """``values[n]`` for a number with n cuts below it (0 for null), by halving: one comparison per bit, all in generated code."""
    if not cuts:
        return F.lit(values[0]).cast("long")
    mid = len(cuts) // 2
    return F.when(F.lit(float(cuts[mid])) < number, _by_range(number, cuts[mid + 1:], values[mid + 1:])).otherwise(_by_range(number, cuts[:mid], values[:mid + 1]))


def _spread(n: int, place: int, places: int, bits: int) -> int:
    """The bits of n, moved apart to leave room for those of the other columns; the first column's are highest."""
    return sum(((n >> bit) & 1) << (bit * places + (places - 1 - place)) for bit in range(bits))


def _interleave(numbers: list[Column], cuts: list[list], bits: int) -> Column:
    out = F.lit(0).cast("long")
    for i, (number, values) in enumerate(zip(numbers, cuts, strict=True)):
        out = out + _by_range(number, values, [_spread(n, i, len(numbers), bits) for n in range(len(values) + 1)])
    return out


def interleaved(df: DataFrame, cuts: dict[str, list], bits: int = BITS) -> Column:
    """The range numbers of the columns with their bits in turn, the first column's highest; null comes first."""
    return _interleave([_number(df, c) for c in cuts], list(cuts.values()), bits)


def land_clustered(df: DataFrame, path: str, columns: Sequence[str] = (DAY, "customer_id"), rows_per_file: int = ROWS_PER_FILE,
                   bloom: str | None = "shipment_id", bits: int = BITS) -> int:
    """Write ``df`` as files clustered on both columns at once; returns the number of files asked for.

    The rows are read three times (cuts, the sample of the range partitioning, the files), so they are computed once into a scratch copy.
    """
    spark, scratch = df.sparkSession, shared_path(df.sparkSession, "to-cluster")
    df.write.parquet(scratch)
    df = spark.read.schema(df.schema).parquet(scratch)
    cuts, rows = _cuts_and_rows(df, columns, bits)
    files = max(1, -(-rows // rows_per_file))
    number = "_cluster"
    while any(c.startswith(number) for c in df.columns):
        number += "_"
    # the numbers are columns of their own, so that no comparison works them out again
    numbers = [f"{number}{i}" for i in range(len(columns))]
    numbered = df.withColumns({n: _number(df, c) for n, c in zip(numbers, columns, strict=True)})
    # the columns follow the number, so a range that is hot in both is still cut
    placed = numbered.withColumn(number, _interleave([F.col(n) for n in numbers], [cuts[c] for c in columns], bits)).drop(*numbers)
    placed = placed.repartitionByRange(files, number, *columns).sortWithinPartitions(number, *columns).drop(number)
    writer = placed.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{bloom}", "true").option(f"parquet.bloom.filter.expected.ndv#{bloom}", str(rows_per_file))
    writer.parquet(path)
    delete_path(spark, scratch)
    spark.catalog.refreshByPath(path)
    return files
