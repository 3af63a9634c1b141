"""Dated landing folders whose headers drift: columns moved, added or missing from one delivery to the next.

The header lines are read by a Spark job, one task and one row per file, each
task stopping after the first line. Files with the same header line are read
by one scan, bound by header name, and the scans are united by name: a column
that a delivery lacks is NULL there, an unknown one is left out (and reported
by ``header_drift``). There are as many scans as header lines, so the plan
grows with the drift and not with the days. What the driver holds is one short
row per file, as much as its file listing.

An empty file has no header and no rows and is passed over; a folder that is
not a run date between ``since`` and ``until`` (both included) is never
listed. File names must be free of glob characters.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise import schema as S
from parcelwise.session import list_names, session_settings
from parcelwise.sources.readers import file_folder, landing_path, read_source_csv

#: Files are neither split nor packed: a scan with these settings has one partition per file.
FILE_PER_TASK = {"spark.sql.files.maxPartitionBytes": "1t", "spark.sql.files.openCostInBytes": "1t"}
DRIFT_SCHEMA = T.StructType([
    T.StructField("ds", T.StringType()), T.StructField("files", T.LongType()), T.StructField("missing", T.StringType()),
    T.StructField("unknown", T.StringType()), T.StructField("reordered", T.BooleanType()),
])


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _folders(spark: SparkSession, prefix: str, since: str | None, until: str | None) -> list[str]:
    days = [d for d in list_names(spark, prefix) if not d.startswith(("_", "."))]
    return [landing_path(prefix, d) for d in days if (since is None or d >= since) and (until is None or d <= until)]


def file_headers(spark: SparkSession, folders: list[str]) -> list[tuple[str, str]]:
    """(file, header line) of every file that has one."""
    if not folders:
        return []
    lines = spark.read.text(folders).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"))
    with session_settings(spark, FILE_PER_TASK):
        rows = lines.mapInArrow(_first_row, "file string, header string").collect()
    return sorted((unquote(r["file"]), r["header"]) for r in rows)


def _paths(files: list[str], others: set[str]) -> list[str]:
    """The folders of ``files``, or the files themselves where a folder also holds files of another header."""
    by_folder = defaultdict(list)
    for f in files:
        by_folder[f.rsplit("/", 1)[0]].append(f)
    return [p for folder, own in sorted(by_folder.items()) for p in (own if folder in others else [folder])]


def read_history(spark: SparkSession, prefix: str, since: str | None = None, until: str | None = None,
                 multi_line: bool = False) -> DataFrame:
    """All deliveries below ``prefix`` as text columns in declared order, with the run date as ``ds``."""
    groups = defaultdict(list)
    for file, header in file_headers(spark, _folders(spark, prefix, since, until)):
        groups[header].append(file)
    if not groups:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in [*S.SOURCE_COLUMNS, "ds"]]))
    day = file_folder().alias("ds")
    scans = []
    for header, files in sorted(groups.items()):
        mixed = {f.rsplit("/", 1)[0] for h, fs in groups.items() if h != header for f in fs}
        scans.append(read_source_csv(spark, _paths(files, mixed), multi_line=multi_line).select("*", day))
    united = scans[0]
    for scan in scans[1:]:
        united = united.unionByName(scan)
    return united


def header_drift(spark: SparkSession, prefix: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """One row per run date and header: its files, the declared columns that are missing, unknown ones, and whether known ones have moved."""
    seen = defaultdict(int)
    for file, header in file_headers(spark, _folders(spark, prefix, since, until)):
        seen[file.rsplit("/", 2)[1], header] += 1
    rows = []
    for (ds, header), files in sorted(seen.items()):
        names = next(csv.reader([header]), [])
        known = [c for c in names if c in S.SOURCE_COLUMNS]
        rows.append((ds, files, ",".join(c for c in S.SOURCE_COLUMNS if c not in names), ",".join(c for c in names if c not in S.SOURCE_COLUMNS),
                     known != [c for c in S.SOURCE_COLUMNS if c in known]))
    return spark.createDataFrame(rows, DRIFT_SCHEMA)
