"""The daily run: validate -> ingest -> transform -> verify -> summary.

Each step is a Spark job over shared storage.
Validation reads only the first records of the source; the source, keyed
and landed row counts are observed during the single landing write (no
separate counting scan), and each KPI output's count is observed in its
own write. The three KPI tables come from a
single scan of the landed table (only the columns they use) and a single
grouping-sets aggregation.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise import schema as S
from parcelwise.functions import missing_to_null
from parcelwise.operators import clean as C
from parcelwise.operators import ingest as G
from parcelwise.operators import kpis as A
from parcelwise.operators import reports as R
from parcelwise.plans import quality as Q
from parcelwise.session import ensure_checkpoint_dir
from parcelwise.sinks.ddl import ensure_database, ensure_kpi_tables
from parcelwise.sinks.writers import conform_kpis, land_partitioned, publish_table, write_output
from parcelwise.sources.readers import read_landed, read_source_csv

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("pipeline", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("source_rows", T.LongType()),
    T.StructField("landed_rows", T.LongType()),
    T.StructField("kpi_outputs", T.LongType()),
    T.StructField("status", T.StringType()),
])


@dataclass
class RunResult:
    run_date: dt.date
    source_path: str
    landed_path: str
    outputs: dict[str, str]
    source_rows: int = 0
    valid_rows: int = 0
    landed_rows: int = 0
    clean_rows: int = 0
    clean_columns: int = 0
    output_rows: dict[str, int] = field(default_factory=dict)
    status: str = "RUNNING"
    step_seconds: dict[str, float] = field(default_factory=dict)
    run_log: str = ""
    tables: dict[str, str] = field(default_factory=dict)


def output_paths(base: str) -> dict[str, str]:
    return {name: f"{base.rstrip('/')}/{name}_output.parquet" for name in A.PUBLISHED}


def ingest_step(spark: SparkSession, source_path: str, landed_path: str, run_ts=None,
                date_formats: tuple[str, ...] = (), multi_line: bool = False) -> tuple[int, int, int]:
    """Source CSV -> typed, keyed rows -> partitioned full refresh.

    ``date_formats`` are tried after ISO dates; ``multi_line`` is the reader's.

    Returns (source rows, keyed source rows, rows landed), all observed
    during the landing write itself - the source is read once.
    """
    source_obs = Observation("source")
    text = read_source_csv(spark, source_path, multi_line=multi_line)
    text = text.observe(source_obs, F.count(F.lit(1)).alias("rows"),
                        F.count(missing_to_null(F.col("shipment_id"))).alias("keyed"))
    raw, landed_obs = G.observed(G.ingest(text, run_ts=run_ts, date_formats=date_formats), "landed")
    land_partitioned(raw, landed_path)
    return int(source_obs.get["rows"]), int(source_obs.get["keyed"]), int(landed_obs.get["rows"])


def transform_step(spark: SparkSession, landed_path: str, outputs: dict[str, str]) -> dict[str, int]:
    """Landed rows -> clean -> all KPI aggregates in one scan -> one write per output.

    The grouped result (one row per block, route and category/mode) is cut
    from its lineage with a reliable checkpoint in the shared checkpoint
    folder, so the three output writes read those few rows instead of
    rescanning the landed table, and a lost executor never forces the scan
    to rerun.
    """
    ensure_checkpoint_dir(spark)
    cleaned, clean_obs = G.observed(C.clean(read_landed(spark, landed_path)), "clean")
    rollup = A.kpi_rollup(cleaned).checkpoint(eager=True)
    rows = {"clean": int(clean_obs.get["rows"]), "clean_columns": len(cleaned.columns)}
    for name, df in A.kpis_from_rollup(rollup).items():
        df, obs = G.observed(df, name)
        write_output(df, outputs[name])
        rows[name] = int(obs.get["rows"])
    return rows


def reports_step(spark: SparkSession, landed_path: str, base: str) -> dict[str, int]:
    """All five reports from one scan of the landed table: one grouping-sets
    aggregation, checkpointed (reliable, shared checkpoint folder), then each
    report's finish and write over those few rows. Returns rows per report."""
    ensure_checkpoint_dir(spark)
    rollup = R.report_rollup(read_landed(spark, landed_path)).checkpoint(eager=True)
    rows = {}
    for name, df in R.reports_from_rollup(rollup).items():
        df, obs = G.observed(df, name)
        write_output(df, f"{base.rstrip('/')}/report_{name}.parquet")
        rows[name] = int(obs.get["rows"])
    return rows


def publish_step(spark: SparkSession, outputs: dict[str, str], database: str, base: str, computed_at) -> dict[str, str]:
    """The written KPI outputs into the warehouse tables of ``database`` (created if missing), stamped ``computed_at``."""
    ensure_database(spark, database, f"{base}/{database}.db")
    tables = ensure_kpi_tables(spark, f"{base}/{database}", database)
    for name, table in tables.items():
        publish_table(conform_kpis(spark.read.parquet(outputs[name]), name, computed_at), table)
    return tables


def summary_frame(spark: SparkSession, result: RunResult) -> DataFrame:
    """The run summary as one row (pipeline, run date, rows, outputs, status)."""
    row = (S.PIPELINE_NAME, result.run_date, result.source_rows, result.landed_rows,
           len(result.output_rows), result.status)
    return spark.createDataFrame([row], RUN_LOG_SCHEMA)


def run_pipeline(spark: SparkSession, source_path: str, base: str, run_date: str | dt.date,
                 run_ts=None, run_log: str | None = None, date_formats: tuple[str, ...] = (),
                 multi_line: bool = False, database: str | None = None) -> RunResult:
    """Run the steps; a failed check raises and stops the run.

    With ``database`` the checked KPI outputs are also published to its
    warehouse tables.
    """
    if isinstance(run_date, str):
        run_date = dt.date.fromisoformat(run_date)
    base = base.rstrip("/")
    result = RunResult(run_date, source_path, f"{base}/{S.RAW_TABLE}", output_paths(base))
    clock = time.perf_counter()

    def lap(step: str) -> None:
        nonlocal clock
        now = time.perf_counter()
        result.step_seconds[step] = round(now - clock, 3)
        clock = now

    Q.require_rows(spark, source_path, multi_line)
    lap("validate")
    result.source_rows, result.valid_rows, result.landed_rows = ingest_step(
        spark, source_path, result.landed_path, run_ts, date_formats, multi_line)
    lap("ingest")
    output_rows = transform_step(spark, result.landed_path, result.outputs)
    result.clean_rows, result.clean_columns = output_rows.pop("clean"), output_rows.pop("clean_columns")
    result.output_rows = output_rows
    lap("transform")
    Q.require_non_empty(Q.output_counts(spark, result.outputs))
    lap("verify")
    if database:
        stamp = G.run_timestamp(run_ts)
        result.tables = publish_step(spark, result.outputs, database, base, stamp)
        lap("publish")
    result.status = "SUCCESS"
    result.run_log = run_log or f"{base}/run_log"
    summary_frame(spark, result).write.mode("append").parquet(result.run_log)
    lap("notify")
    return result
