"""Named queries over the test tables: each takes (spark, sf_dir) -> DataFrame.

These are the entry points the driver and the bench call. Each builds the
shipment source from the given tables and runs the library operators on it;
queries that exercise sinks write under the shared checkpoint folder and
return the data read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise import schema as S
from parcelwise.operators import clean as C
from parcelwise.operators import dedup as D
from parcelwise.operators import ingest as G
from parcelwise.operators import keyed_table as KT
from parcelwise.operators import kpi_state as KS
from parcelwise.operators import kpis as A
from parcelwise.operators import quarantine as QU
from parcelwise.operators import reports as R
from parcelwise.operators.sample import first_rows
from parcelwise.plans import pipeline as P
from parcelwise.plans import quality as Q
from parcelwise.plans import reconcile as RC
from parcelwise.session import delete_path, list_names, shared_path, tidy_shuffles
from parcelwise.sinks import ddl as K
from parcelwise.sinks import layout as L
from parcelwise.sinks import writers as W
from parcelwise.sources import connector as CN
from parcelwise.sources import history as H
from parcelwise.sources import readers as SR
from parcelwise.sources import type_profile as TP
from parcelwise.sources.fixture import shipments_text
from parcelwise.streaming import bounded_dedup as BD
from parcelwise.streaming import ingest_stream as T2
from parcelwise.streaming import messages as T1
from parcelwise.streaming import publish_stream as PS
from parcelwise.streaming import run_log as RL

# A fixed run time for queries whose output would otherwise depend on the clock.
RUN_DATE = "2024-01-01"
RUN_TS = "2024-01-01 06:00:00"
NEXT_RUN_TS = "2024-01-02 06:00:00"
LATE_TS = "2023-12-30 06:00:00"
THIRD_RUN_TS = "2024-01-03 06:00:00"
DEDUP_CUTOFF = "1997-01-01"

Query = Callable[[SparkSession, str], DataFrame]


def source_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipments_text(spark, sf_dir)


def typed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.conform(source_text(spark, sf_dir))


def raw_shipments(spark: SparkSession, sf_dir: str, run_ts: str | None = RUN_TS) -> DataFrame:
    return G.ingest(source_text(spark, sf_dir), run_ts=run_ts)


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean(raw_shipments(spark, sf_dir))


def _no_run_time(df: DataFrame) -> DataFrame:
    return df.drop("ingested_at")


def q_ingest_raw(spark, sf_dir):
    return _no_run_time(raw_shipments(spark, sf_dir))


def q_ingest_counts(spark, sf_dir):
    return G.ingest_counts(source_text(spark, sf_dir))


def q_clean_shipments(spark, sf_dir):
    return _no_run_time(clean_rows(spark, sf_dir))


def q_strict_delay(spark, sf_dir):
    return C.with_strict_delay(raw_shipments(spark, sf_dir))


def q_warehouse_kpis(spark, sf_dir):
    return A.warehouse_kpis(clean_rows(spark, sf_dir))


def q_warehouse_performance(spark, sf_dir):
    return A.warehouse_performance(clean_rows(spark, sf_dir))


def q_route_kpis(spark, sf_dir):
    return A.route_kpis(clean_rows(spark, sf_dir))


def q_high_risk_routes(spark, sf_dir):
    return A.high_risk_routes(A.route_kpis(clean_rows(spark, sf_dir)))


def q_category_kpis(spark, sf_dir):
    return A.category_kpis(clean_rows(spark, sf_dir))


def q_category_kpis_monthly(spark, sf_dir):
    return A.category_kpis_monthly(clean_rows(spark, sf_dir))


def q_warehouse_kpis_strict(spark, sf_dir):
    return A.warehouse_kpis_strict(typed_source(spark, sf_dir))


def q_route_kpis_strict(spark, sf_dir):
    return A.route_kpis_strict(typed_source(spark, sf_dir))


def q_report_on_time(spark, sf_dir):
    return R.on_time_by_warehouse(raw_shipments(spark, sf_dir))


def q_report_high_risk(spark, sf_dir):
    return R.high_risk_routes(raw_shipments(spark, sf_dir))


def q_report_rating(spark, sf_dir):
    return R.rating_distribution(raw_shipments(spark, sf_dir))


def q_report_monthly(spark, sf_dir):
    return R.monthly_volume(raw_shipments(spark, sf_dir))


def q_report_rolling(spark, sf_dir):
    return R.rolling_delay(raw_shipments(spark, sf_dir))


def q_sample_rows(spark, sf_dir):
    return first_rows(q_ingest_raw(spark, sf_dir), S.SAMPLE_ROWS)


def q_dedup_latest(spark, sf_dir):
    return _no_run_time(D.latest_per_key(raw_shipments(spark, sf_dir)))


# --- sources and sinks: write under shared storage, return the data read back ---

def _land_source_csv(spark, sf_dir, path):
    W.write_csv(source_text(spark, sf_dir), path)
    return path


def q_csv_roundtrip(spark, sf_dir):
    path = _land_source_csv(spark, sf_dir, shared_path(spark, "source_csv"))
    return _no_run_time(G.ingest(SR.read_source_csv(spark, path), run_ts=RUN_TS))


def q_csv_inferred_read(spark, sf_dir):
    path = _land_source_csv(spark, sf_dir, shared_path(spark, "source_csv"))
    inferred = SR.read_csv_inferred(spark, path)
    text = inferred.select(*[F.col(c).cast("string").alias(c) for c in S.SOURCE_COLUMNS])
    return _no_run_time(G.ingest(text, run_ts=RUN_TS))


def q_parquet_roundtrip(spark, sf_dir):
    path = shared_path(spark, "raw_flat")
    W.land_raw(raw_shipments(spark, sf_dir), path)
    return _no_run_time(SR.read_landed(spark, path))


def q_source_preference(spark, sf_dir):
    base = shared_path(spark, "preference")
    csv = _land_source_csv(spark, sf_dir, f"{base}/source_csv")
    landed = f"{base}/landed"
    kinds = [SR.load_raw(spark, landed, csv)[1]]                         # nothing landed yet: the CSV
    W.land_raw(raw_shipments(spark, sf_dir).limit(0), f"{base}/unfinished")
    delete_path(spark, f"{base}/unfinished/_SUCCESS")
    kinds.append(SR.load_raw(spark, f"{base}/unfinished", csv)[1])       # a write that never finished: the CSV
    first, _ = SR.load_raw(spark, landed, csv)
    W.land_raw(G.ingest(first, run_ts=RUN_TS), landed)
    second, kind = SR.load_raw(spark, landed, csv)                       # now the landed Parquet
    if kinds + [kind] != ["csv", "csv", "parquet"]:
        raise RuntimeError(f"unexpected sources: {kinds + [kind]}")
    return _no_run_time(second)


def q_dated_landing(spark, sf_dir, ds: str = RUN_DATE):
    prefix = shared_path(spark, "landing")
    W.write_csv(source_text(spark, sf_dir), SR.landing_path(prefix, ds))
    history = SR.read_landing(spark, prefix)
    return _no_run_time(G.ingest(history.filter(F.col("ds") == ds).drop("ds"), run_ts=RUN_TS))


def _drifting_landing(spark, sf_dir):
    """Three deliveries: as declared; reversed and with an unknown column; without discounts and with the id last."""
    prefix = shared_path(spark, "drifting")
    text = source_text(spark, sf_dir)
    third = F.pmod(F.col("customer_id").cast("bigint"), F.lit(3))
    later = [c for c in S.SOURCE_COLUMNS if c not in ("discount_offered", "shipment_id")]
    W.write_csv(text.where(third == 0), SR.landing_path(prefix, RUN_DATE))
    W.write_csv(text.where(third == 1).select(*reversed(text.columns), F.lit("x, y").alias("unknown_column")), SR.landing_path(prefix, "2024-01-02"))
    W.write_csv(text.where(third == 2).select(*later, "shipment_id"), SR.landing_path(prefix, "2024-01-03"))
    return prefix


def q_drifting_landing(spark, sf_dir):
    history = H.read_history(spark, _drifting_landing(spark, sf_dir))
    return history.select(*G.typed_columns(), "ds").dropna(subset=["shipment_id"])


def q_drifting_landing_range(spark, sf_dir):
    """Only the days from the second on."""
    history = H.read_history(spark, _drifting_landing(spark, sf_dir), since="2024-01-02")
    return history.select(*G.typed_columns(), "ds").dropna(subset=["shipment_id"])


def _malformed_csv(spark, sf_dir):
    path = shared_path(spark, "malformed_csv")
    W.write_csv(_malformed_source(spark, sf_dir), path)
    return SR.read_source_csv(spark, path)


def q_csv_type_profile(spark, sf_dir):
    return TP.type_profile(_malformed_csv(spark, sf_dir))


def q_csv_type_offenders(spark, sf_dir):
    rows = _malformed_csv(spark, sf_dir)
    return TP.type_offenders(rows, TP.type_profile(rows))


def q_csv_foreign(spark, sf_dir):
    """A file as other tools write it: columns in another order, commas, quotes and line breaks
    inside fields, integers as decimals, and US dates."""
    path = shared_path(spark, "foreign_csv")
    text = source_text(spark, sf_dir).withColumns({
        "route": F.concat(F.col("route"), F.lit(', "north"\nline 2 ')),
        "customer_rating": F.concat(F.col("customer_rating"), F.lit(".0")),
        "scheduled_days": F.concat(F.col("scheduled_days"), F.lit(".00")),
        "shipment_date": F.date_format(F.col("shipment_date").try_cast("date"), "MM/dd/yyyy"),
        "unknown_column": F.lit("x, y"),
    })
    W.write_csv(text.select(*reversed(text.columns)), path)
    rows = SR.read_source_csv(spark, path, multi_line=True)
    return _no_run_time(G.ingest(rows, run_ts=RUN_TS, date_formats=("MM/dd/yyyy",)))


def _malformed_source(spark, sf_dir):
    """The source with malformed numbers and dates in some rows, also several in one."""
    text = source_text(spark, sf_dir)
    some = lambda c, tail: F.coalesce(F.col(c).endswith(tail), F.lit(False))
    return text.withColumns({
        "weight_in_gms": F.when(some("customer_id", "17"), F.lit("heavy")).otherwise(F.col("weight_in_gms")),
        "customer_rating": F.when(some("customer_id", "7"), F.concat(F.col("customer_rating"), F.lit(".5"))).otherwise(F.col("customer_rating")),
        "cost_of_product": F.when(some("shipment_id", "3-1"), F.lit("12,50")).otherwise(F.col("cost_of_product")),
        "scheduled_days": F.when(some("customer_id", "4"), F.lit("3.0")).otherwise(F.col("scheduled_days")),
    })


def _quarantined(spark, sf_dir, strict: bool):
    path = shared_path(spark, "quarantine")
    return path, QU.land_with_quarantine(_malformed_source(spark, sf_dir), path, run_ts=RUN_TS, strict=strict)


def q_ingest_rejects(spark, sf_dir):
    return QU.rejects(spark, _quarantined(spark, sf_dir, strict=True)[0])


def q_ingest_accepted(spark, sf_dir):
    return _no_run_time(QU.accepted_rows(spark, _quarantined(spark, sf_dir, strict=True)[0]))


def q_ingest_reject_counts(spark, sf_dir):
    """One row per field: the counts that the landing write observed, lenient rule."""
    counts = _quarantined(spark, sf_dir, strict=False)[1]
    if counts.source_rows != counts.accepted_rows + counts.rejected_rows:
        raise RuntimeError(f"source rows are not accepted and rejected rows: {counts}")
    rows = [(n, v, counts.source_rows, counts.accepted_rows, counts.rejected_rows) for n, v in counts.failures.items()]
    return spark.createDataFrame(rows, "field string, failures long, source_rows long, accepted_rows long, rejected_rows long")


def q_ingest_stamp(spark, sf_dir):
    path = shared_path(spark, "raw_flat")
    W.land_raw(raw_shipments(spark, sf_dir), path)
    stamp = F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at")
    return SR.read_landed(spark, path).select("shipment_id", stamp)


def _own_database(spark) -> tuple[str, str]:
    """A database name and a folder of this call's own, so that calls never share tables."""
    base = shared_path(spark, "warehouse")
    name = f"{S.DATASET}_{base.rsplit('-', 1)[1]}"
    K.ensure_database(spark, name, f"{base}/{name}.db")
    return name, base


def q_partitioned_overwrite(spark, sf_dir):
    """DDL (dataset + partitioned raw table), then the full refresh."""
    database, base = _own_database(spark)
    table = K.ensure_raw_table(spark, f"{base}/{S.RAW_TABLE}", database)
    W.land_partitioned_table(raw_shipments(spark, sf_dir), table)
    return _no_run_time(spark.table(table)).select(*S.SOURCE_COLUMNS)


def q_layout_compacted(spark, sf_dir):
    """A day-partitioned table of which a later load has cut up half a year, compacted to one file a day."""
    path = shared_path(spark, "compacted")
    raw = _landed_once(spark, sf_dir)
    half = F.col("shipment_date").between(F.lit("1995-07-01").cast("date"), F.lit("1995-12-31").cast("date"))
    later = F.coalesce(half & (F.pmod(F.crc32("customer_id"), F.lit(2)) == 1), F.lit(False))
    for part in (raw.where(~later), raw.where(later)):
        part.hint("rebalance", "shipment_date").write.mode("append").partitionBy("shipment_date").parquet(path)
    if not L.compact_days(spark, path) or L.crowded_days(spark, path):
        raise RuntimeError("a day still holds more files than its rows need")
    return _no_run_time(SR.read_landed(spark, path))


def q_layout_clustered(spark, sf_dir):
    path = shared_path(spark, "clustered")
    L.land_clustered(raw_shipments(spark, sf_dir), path, rows_per_file=20_000)
    return _no_run_time(SR.read_landed(spark, path))


def _daily_kpis(spark, sf_dir):
    """The KPI outputs as the daily job's transform step writes them, and its counts."""
    base = shared_path(spark, "daily")
    W.land_raw(raw_shipments(spark, sf_dir), f"{base}/{S.RAW_TABLE}")
    outputs = P.output_paths(base)
    return base, outputs, P.transform_step(spark, f"{base}/{S.RAW_TABLE}", outputs)


def _daily_kpi(name):
    def run(spark, sf_dir):
        return spark.read.parquet(_daily_kpis(spark, sf_dir)[1][name])
    run.__name__ = f"q_daily_{name}"
    return run


def _daily_report(name):
    def run(spark, sf_dir):
        base = shared_path(spark, "daily")
        W.land_raw(raw_shipments(spark, sf_dir), f"{base}/{S.RAW_TABLE}")
        P.reports_step(spark, f"{base}/{S.RAW_TABLE}", base)
        return spark.read.parquet(f"{base}/report_{name}.parquet")
    run.__name__ = f"q_daily_report_{name}"
    return run


def q_clean_counts(spark, sf_dir):
    counts = _daily_kpis(spark, sf_dir)[2]
    return spark.createDataFrame([(counts["clean"], counts["clean_columns"])], "clean_rows bigint, clean_columns bigint")


def _published(name):
    """A KPI table published to the warehouse by DDL and positional insert, read back by name or by query."""
    def run(spark, sf_dir):
        base, outputs, _ = _daily_kpis(spark, sf_dir)
        database = f"{S.DATASET}_{base.rsplit('-', 1)[1]}"
        table = P.publish_step(spark, outputs, database, base, RUN_TS)[name]
        rows = SR.read_query(spark, f"SELECT * FROM {table}") if name == "warehouse_kpis" else SR.read_table(spark, table)
        return rows.withColumn("computed_at", F.date_format("computed_at", "yyyy-MM-dd HH:mm:ss"))
    run.__name__ = f"q_published_{name}"
    return run


def q_table_read_query(spark, sf_dir):
    return _published("warehouse_kpis")(spark, sf_dir).drop("computed_at")


def q_incremental_dedup(spark, sf_dir, cutoff: str = DEDUP_CUTOFF):
    """Two daily loads into a bucketed target: the second brings new keys and newer rows of known ones."""
    path = shared_path(spark, "incremental")
    text = source_text(spark, sf_dir)
    early = F.coalesce(F.col("shipment_date") < F.lit(cutoff).cast("date"), F.lit(False))
    first = G.ingest(text, run_ts=RUN_TS).filter(early)
    second = G.ingest(text, run_ts=NEXT_RUN_TS)
    changed = second.filter(early & F.col("customer_id").endswith("7")).withColumn("route", F.lit("rerouted"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    D.merge_latest(first, path, buckets)                                            # day 1
    D.merge_latest(second.filter(~early).unionByName(changed), path, buckets)       # day 2
    return _no_run_time(D.read_target(spark, path, first.schema)).select(*S.SOURCE_COLUMNS)


def _landed_once(spark, sf_dir):
    """The raw rows from one landed copy, for queries that read them several times: typed once, columns and row groups pruned after that."""
    path = shared_path(spark, "raw_once")
    W.land_raw(raw_shipments(spark, sf_dir), path)
    return SR.read_landed(spark, path)


def _three_loads(spark, sf_dir, cutoff: str = DEDUP_CUTOFF) -> list[DataFrame]:
    """A first load, one of new keys and changed rows, and a third with corrections of one month and rows that come late."""
    first = _landed_once(spark, sf_dir)
    second, third, late = (first.withColumn("ingested_at", G.run_timestamp(ts)) for ts in (NEXT_RUN_TS, THIRD_RUN_TS, LATE_TS))
    early = F.coalesce(F.col("shipment_date") < F.lit(cutoff).cast("date"), F.lit(False))
    changed = second.where(early & F.col("customer_id").endswith("7")).withColumn("route", F.lit("rerouted"))
    month = F.col("shipment_date").between(F.lit("1995-06-01").cast("date"), F.lit("1995-06-30").cast("date"))
    corrected = third.where(month).withColumns({"route": F.lit("corrected"), "shipment_date": F.date_add("shipment_date", 1)})
    stale = late.where(F.col("customer_id").endswith("3")).withColumn("route", F.lit("stale"))
    return [first.where(early), second.where(~early).unionByName(changed), corrected.unionByName(stale)]


def q_incremental_upsert(spark, sf_dir):
    """Three loads into a target with a key index, with late corrections."""
    path = shared_path(spark, "keyed")
    loads = _three_loads(spark, sf_dir)
    for batch in loads:
        KT.load_keyed(batch, path, rows_per_group=50_000)
    return _no_run_time(KT.read_keyed(spark, path, loads[0].schema)).select(*S.SOURCE_COLUMNS)


def _incremental_states(spark, sf_dir) -> str:
    """Day states after three loads of the landed table: up to the cutoff, the rest, and one old month delivered again."""
    base = shared_path(spark, "states")
    landed, states = f"{base}/{S.RAW_TABLE}", f"{base}/kpi_states"
    raw = _landed_once(spark, sf_dir)
    early = F.coalesce(F.col("shipment_date") < F.lit(DEDUP_CUTOFF).cast("date"), F.lit(False))
    month = F.col("shipment_date").between(F.lit("1995-06-01").cast("date"), F.lit("1995-06-30").cast("date"))
    again = raw.where(month & (F.col("customer_rating") >= 2)).withColumns({
        "actual_days": F.col("scheduled_days") + 2, "route": F.lit("corrected")})
    # the month is delivered as a whole: its days without a row in the delivery end
    for load, covered in ((raw.where(early), []), (raw.where(~early), []), (again, KS.touched_days(raw.where(month)))):
        days = KS.touched_days(load)
        gone = [d for d in covered if d not in set(days)]
        W.land_partitioned(load, landed, dynamic=True)
        for day in gone:
            delete_path(spark, f"{landed}/shipment_date={day}")
        spark.catalog.refreshByPath(landed)
        KS.update_states(spark, landed, days + gone, states)
    return states


def _incremental_kpi(name):
    def run(spark, sf_dir):
        return KS.kpis_from_states(spark, _incremental_states(spark, sf_dir))[name]
    run.__name__ = f"q_incremental_{name}"
    return run


def q_incremental_category_kpis_monthly(spark, sf_dir):
    return KS.monthly_from_states(spark, _incremental_states(spark, sf_dir))


# --- messages and streams ---

def _publish(spark, sf_dir):
    topic = shared_path(spark, "topic")
    T1.publish(raw_shipments(spark, sf_dir), topic)
    return topic


def q_json_publish(spark, sf_dir):
    topic = _publish(spark, sf_dir)
    text = T1.decode(spark.read.text(topic))
    return G.conform(text)


def q_stream_publish(spark, sf_dir):
    """The landed table goes out as a stream; the last epoch is run again after a stop before its commit."""
    base = shared_path(spark, "stream_publish")
    landed, topic, checkpoint = f"{base}/landed", f"{base}/topic", f"{base}/_checkpoint"
    W.land_raw(raw_shipments(spark, sf_dir).repartition(8), landed)
    rows = PS.follow_table(spark, landed, max_files_per_trigger=3)
    PS.publish_available(rows, topic, checkpoint)
    last = max(int(n) for n in list_names(spark, f"{checkpoint}/commits") if n.isdigit())
    delete_path(spark, f"{checkpoint}/commits/{last}")
    PS.publish_available(rows, topic, checkpoint)
    return G.conform(T1.decode(spark.read.text(topic)))


def q_stream_ingest(spark, sf_dir):
    topic = _publish(spark, sf_dir)
    base = shared_path(spark, "stream")
    events = T2.run_to_completion(spark, topic, f"{base}/{S.STREAM_TABLE}", f"{base}/_checkpoint")
    return _no_run_time(events)


def _publish_in_parts(spark, df, topic: str, path: str, least: int = 8) -> None:
    """Publish ``df`` in ``least`` files or more: a landed table of as many tasks goes out as it lies, only a smaller one is dealt out."""
    W.land_raw(df, path)
    rows = spark.read.schema(df.schema).parquet(path)
    T1.publish(rows if rows.rdd.getNumPartitions() >= least else rows.repartition(least), topic)


def q_stream_run_summary(spark, sf_dir):
    """The run log of a stream in three batches, added up."""
    topic, base = shared_path(spark, "topic"), shared_path(spark, "stream")
    with tidy_shuffles(spark):
        _publish_in_parts(spark, typed_source(spark, sf_dir), topic, f"{base}/source")
        files = sum(name.startswith("part-") for name in list_names(spark, topic))
        log = RL.ingest_logged(spark, topic, f"{base}/{S.STREAM_TABLE}", f"{base}/_checkpoint", f"{base}/_log", max_files_per_trigger=-(-files // 3))
    return log.groupBy("query").agg(
        F.count("*").alias("batches"), *[F.sum(c).alias(c) for c in ("source_rows", "landed_rows", "undated_rows")],
        F.round(F.sum("total_cost"), 2).alias("total_cost"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def q_stream_ingest_dedup(spark, sf_dir):
    """Messages arrive twice, and those of some customers days late: no id is lost, the newest row of each stays."""
    topic, base = shared_path(spark, "topic"), shared_path(spark, "stream")
    late = F.coalesce(F.col("customer_id").endswith("3"), F.lit(False))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with tidy_shuffles(spark):
        W.land_raw(raw_shipments(spark, sf_dir), f"{base}/raw")  # once for all deliveries
        raw = SR.read_landed(spark, f"{base}/raw")
        for delivery in (raw.filter(~late), raw.filter(late).withColumn("ingested_at", F.lit(LATE_TS).cast("timestamp")), raw.filter(~late)):
            T1.publish(delivery, topic)
            events = T2.run_to_completion(spark, topic, f"{base}/{S.STREAM_TABLE}", f"{base}/_checkpoint", dedup_buckets=buckets)
    return _no_run_time(events).select(*S.SOURCE_COLUMNS)


def q_stream_dedup_bounded(spark, sf_dir):
    """Three deliveries, 20 hours apart in event time, each with repeats of the one before; every id is kept once."""
    topic, base = shared_path(spark, "topic"), shared_path(spark, "stream")
    with tidy_shuffles(spark):
        W.land_raw(D.latest_per_key(raw_shipments(spark, sf_dir)), f"{base}/raw")  # once for all deliveries
    raw = SR.read_landed(spark, f"{base}/raw")
    third = F.pmod(F.crc32("customer_id"), F.lit(3))
    # event time by delivery: some hours apart, so repeats of the delivery before lie within the watermark
    at = lambda n: F.to_timestamp(F.lit(RUN_TS)) + F.make_dt_interval(hours=F.lit(20 * n))
    deliveries = [raw.where(F.coalesce(third, F.lit(0)) == n).withColumn("ingested_at", at(n)) for n in range(3)]
    with tidy_shuffles(spark):
        for n, delivery in enumerate(deliveries):
            again = deliveries[n - 1] if n else delivery
            T1.publish(delivery.unionByName(again), topic)
            events = BD.ingest_distinct(spark, topic, f"{base}/{S.STREAM_TABLE}", f"{base}/_checkpoint")
    return _no_run_time(events).select(*S.SOURCE_COLUMNS)


# --- the daily run and its checks ---

def _run(spark, sf_dir):
    base = shared_path(spark, "run")
    source = _land_source_csv(spark, sf_dir, f"{base}/source/{RUN_DATE}")
    return P.run_pipeline(spark, source, base, RUN_DATE, run_ts=RUN_TS)


def q_quality_report(spark, sf_dir):
    result = _run(spark, sf_dir)
    return Q.quality_report(spark, result.source_path, result.landed_path, result.outputs,
                            source_counts=(result.source_rows, result.valid_rows))


def q_run_summary(spark, sf_dir):
    result = _run(spark, sf_dir)
    return spark.read.schema(P.RUN_LOG_SCHEMA).parquet(result.run_log)


def q_reconciled_days(spark, sf_dir):
    """Source against landed table, day by day, by counts, amounts and content."""
    path = shared_path(spark, "reconciled")
    source = G.drop_missing_key(typed_source(spark, sf_dir))
    W.land_raw(G.ingest(source_text(spark, sf_dir), run_ts=RUN_TS), path)
    report = RC.reconciled(source, SR.read_landed(spark, path))
    return report.withColumns({c: F.col(c).cast("double") for c in ("source_cost", "landed_cost")})


def q_reconciled_kpis(spark, sf_dir):
    base, outputs, _ = _daily_kpis(spark, sf_dir)
    landed = C.clean(SR.read_landed(spark, f"{base}/{S.RAW_TABLE}"))
    return RC.kpi_totals(landed, {name: spark.read.parquet(path) for name, path in outputs.items()})


def _connected(spark, sf_dir) -> tuple[str, dict[str, str]]:
    """The raw table behind the connector: a first state replaced by the early rows, the later ones appended."""
    fmt, options = CN.register(spark), {"warehouse": shared_path(spark, "connector")}
    raw = raw_shipments(spark, sf_dir)
    early = F.coalesce(F.col("shipment_date") < F.lit(DEDUP_CUTOFF).cast("date"), F.lit(False))
    W.publish_table(raw.where(~early), S.RAW_TABLE, fmt, **options)
    W.publish_table(raw.where(early), S.RAW_TABLE, fmt, **options)
    W.append_table(raw.where(~early), S.RAW_TABLE, fmt, **options)
    return fmt, options


def q_connector_roundtrip(spark, sf_dir):
    fmt, options = _connected(spark, sf_dir)
    return _no_run_time(SR.read_table(spark, S.RAW_TABLE, fmt, **options))


def q_connector_filtered(spark, sf_dir):
    """Shipments of two blocks in one quarter: filters that the connector takes over, and the columns it is asked for."""
    fmt, options = _connected(spark, sf_dir)
    wanted = "shipment_id,warehouse_block,shipment_date,cost_of_product,customer_rating"
    rows = SR.read_table(spark, S.RAW_TABLE, fmt, columns=wanted, **options)
    return rows.where((F.col("shipment_date") >= F.lit("1996-10-01").cast("date")) & (F.col("shipment_date") < F.lit("1997-01-01").cast("date"))
                      & F.col("warehouse_block").isin("A", "B") & (F.col("customer_rating") != 3) & (F.col("cost_of_product") > 1000))


def q_connector_kpis(spark, sf_dir):
    """Warehouse KPIs computed from the connector's table and published through it."""
    fmt, options = _connected(spark, sf_dir)
    kpis = A.warehouse_kpis(C.clean(SR.read_table(spark, S.RAW_TABLE, fmt, **options)))
    W.publish_table(kpis, "warehouse_kpis", fmt, **options)
    return SR.read_table(spark, "warehouse_kpis", fmt, **options)


QUERIES: dict[str, Query] = {
    "connector_roundtrip": q_connector_roundtrip,
    "connector_filtered": q_connector_filtered,
    "connector_kpis": q_connector_kpis,
    "layout_compacted": q_layout_compacted,
    "layout_clustered": q_layout_clustered,
    "reconciled_days": q_reconciled_days,
    "reconciled_kpis": q_reconciled_kpis,
    "ingest_raw": q_ingest_raw,
    "ingest_counts": q_ingest_counts,
    "clean_shipments": q_clean_shipments,
    "strict_delay": q_strict_delay,
    "warehouse_kpis": q_warehouse_kpis,
    "warehouse_performance": q_warehouse_performance,
    "route_kpis": q_route_kpis,
    "high_risk_routes": q_high_risk_routes,
    "category_kpis": q_category_kpis,
    "category_kpis_monthly": q_category_kpis_monthly,
    "warehouse_kpis_strict": q_warehouse_kpis_strict,
    "route_kpis_strict": q_route_kpis_strict,
    "report_on_time_by_warehouse": q_report_on_time,
    "report_high_risk_routes": q_report_high_risk,
    "report_rating_distribution": q_report_rating,
    "report_monthly_volume": q_report_monthly,
    "report_rolling_delay": q_report_rolling,
    "sample_rows": q_sample_rows,
    "dedup_latest": q_dedup_latest,
    "incremental_dedup": q_incremental_dedup,
    "incremental_upsert": q_incremental_upsert,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_inferred_read": q_csv_inferred_read,
    "parquet_roundtrip": q_parquet_roundtrip,
    "source_preference": q_source_preference,
    "dated_landing": q_dated_landing,
    "partitioned_overwrite": q_partitioned_overwrite,
    "table_read_query": q_table_read_query,
    "json_publish": q_json_publish,
    "stream_ingest": q_stream_ingest,
    "stream_ingest_dedup": q_stream_ingest_dedup,
    "stream_dedup_bounded": q_stream_dedup_bounded,
    "quality_report": q_quality_report,
    "run_summary": q_run_summary,
    "csv_foreign": q_csv_foreign,
    "csv_type_profile": q_csv_type_profile,
    "csv_type_offenders": q_csv_type_offenders,
    "drifting_landing": q_drifting_landing,
    "drifting_landing_range": q_drifting_landing_range,
    "stream_publish": q_stream_publish,
    "stream_run_summary": q_stream_run_summary,
    "ingest_stamp": q_ingest_stamp,
    "ingest_rejects": q_ingest_rejects,
    "ingest_accepted": q_ingest_accepted,
    "ingest_reject_counts": q_ingest_reject_counts,
    "clean_counts": q_clean_counts,
    **{f"incremental_{name}": _incremental_kpi(name) for name in A.PUBLISHED},
    "incremental_category_kpis_monthly": q_incremental_category_kpis_monthly,
    **{f"daily_{name}": _daily_kpi(name) for name in A.PUBLISHED},
    **{f"published_{name}": _published(name) for name in A.PUBLISHED},
    **{f"daily_report_{name}": _daily_report(name) for name in R.KEYS},
}
