"""Sinks, sources and streams: round trips, idempotence, failure handling."""

import pytest
from pyspark.sql import functions as F

from parcelwise import schema as S
from parcelwise.operators import dedup as D
from parcelwise.operators import ingest as G
from parcelwise.operators import kpis as A
from parcelwise.plans import pipeline as P
from parcelwise.plans import quality as Q
from parcelwise.plans import registry as Rg
from parcelwise.session import shared_path
from parcelwise.sinks import ddl as K
from parcelwise.sinks import writers as W
from parcelwise.sources import readers as SR
from parcelwise.streaming import ingest_stream as T2
from parcelwise.streaming import messages as T1


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_partitioned_overwrite_is_idempotent_and_keeps_null_dates(spark, sf_small):
    raw = Rg.raw_shipments(spark, sf_small)
    path = shared_path(spark, "t_landed")
    W.land_partitioned(raw, path)
    W.land_partitioned(raw, path)
    back = SR.read_landed(spark, path)
    assert _same(back, raw)
    assert back.filter(F.col("shipment_date").isNull()).count() == raw.filter(F.col("shipment_date").isNull()).count() > 0


def test_dynamic_overwrite_replaces_only_present_dates(spark, sf_small):
    raw = Rg.raw_shipments(spark, sf_small)
    path = shared_path(spark, "t_dynamic")
    W.land_partitioned(raw, path)
    day = raw.filter("shipment_date = DATE'1995-06-01'")
    W.land_partitioned(day.limit(1), path, dynamic=True)
    back = SR.read_landed(spark, path)
    assert back.filter("shipment_date = DATE'1995-06-01'").count() == 1
    assert back.filter("shipment_date <> DATE'1995-06-01'").count() == raw.filter("shipment_date <> DATE'1995-06-01'").count()


def test_merge_twice_changes_nothing_and_loses_nothing(spark, sf_small):
    raw = Rg.raw_shipments(spark, sf_small)
    target = shared_path(spark, "t_incr")
    for _ in range(2):
        D.merge_latest(raw, target, 8)
    got = D.read_target(spark, target, raw.schema)
    assert got.count() == 4541 and _same(got.select(*raw.columns), D.latest_per_key(raw))


def _rows(spark, *rows):
    return spark.createDataFrame(rows, "shipment_id string, ingested_at string, route string").withColumn(
        "ingested_at", F.col("ingested_at").cast("timestamp"))


def test_merge_keeps_the_newest_row_across_loads(spark):
    target = shared_path(spark, "t_newest")
    first = _rows(spark, ("a", "2024-01-01", "old"), ("b", "2024-01-01", "only"), ("c", "2024-01-03", "newer"))
    D.merge_latest(first, target, 4)
    D.merge_latest(_rows(spark, ("a", "2024-01-02", "new"), ("c", "2024-01-02", "late"), ("d", "2023-01-01", "unseen")), target, 4)
    got = {r.shipment_id: r.route for r in D.read_target(spark, target, first.schema).collect()}
    assert got == {"a": "new", "b": "only", "c": "newer", "d": "unseen"}


def test_merge_finishes_a_load_that_was_cut_off(spark, monkeypatch):
    target = shared_path(spark, "t_cut")
    first, second = _rows(spark, ("a", "2024-01-01", "old")), _rows(spark, ("a", "2024-01-02", "new"), ("b", "2024-01-02", "x"))
    D.merge_latest(first, target, 2)

    def lost(*_):
        raise RuntimeError("driver lost while the buckets were replaced")

    with monkeypatch.context() as m:
        m.setattr(D, "_apply", lost)
        with pytest.raises(RuntimeError):
            D.merge_latest(second, target, 2)
    D.merge_latest(_rows(spark, ("c", "2024-01-03", "y")), target, 2)
    assert {r.shipment_id: r.route for r in D.read_target(spark, target, first.schema).collect()} == {"a": "new", "b": "x", "c": "y"}


def test_latest_per_key_prefers_newest_ingest(spark):
    rows = [("k", "2024-01-01 00:00:00", "old"), ("k", "2024-01-02 00:00:00", "new"), ("j", None, "only")]
    df = spark.createDataFrame(rows, "shipment_id string, ingested_at string, route string").withColumn(
        "ingested_at", F.col("ingested_at").cast("timestamp"))
    got = {r.shipment_id: r.route for r in D.latest_per_key(df).collect()}
    assert got == {"k": "new", "j": "only"}


def test_csv_permissive_bad_line(spark):
    path = shared_path(spark, "t_badcsv")
    spark.createDataFrame([(",".join(S.SOURCE_COLUMNS),), ("s1,c1",), ("s2" + ",x" * 15,)], "value string") \
        .coalesce(1).write.text(path)
    raw = G.ingest(SR.read_source_csv(spark, path), run_ts="2024-01-01 00:00:00")
    got = {r.shipment_id: r for r in raw.collect()}
    assert set(got) == {"s1", "s2"}
    assert got["s1"].route is None and got["s2"].customer_care_calls is None


def test_landing_history_reads_dates_from_folders(spark, sf_small):
    prefix = shared_path(spark, "t_landing")
    text = Rg.source_text(spark, sf_small)
    W.write_csv(text.limit(10), SR.landing_path(prefix, "2024-01-01"))
    W.write_csv(text.limit(20), SR.landing_path(prefix, "2024-01-02"))
    hist = SR.read_landing(spark, prefix)
    assert {r.ds: r.n for r in hist.groupBy("ds").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        "2024-01-01": 10, "2024-01-02": 20}
    assert SR.read_landing(spark, prefix, "2024-01-02").count() == 20


def test_source_preference(spark, sf_small):
    assert Rg.q_source_preference(spark, sf_small).count() == 5902


def test_ddl_is_idempotent_and_publish_overwrites(spark, sf_small):
    base = shared_path(spark, "t_wh")
    K.drop_database(spark, "t_dw")
    K.ensure_database(spark, "t_dw", f"{base}/t_dw.db")
    K.ensure_database(spark, "t_dw", f"{base}/t_dw.db")
    tables = K.ensure_kpi_tables(spark, base, database="t_dw")
    K.ensure_kpi_tables(spark, base, database="t_dw")
    raw_name = K.ensure_raw_table(spark, f"{base}/raw", database="t_dw")
    cols = spark.table(raw_name).columns          # partition column last, as Spark stores it
    assert sorted(cols) == sorted(S.RAW_SCHEMA.fieldNames()) and cols[-1] == "shipment_date"
    kpis = A.route_kpis(Rg.clean_rows(spark, sf_small))
    for _ in range(2):
        W.publish_table(W.conform_kpis(kpis, "route_kpis", "2024-01-01 06:00:00"), tables["route_kpis"])
    pub = spark.table(tables["route_kpis"])
    assert pub.count() == 26
    assert dict(pub.dtypes)["computed_at"] == "timestamp"
    K.drop_database(spark, "t_dw")


def test_two_calls_of_a_query_keep_their_own_tables(spark, sf_small):
    small = Rg.q_table_read_query(spark, sf_small)
    other = Rg.q_table_read_query(spark, sf_small.replace("0.001", "0.01"))
    assert small.agg(F.sum("total_shipments")).first()[0] == 5835
    assert other.agg(F.sum("total_shipments")).first()[0] > 50_000
    for db in [d.name for d in spark.catalog.listDatabases() if d.name.startswith(S.DATASET + "_")]:
        K.drop_database(spark, db)


def test_stream_dedup_drops_no_late_id(spark):
    topic, base = shared_path(spark, "t_topic"), shared_path(spark, "t_stream")
    for row in (("a", "2024-01-05", "r1"), ("b", "2024-01-05", "r2"), ("c", "2024-01-03", "two days late"), ("a", "2024-01-06", "newer")):
        T1.publish(_rows(spark, row), topic)
        out = T2.run_to_completion(spark, topic, f"{base}/sink", f"{base}/ckpt", dedup_buckets=4)
    assert {r.shipment_id: r.route for r in out.collect()} == {"a": "newer", "b": "r2", "c": "two days late"}


def test_stream_restart_resumes_from_checkpoint(spark, sf_small):
    topic = shared_path(spark, "t_topic2")
    raw = Rg.raw_shipments(spark, sf_small)
    T1.publish(raw, topic)
    base = shared_path(spark, "t_stream2")
    first = T2.run_to_completion(spark, topic, f"{base}/sink", f"{base}/ckpt").count()
    again = T2.run_to_completion(spark, topic, f"{base}/sink", f"{base}/ckpt").count()
    assert first == again == 5902


def test_missing_and_empty_sources_fail(spark):
    with pytest.raises(FileNotFoundError):
        Q.source_row_count(spark, shared_path(spark, "nope"))
    empty = shared_path(spark, "t_empty")
    spark.createDataFrame([(",".join(S.SOURCE_COLUMNS),)], "value string").coalesce(1).write.text(empty)
    with pytest.raises(Q.QualityError):
        Q.source_row_count(spark, empty)
    with pytest.raises(Q.QualityError):
        Q.output_counts(spark, {"warehouse_kpis": shared_path(spark, "missing_output")})
    with pytest.raises(Q.QualityError):
        Q.output_counts(spark, {})


HEADER = ",".join(S.SOURCE_COLUMNS)


def _file(spark, name, text):
    path = shared_path(spark, name)
    import os

    os.makedirs(path.replace("file:", ""))
    with open(f"{path.replace('file:', '')}/part.csv", "w", newline="") as f:
        f.write(text)
    return path


def test_csv_binds_columns_by_name(spark):
    path = _file(spark, "t_named", "route,extra,shipment_id,customer_rating,shipment_date\nA->B,?,s1,4.0,01/15/2024\nC->D,?,s2,4.5,2024-01-16\n")
    raw = G.ingest(SR.read_source_csv(spark, path), run_ts="2024-01-01", date_formats=("MM/dd/yyyy",)).orderBy("shipment_id").collect()
    assert [(r.shipment_id, r.route, r.customer_rating, str(r.shipment_date), r.warehouse_block) for r in raw] == [
        ("s1", "A->B", 4, "2024-01-15", None), ("s2", "C->D", None, "2024-01-16", None)]


def test_csv_files_with_other_headers_stop_the_job(spark):
    path = _file(spark, "t_two_headers", "shipment_id,route\ns1,r1\n")
    with open(f"{path.replace('file:', '')}/second.csv", "w") as f:
        f.write("route,shipment_id\nr2,s2\n")
    with pytest.raises(Exception, match="(?i)header"):
        SR.read_source_csv(spark, path).collect()


def test_csv_quotes_commas_and_line_breaks(spark):
    path = _file(spark, "t_quoted", 'shipment_id,route,warehouse_block\ns1,"a ""b"", c",A\ns2,"two\nlines", A \n')
    rows = SR.read_source_csv(spark, path, multi_line=True)
    assert [(r.shipment_id, r.route, r.warehouse_block) for r in rows.orderBy("shipment_id").collect()] == [
        ("s1", 'a "b", c', "A"), ("s2", "two\nlines", " A ")]
    assert Q.source_row_count(spark, path, multi_line=True) == 2
    out = shared_path(spark, "t_quoted_out")
    W.write_csv(rows, out)
    assert _same(SR.read_source_csv(spark, out, multi_line=True), rows)


def test_pipeline_run(spark, sf_small):
    base = shared_path(spark, "t_run")
    source = f"{base}/source/2024-01-01"
    W.write_csv(Rg.source_text(spark, sf_small), source)
    K.drop_database(spark, "t_run_dw")
    result = P.run_pipeline(spark, source, base, "2024-01-01", run_ts="2024-01-01 06:00:00", database="t_run_dw")
    assert result.status == "SUCCESS"
    assert {n: spark.table(t).count() for n, t in result.tables.items()} == result.output_rows
    K.drop_database(spark, "t_run_dw")
    assert (result.source_rows, result.landed_rows) == (6000, 5902)
    assert result.output_rows == {"warehouse_kpis": 5, "route_kpis": 26, "category_kpis": 21}
    log = spark.read.parquet(f"{base}/run_log").collect()
    assert len(log) == 1 and log[0].status == "SUCCESS"
    assert result.valid_rows == 5902
    rescanned = Q.quality_report(spark, source, result.landed_path, result.outputs)
    observed = Q.quality_report(spark, source, result.landed_path, result.outputs,
                                source_counts=(result.source_rows, result.valid_rows))
    assert _same(rescanned, observed)
    report = observed.collect()
    assert all(r.status == "PASS" for r in report) and len(report) == 6


def test_one_pass_rollup_equals_separate_kpis(spark, sf_small):
    cleaned = Rg.clean_rows(spark, sf_small)
    split = A.kpis_from_rollup(A.kpi_rollup(cleaned))
    for name, single in (("warehouse_kpis", A.warehouse_kpis), ("route_kpis", A.route_kpis), ("category_kpis", A.category_kpis)):
        one, sep = split[name], single(cleaned)
        assert one.columns == sep.columns
        assert _same(one, sep), name


def test_empty_source_stops_the_pipeline(spark):
    empty = shared_path(spark, "t_empty_run")
    spark.createDataFrame([(",".join(S.SOURCE_COLUMNS),)], "value string").coalesce(1).write.text(empty)
    with pytest.raises(Q.QualityError):
        P.run_pipeline(spark, empty, shared_path(spark, "t_empty_base"), "2024-01-01")


def test_csv_keeps_malformed_lines_for_rejects(spark):
    path = shared_path(spark, "t_corrupt")
    good = "s9" + "," * 15
    spark.createDataFrame([(",".join(S.SOURCE_COLUMNS),), ("s1,c1",), (good,)], "value string") \
        .coalesce(1).write.text(path)
    df = SR.read_source_csv(spark, path, corrupt_column="_corrupt").cache()
    got = {r.shipment_id: r._corrupt for r in df.collect()}
    df.unpersist()
    assert got == {"s1": "s1,c1", "s9": None}


def test_utc_now_text_format(spark):
    from parcelwise.functions import utc_now_text

    text = spark.range(1).select(utc_now_text().alias("t")).collect()[0].t
    import re
    assert re.fullmatch(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", text)


def test_continuous_stream_picks_up_new_messages(spark, sf_small):
    topic = shared_path(spark, "t_topic_live")
    raw = Rg.raw_shipments(spark, sf_small)
    early, late = raw.filter("shipment_date < DATE'1996-01-01'"), raw.filter("NOT (shipment_date < DATE'1996-01-01')")
    T1.publish(early, topic)
    base = shared_path(spark, "t_stream_live")
    query = T2.start_ingest(spark, topic, f"{base}/sink", f"{base}/ckpt", available_now=False,
                            processing_time="1 second")
    try:
        query.processAllAvailable()
        first = SR.read_landed(spark, f"{base}/sink").count()
        T1.publish(late, topic)                  # messages arriving while the stream runs
        query.processAllAvailable()
    finally:
        query.stop()
    assert first == early.count()
    assert SR.read_landed(spark, f"{base}/sink").count() == early.count() + late.count()


def test_one_pass_reports_equal_single_reports(spark, sf_small):
    from parcelwise.operators import reports as R

    raw = Rg.raw_shipments(spark, sf_small)
    split = R.reports_from_rollup(R.report_rollup(raw))
    singles = {"on_time_by_warehouse": R.on_time_by_warehouse(raw), "high_risk_routes": R.high_risk_routes(raw),
               "rating_distribution": R.rating_distribution(raw), "monthly_volume": R.monthly_volume(raw),
               "rolling_delay": R.rolling_delay(raw)}
    for name, single in singles.items():
        assert split[name].columns == single.columns, name
        assert _same(split[name], single), name


def test_table_dynamic_overwrite_restores_session(spark):
    base = shared_path(spark, "t_tbl_dyn")
    K.drop_database(spark, "t_dyn")
    K.ensure_database(spark, "t_dyn", f"{base}/db")
    table = K.ensure_raw_table(spark, f"{base}/raw", database="t_dyn")
    text = spark.createDataFrame(
        [(f"s{i}", None, None, "A", None, None, None, None, None, None, None, None, None, None, None, d)
         for i, d in enumerate(["2024-01-01", "2024-01-02", "2024-01-03"])], S.SOURCE_TEXT_SCHEMA)
    rows = G.ingest(text, run_ts="2024-01-01 00:00:00")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    W.land_partitioned_table(rows, table)
    W.land_partitioned_table(rows.filter("shipment_date = DATE'2024-01-02'").withColumn("route", F.lit("new")),
                             table, dynamic=True)
    got = {str(r.shipment_date): r.route for r in spark.table(table).collect()}
    assert got == {"2024-01-01": None, "2024-01-02": "new", "2024-01-03": None}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    W.land_partitioned_table(rows.limit(1), table)             # a full refresh forgets the other dates
    assert spark.table(table).count() == 1
    K.drop_database(spark, "t_dyn")


def test_connector_format_paths_run(spark, sf_small):
    """The connector branches (warehouse table publish, message-bus publish) run end to end;
    Spark's built-in noop sink stands in for a connector that is not on this classpath."""
    kpis = A.route_kpis(Rg.clean_rows(spark, sf_small))
    W.publish_table(W.conform_kpis(kpis, "route_kpis", "2024-01-01 06:00:00"), "ecommerce_dw.route_kpis",
                    fmt="noop", temporaryBucket="unused")
    T1.publish(Rg.raw_shipments(spark, sf_small), "shipments-topic", fmt="noop", **{"kafka.bootstrap.servers": "unused"})
    msgs = T1.to_messages(Rg.raw_shipments(spark, sf_small))
    assert msgs.columns == ["key", "value"]
