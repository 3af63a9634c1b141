"""Plan assertions: pushdown, pruning, partition pruning, no Python in the hot path."""

import pytest

import __spark_entry__ as E
from parcelwise.operators import dedup as D
from parcelwise.plans import registry as Rg
from parcelwise.session import shared_path
from parcelwise.sinks import writers as W
from parcelwise.sources import readers as SR

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode=mode)
    return capsys.readouterr().out


@pytest.mark.parametrize("key", [k for k in sorted(Rg.QUERIES) if not any(
    s in k for s in ("roundtrip", "landing", "overwrite", "table_read", "stream", "json", "quality", "summary",
                     "preference", "incremental", "inferred", "csv_foreign", "daily", "published", "stamp", "clean_counts"))])
def test_no_python_udf_in_plans(spark, sf_small, capsys, key):
    text = plan_text(E.queries()[key](spark, sf_small), capsys, "extended")
    assert not any(node in text for node in PYTHON_NODES), key
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, key


@pytest.fixture(scope="module")
def landed(spark, sf_small):
    path = shared_path(spark, "plan_landed")
    W.land_partitioned(Rg.raw_shipments(spark, sf_small), path)
    return path


def test_partition_pruning_and_pushdown(spark, landed, capsys):
    df = (SR.read_landed(spark, landed)
          .filter("shipment_date >= DATE'1995-01-01' AND shipment_date < DATE'1995-02-01'")
          .filter("warehouse_block = 'A'")
          .select("shipment_id", "on_time_delivery"))
    text = plan_text(df, capsys)
    assert "PartitionFilters: [isnotnull(shipment_date" in text
    assert "PushedFilters: [IsNotNull(warehouse_block), EqualTo(warehouse_block,A)]" in text
    assert "ReadSchema: struct<shipment_id:string,warehouse_block:string,on_time_delivery:bigint>" in text


def test_month_filter_prunes_through_trunc(spark, landed, capsys):
    df = SR.read_landed(spark, landed).filter("trunc(shipment_date, 'MM') = DATE'1995-01-01'")
    assert "PartitionFilters: [(trunc(shipment_date" in plan_text(df, capsys)
    assert df.count() > 0


def test_kpi_is_partial_plus_final_aggregate(spark, sf_small, capsys):
    text = plan_text(Rg.q_route_kpis(spark, sf_small), capsys)
    assert text.count("HashAggregate") >= 2
    assert "PushedFilters" in text


def test_dedup_limits_each_key_before_the_shuffle(spark, sf_small, capsys):
    text = plan_text(D.latest_per_key(Rg.raw_shipments(spark, sf_small)), capsys)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_building_a_query_starts_no_job(spark, sf_small):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job may start here")
    try:
        frames = [Rg.QUERIES[k](spark, sf_small) for k in ("ingest_raw", "warehouse_kpis", "report_rolling_delay", "dedup_latest", "sample_rows")]
    finally:
        started = tracker.getJobIdsForGroup("building")
        spark.sparkContext._jsc.clearJobGroup()
    assert frames and not list(started)


def test_no_repartition_by_number(spark, sf_small, capsys):
    assert "REPARTITION_BY_NUM" not in plan_text(Rg.q_ingest_raw(spark, sf_small), capsys, "extended")


def test_catalog_table_prunes_partitions(spark, sf_small, capsys):
    from parcelwise.sinks import ddl as K

    base = shared_path(spark, "t_catalog_prune")
    K.drop_database(spark, "t_prune")
    K.ensure_database(spark, "t_prune", f"{base}/db")
    table = K.ensure_raw_table(spark, f"{base}/raw", database="t_prune")
    W.land_partitioned_table(Rg.raw_shipments(spark, sf_small), table)
    df = spark.table(table).filter("shipment_date = DATE'1995-06-01'")
    text = plan_text(df, capsys)
    assert "PartitionFilters: [isnotnull(shipment_date" in text
    assert df.count() == Rg.raw_shipments(spark, sf_small).filter("shipment_date = DATE'1995-06-01'").count()
