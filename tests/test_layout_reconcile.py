"""Compaction, two-column clustering with Bloom filters, and reconciliation by content."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import ingest as G
from parcelwise.plans import quality as Q
from parcelwise.plans import reconcile as RC
from parcelwise.plans import registry as Rg
from parcelwise.session import shared_path
from parcelwise.sinks import layout as L
from parcelwise.sinks import writers as W
from parcelwise.sources import readers as SR


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _files(path, pattern="**/*.parquet"):
    return sorted(glob.glob(f"{path.replace('file:', '')}/{pattern}", recursive=True))


@pytest.fixture(scope="module")
def raw(spark, sf_small):
    path = shared_path(spark, "t_layout_raw")
    Rg.raw_shipments(spark, sf_small).where("shipment_date is null or shipment_date between DATE'1995-01-01' and DATE'1995-03-31'").write.parquet(path)
    rows = SR.read_landed(spark, path)
    assert rows.where("shipment_date is not null").count() > 50
    return rows


def test_compaction_rewrites_crowded_days_only(spark, raw):
    path = shared_path(spark, "t_compact")
    W.land_partitioned(raw, path)
    for _ in range(2):                                                              # three days get more files, and the null day
        more = raw.where("shipment_date between DATE'1995-02-03' and DATE'1995-02-05' or shipment_date is null").limit(60)
        more.repartition(3).write.mode("append").partitionBy("shipment_date").parquet(path)
    spark.catalog.refreshByPath(path)
    before, content = set(_files(path)), SR.read_landed(spark, path)
    rows = content.collect()
    crowded = L.crowded_days(spark, path)
    assert crowded and L.compact_days(spark, path) == len(crowded)
    spark.catalog.refreshByPath(path)
    after = set(_files(path))
    assert L.crowded_days(spark, path) == [] and len(after) < len(before)
    touched = {f"shipment_date={d or '__HIVE_DEFAULT_PARTITION__'}" for d in crowded}
    assert {f for f in before if not any(t in f for t in touched)} <= after          # the other days keep their files
    assert all(len([f for f in after if f"/{t}/" in f]) == 1 for t in touched)
    assert sorted(map(str, SR.read_landed(spark, path).collect())) == sorted(map(str, rows))
    assert L.compact_days(spark, path) == 0


def test_a_large_day_gets_the_files_its_rows_need(spark, raw):
    path = shared_path(spark, "t_compact_large")
    day = raw.withColumn("shipment_date", F.lit("1995-01-01").cast("date"))
    n = day.count()
    day.repartition(12).write.partitionBy("shipment_date").parquet(path)
    assert L.compact_days(spark, path, rows_per_file=-(-n // 2)) == 1
    assert len(_files(path)) == 2 and spark.read.parquet(path).count() == n


def _groups_hit(path, column, value):
    """Row groups whose minimum and maximum admit the value."""
    hit = total = 0
    for f in _files(path, "*.parquet"):
        meta = pq.ParquetFile(f).metadata
        i = meta.schema.to_arrow_schema().get_field_index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(i).statistics
            total += 1
            hit += stats is not None and stats.has_min_max and stats.min <= value <= stats.max
    return hit, total


def test_both_columns_skip_row_groups(spark, sf_small):
    raw = Rg.raw_shipments(spark, sf_small)
    plain, path = shared_path(spark, "t_plain"), shared_path(spark, "t_clustered")
    raw.repartition(32).write.parquet(plain)
    L.land_clustered(raw, path, rows_per_file=-(-raw.count() // 32))
    assert len(_files(path, "*.parquet")) == 32 and _same(SR.read_landed(spark, path), raw)
    some = raw.where("shipment_date is not null and customer_id is not null").orderBy("shipment_id").first()
    for column, value in (("shipment_date", some.shipment_date), ("customer_id", some.customer_id)):
        (was, _), (now, total) = _groups_hit(plain, column, value), _groups_hit(path, column, value)
        assert was == 32 and 0 < now <= total // 2, column


def _scanned(df):
    """Rows that the scan handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def test_bloom_filter_skips_row_groups_of_an_absent_id(spark, sf_small):
    raw = Rg.raw_shipments(spark, sf_small)
    with_, without = shared_path(spark, "t_bloom"), shared_path(spark, "t_no_bloom")
    for path, bloom in ((with_, "shipment_id"), (without, None)):
        L.land_clustered(raw, path, rows_per_file=1000, bloom=bloom)
    absent = "shipment_id = '2-1x'"                                                  # inside the range of ids, and none of them
    assert _scanned(SR.read_landed(spark, without).where(absent)) > 0 == _scanned(SR.read_landed(spark, with_).where(absent))
    present = raw.select("shipment_id").first()[0]
    assert SR.read_landed(spark, with_).where(F.col("shipment_id") == present).count() == raw.where(F.col("shipment_id") == present).count()


def test_empty_tables(spark, raw):
    path = shared_path(spark, "t_layout_empty")
    assert L.land_clustered(raw.limit(0), path) == 1 and SR.read_landed(spark, path).count() == 0
    assert RC.reconciled(raw.limit(0), raw.limit(0)).count() == 0


def test_content_differences_are_named(spark, raw):
    RC.require_reconciled(RC.reconciled(raw, raw.repartition(5)))                    # order and partitions do not matter
    status = lambda landed: {r.status for r in RC.reconciled(raw, landed).collect()} - {"OK"}
    # two rows of one day swap a value: counts and totals agree
    day = raw.where("shipment_date is not null").groupBy("shipment_date").agg(F.countDistinct("customer_id").alias("n")).where("n > 1").orderBy("shipment_date").first()[0]
    rows = raw.where(F.col("shipment_date") == day).orderBy("shipment_id").collect()
    other = next(r for r in rows if r.customer_id != rows[0].customer_id)
    swap = {rows[0].customer_id: other.customer_id, other.customer_id: rows[0].customer_id}
    here = F.col("shipment_date").eqNullSafe(F.lit(day))
    changed = F.coalesce(*[F.when(here & (F.col("customer_id") == k), F.lit(v)) for k, v in swap.items()], F.col("customer_id"))
    swapped = raw.withColumn("customer_id", changed)
    assert status(swapped) == {"CONTENT"}
    with pytest.raises(Q.QualityError, match="CONTENT"):
        RC.require_reconciled(RC.reconciled(raw, swapped))
    one = raw.where(F.col("shipment_date") == day).limit(1)
    assert status(raw.unionByName(one)) == {"COUNT"}
    assert status(raw.where(~F.col("shipment_date").eqNullSafe(F.lit(day)))) == {"MISSING"}
    assert status(raw.unionByName(one.withColumn("shipment_date", F.lit("2030-01-01").cast("date")))) == {"EXTRA"}
    assert status(raw.withColumn("cost_of_product", F.when(F.col("shipment_date") == F.lit(day), F.col("cost_of_product") + 0.01).otherwise(F.col("cost_of_product")))) == {"AMOUNT"}
    moved = raw.withColumns({"customer_id": F.col("route"), "route": F.col("customer_id")})
    assert "CONTENT" in status(moved)


def test_null_fields_are_part_of_the_checksum(spark):
    rows = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert rows.select(RC.row_hash(["x", "y"])).distinct().count() == 2


def test_kpi_totals_differ_when_an_output_lost_a_group(spark, raw):
    from parcelwise.operators import clean as C
    from parcelwise.operators import kpis as A
    rows = C.clean(G.drop_missing_key(raw))
    outputs = A.kpis_from_rollup(A.kpi_rollup(rows))
    assert {r.status for r in RC.kpi_totals(rows, outputs).collect()} == {"OK"}
    outputs["route_kpis"] = outputs["route_kpis"].orderBy("total_shipments").limit(2)
    assert {r.output for r in RC.kpi_totals(rows, outputs).where("status <> 'OK'").collect()} == {"route_kpis"}
