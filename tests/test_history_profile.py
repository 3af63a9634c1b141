"""Landing folders with drifting headers, and type profiles that report offenders."""

import pyspark.sql.functions as F

from parcelwise import schema as S
from parcelwise.plans import registry as Rg
from parcelwise.session import shared_path
from parcelwise.sinks import writers as W
from parcelwise.sources import history as H
from parcelwise.sources import readers as SR
from parcelwise.sources import type_profile as TP



def _put(spark, prefix, day, name, text):
    """One file of a delivery, written as another tool would."""
    path = f"{prefix}/{day}"
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    out = fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(fs)
    out.writeBytes(text)
    out.close()


def test_headers_of_one_folder_may_differ(spark):
    prefix = shared_path(spark, "t_mixed")
    _put(spark, prefix, "2024-01-01", "a.csv", "shipment_id,route,customer_id\ns1,r1,c1\n")
    _put(spark, prefix, "2024-01-01", "b.csv", "route,shipment_id,colour\nr2,s2,red\nr3,s3,blue\n")
    _put(spark, prefix, "2024-01-02", "a b.csv", "shipment_id,route,customer_id\ns4,r4,c4\n")
    _put(spark, prefix, "2024-01-02", "empty.csv", "")
    _put(spark, prefix, "2024-01-03", "only_header.csv", "route,shipment_id,colour\n")
    df = H.read_history(spark, prefix)
    assert df.columns == [*S.SOURCE_COLUMNS, "ds"]
    got = sorted(tuple(r) for r in df.select("shipment_id", "route", "customer_id", "ds").collect())
    assert got == [("s1", "r1", "c1", "2024-01-01"), ("s2", "r2", None, "2024-01-01"), ("s3", "r3", None, "2024-01-01"), ("s4", "r4", "c4", "2024-01-02")]


def test_drift_is_reported(spark):
    prefix = shared_path(spark, "t_drift")
    names = S.SOURCE_COLUMNS
    _put(spark, prefix, "2024-01-01", "a.csv", ",".join(names) + "\n")
    _put(spark, prefix, "2024-01-01", "b.csv", ",".join(names) + "\n")
    _put(spark, prefix, "2024-01-02", "a.csv", ",".join([*reversed(names[1:]), '"odd, name"']) + "\n")
    got = [tuple(r) for r in H.header_drift(spark, prefix).orderBy("ds").collect()]
    assert got == [("2024-01-01", 2, "", "", False), ("2024-01-02", 1, names[0], "odd, name", True)]


def test_range_reads_its_days_only(spark, sf_small):
    prefix = Rg._drifting_landing(spark, sf_small)
    df = H.read_history(spark, prefix, since="2024-01-02", until="2024-01-02")
    assert [r.ds for r in df.select("ds").distinct().collect()] == ["2024-01-02"]
    assert {f.rsplit("/", 2)[1] for f in df.inputFiles()} == {"2024-01-02"}
    assert H.read_history(spark, prefix, since="2030-01-01").count() == 0
    assert H.header_drift(spark, shared_path(spark, "t_nothing")).count() == 0


def test_scans_grow_with_the_headers_not_the_days(spark, sf_small):
    prefix = shared_path(spark, "t_many_days")
    rows = Rg.source_text(spark, sf_small).limit(40).coalesce(1)
    for day in range(1, 9):
        W.write_csv(rows if day % 2 else rows.select(*reversed(rows.columns)), SR.landing_path(prefix, f"2024-01-0{day}"))
    df = H.read_history(spark, prefix)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and df.count() == 320
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert before != H.FILE_PER_TASK["spark.sql.files.maxPartitionBytes"]  # the settings are the header job's alone


def test_profile_equals_inference_on_clean_data(spark, sf_small):
    """Columns without bad values: the exact type is what Spark infers."""
    clean = Rg.source_text(spark, sf_small).select(
        *[F.col(c) for c in ("customer_id", "mode_of_shipment", "cost_of_product", "weight_in_gms")],
        F.when(F.col("shipment_date") != "not-a-date", F.col("shipment_date")).alias("day"),
        F.concat(F.lit("30000000"), F.col("customer_id"), F.lit("00")).alias("wide"),
        F.concat(F.lit("1234567890123456789012"), F.col("customer_id")).alias("wider"),
        (F.col("customer_id").cast("long") % 2 == 0).cast("string").alias("flag"),
        F.when(F.col("customer_id").endswith("1"), F.lit("2024-01-01 10:11:12")).otherwise(F.lit("2024-02-03")).alias("moment"),
    )
    path = shared_path(spark, "t_clean")
    W.write_csv(clean, path)
    inferred = {f.name: f.dataType.simpleString().split("(")[0] for f in SR.read_csv_inferred(spark, path).schema.fields}
    found = {r.column_name: r.exact_type for r in TP.type_profile(clean).collect()}
    assert found == inferred


def test_offenders_are_listed(spark):
    rows = spark.createDataFrame([("1", "a"), ("2", "b"), ("n/a", "1"), ("x", "2"), ("x", None), ("4", "")] + [("7", "c")] * 94, "n string, t string")
    profile = TP.type_profile(rows)
    got = {r.column_name: r for r in profile.collect()}
    assert (got["n"].n_values, got["n"].n_missing, got["n"].exact_type, got["n"].leading_type, got["n"].n_offenders, got["n"].example) == (99, 1, "string", "int", 2, "x")
    assert (got["t"].exact_type, got["t"].leading_type, got["t"].n_offenders, got["t"].example) == ("string", "string", 0, None)
    assert [tuple(r) for r in TP.type_offenders(rows, profile).collect()] == [("n", "int", "x", 2)]


def test_profile_of_nothing(spark):
    nothing = TP.type_profile(spark.createDataFrame([(None,)], "c string")).first()
    assert (nothing.n_values, nothing.n_missing, nothing.exact_type, nothing.leading_type) == (0, 1, "string", "string")
    assert TP.type_profile(spark.createDataFrame([], "c string")).count() == 0


def test_profile_is_one_aggregation(spark, sf_small):
    path = shared_path(spark, "t_profile_plan")
    W.write_csv(Rg.source_text(spark, sf_small), path)
    plan = TP.type_profile(SR.read_source_csv(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
