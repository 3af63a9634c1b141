"""The warehouse connector: round trips, pushed filters, file skipping, commits and failed attempts."""

import datetime
import os
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.session import shared_path
from parcelwise.sinks import writers as W
from parcelwise.sources import connector as CN
from parcelwise.sources import readers as SR

SCHEMA = "n long, t string, d date, ok boolean, price decimal(10,2), x double, at timestamp, tags array<string>"


@pytest.fixture(scope="module")
def fmt(spark):
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled", None)
    yield CN.register(spark)
    if before is None:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    else:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


def _rows(spark):
    day = datetime.date(2024, 1, 1)
    stamp = datetime.datetime(2024, 1, 1, 6, 30, 1, 5)
    rows = [(i, f"k{i % 7}", day + datetime.timedelta(days=i), i % 2 == 0, Decimal(i) / 4, i / 3, stamp, ["a", None] if i % 3 else []) for i in range(60)]
    rows += [(None,) * 8, (100, "", None, None, None, float("nan"), None, None), (101, "K\n\"Ü,", day, None, Decimal("-1.25"), -0.5, stamp, ["é"])]
    rows.append(rows[0])  # repeated
    return spark.createDataFrame(rows, SCHEMA)


def _options(spark):
    return {"warehouse": shared_path(spark, "t_connector")}


def _files(options, table):
    folder = f"{options['warehouse'].removeprefix('file:')}/{table}/data"
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def _same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_every_type_and_odd_rows_come_back(spark, fmt):
    options, df = _options(spark), _rows(spark)
    W.publish_table(df, "t", fmt, **options)
    back = SR.read_table(spark, "t", fmt, **options)
    assert back.schema.simpleString() == df.schema.simpleString()
    _same(back, df)
    _same(SR.read_table(spark, "t", fmt, columns="t, n", **options), df.select("t", "n"))


@pytest.mark.parametrize("text", [
    "n = 5", "n > 57", "n >= 58", "n < 3", "n <= 3", "n IN (1, 2, 99)", "n NOT IN (1, 2, 99)", "n IS NULL", "n IS NOT NULL",
    "n IN (1, NULL)", "n <=> NULL", "t = ''", "t > 'k3'", "t LIKE 'k1%'", "NOT t LIKE 'k1%'", "t <> 'k1'", "NOT (n > 3)",
    "d = DATE'2024-01-09'", "d >= DATE'2024-02-25' AND ok", "NOT ok", "price = 1.25", "price < 0", "x > 15", "x = 'NaN'",
    "at > TIMESTAMP'2024-01-01 00:00:00'", "n > 57 OR t = ''", "n % 2 = 0 AND d IS NULL", "n = 5000",
])
def test_filters_agree_with_spark(spark, fmt, text):
    options = {"warehouse": f"{shared_path(spark, 't_filters').rsplit('-', 1)[0]}-shared"}
    df = _rows(spark)
    if not _files(options, "t"):
        W.publish_table(df.repartitionByRange(4, "n"), "t", fmt, **options)
    _same(SR.read_table(spark, "t", fmt, **options).where(text), df.where(text))


def test_filters_are_taken_over_and_files_left_out(spark, fmt):
    options = _options(spark)
    W.publish_table(_rows(spark).repartitionByRange(6, "n"), "t", fmt, **options)
    folder = CN.Folder(f"{options['warehouse']}/t")
    schema = CN.WarehouseTable({**options, "table": "t"}).schema()

    def left(*filters):
        reader = CN.TableReader(folder, schema, folder.entries())
        return list(reader.pushFilters(list(filters))), len(reader.planned())

    every = len(_files(options, "t"))
    assert every > 3
    assert left() == ([], every)
    assert left(CN.D.EqualTo(("n",), 100))[1] < every
    assert left(CN.D.EqualTo(("d",), datetime.date(2030, 1, 1))) == ([], 0)
    assert left(CN.D.In(("n",), (5000, 6000))) == ([], 0)
    kept = CN.D.GreaterThan(("x",), 1.0)  # floats stay with Spark, as NaN compares differently
    assert left(kept) == ([kept], every)
    plan = SR.read_table(spark, "t", fmt, **options).where("n = 5 and x > 1")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and "n#" in plan and "(n#" not in plan.split("Filter")[1].split("BatchScan")[0]  # n = 5 is not run again


def test_small_files_share_a_task(spark, fmt):
    options = _options(spark)
    for _ in range(2):
        W.append_table(_rows(spark).repartition(4), "t", fmt, **options)
    assert len(_files(options, "t")) == 8
    back = SR.read_table(spark, "t", fmt, **options)
    assert back.rdd.getNumPartitions() == 1 and back.count() == 2 * 64


def test_overwrite_replaces_and_append_adds(spark, fmt):
    options, df = _options(spark), _rows(spark)
    W.append_table(df, "t", fmt, **options)
    W.publish_table(df.where("n < 10"), "t", fmt, **options)
    W.append_table(df.where("n >= 50"), "t", fmt, **options)
    _same(SR.read_table(spark, "t", fmt, **options), df.where("n < 10 or n >= 50"))
    with pytest.raises(Exception, match="cannot be appended"):
        W.append_table(df.select("n"), "t", fmt, **options)
    W.publish_table(df.where("false"), "t", fmt, **options)
    assert SR.read_table(spark, "t", fmt, **options).collect() == []
    with pytest.raises(Exception, match="no table"):
        SR.read_table(spark, "missing", fmt, **options)


def test_large_files_are_cut(spark, monkeypatch):
    monkeypatch.setattr(CN, "FILE_BYTES", 1)
    options = _options(spark)
    folder = CN.Folder(f"{options['warehouse'].removeprefix('file:')}/t")
    schema = T.StructType([T.StructField("n", T.LongType())])
    batches = [pa.record_batch({"n": pa.array(range(k, k + 5), pa.int64())}) for k in (0, 5, 10)]
    written = CN.TableWriter(folder, schema, True).write(iter(batches))
    assert [f["rows"] for f in written.files] == [5, 5, 5]
    assert [f["ranges"]["n"][:2] for f in written.files] == [[0, 4], [5, 9], [10, 14]]


def test_a_failed_attempt_leaves_no_row(spark, fmt):
    options = _options(spark)
    path = f"{options['warehouse'].removeprefix('file:')}/t"
    schema = T.StructType([T.StructField("n", T.LongType())])
    batch = pa.record_batch({"n": pa.array([1, 2, 3], pa.int64())})
    writer = CN.TableWriter(CN.Folder(path), schema, True)

    def stops():
        yield batch
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        writer.write(stops())
    assert _files(options, "t") == []                # an attempt that fails removes its file
    writer.write(iter([batch]))                      # an attempt whose executor is lost before it reports: its file stays
    again = writer.write(iter([batch]))
    writer.commit([again, None])
    assert len(_files(options, "t")) == 2
    assert sorted(r.n for r in SR.read_table(spark, "t", fmt, **options).collect()) == [1, 2, 3]


def test_a_failed_job_changes_nothing(spark, fmt):
    options, df = _options(spark), _rows(spark).where("n < 60")
    W.publish_table(df, "t", fmt, **options)
    before = _files(options, "t")
    bad = df.repartition(4).withColumn("n", F.when(F.col("n") == 7, F.raise_error(F.lit("bad row")).cast("long")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="bad row"):
        W.publish_table(bad, "t", fmt, **options)
    _same(SR.read_table(spark, "t", fmt, **options), df)
    assert set(before) <= set(_files(options, "t"))
