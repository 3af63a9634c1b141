"""Compressed topics, and a bucket merge that moves what it has staged."""

import glob

from pyspark.sql import functions as F

from parcelwise.operators import dedup as D
from parcelwise.session import list_names, shared_path
from parcelwise.streaming import ingest_stream as T2
from parcelwise.streaming import messages as T1
from parcelwise.streaming import publish_stream as PS


def _rows(spark, n, route, at="2024-01-01"):
    return spark.range(n).select(F.concat(F.lit("id"), "id").alias("shipment_id"), F.lit(at).cast("timestamp").alias("ingested_at"), F.lit(route).alias("route"))


def test_topics_are_compressed_and_read_back(spark):
    topic, staged = shared_path(spark, "t_gz"), shared_path(spark, "t_gz_epoch")
    rows = _rows(spark, 500, "north -> south")
    T1.publish(rows, topic)
    PS.publish_epoch(rows, 0, staged, "p")
    for path in (topic, staged):
        assert all(n.endswith(".gz") for n in list_names(spark, path) if not n.startswith("_"))
        assert sorted(r[0] for r in T1.decode(spark.read.text(path)).select("shipment_id").collect()) == sorted(f"id{i}" for i in range(500))


def test_a_batch_of_few_files_is_dealt_to_all_cores(spark, capsys):
    topic = shared_path(spark, "t_deal")
    T1.publish(_rows(spark, 10, "x").coalesce(1), topic)
    T2.subscribe(spark, topic, max_files_per_trigger=1).explain("extended")
    assert "RepartitionByExpression [xxhash64" in capsys.readouterr().out


def test_untouched_buckets_keep_their_files_and_a_load_is_moved_once(spark):
    target = shared_path(spark, "t_moved")
    D.merge_latest(_rows(spark, 200, "old"), target, 8)
    place = target.replace("file:", "")
    before = set(glob.glob(f"{place}/key_bucket=*/*.parquet"))
    one = _rows(spark, 1, "new", "2024-01-02")
    D.merge_latest(one, target, 8)
    after = set(glob.glob(f"{place}/key_bucket=*/*.parquet"))
    assert len(before) == 8 and len(after) == 8 and len(before & after) == 7
    got = {r.shipment_id: r.route for r in D.read_target(spark, target, one.schema).collect()}
    assert len(got) == 200 and got["id0"] == "new" and got["id1"] == "old"
    assert not glob.glob(f"{place}__merge*")
