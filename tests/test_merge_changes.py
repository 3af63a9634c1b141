"""Bucket merge, messages and stream queries: work that a load or a topic of any size does not need is left out."""

import glob
import random

import pytest

from parcelwise.operators import dedup as D
from parcelwise.plans import registry as Rg
from parcelwise.session import list_names, shared_path, tidy_shuffles
from parcelwise.streaming import messages as T1
from parcelwise.streaming.ingest_stream import typed_events

SCHEMA = "shipment_id string, ingested_at timestamp, shipment_date date, route string, cost_of_product double"


def _rows(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, c string, d string, e double").selectExpr(
        "a shipment_id", "cast(b as timestamp) ingested_at", "cast(c as date) shipment_date", "d route", "e cost_of_product")


def _files(target):
    return set(glob.glob(f"{target.replace('file:', '')}/key_bucket=*/*.parquet"))


def _some(seed, n):
    r = random.Random(seed)
    return [(r.choice([None, *[f"k{i}" for i in range(40)]]), r.choice([None, "2024-01-01", "2024-01-02", "2024-01-03"]),
             r.choice([None, "1995-01-01", "1995-01-02"]), r.choice([None, "", "x", "y"]), r.choice([None, 0.0, 1.5, float("nan")])) for _ in range(n)]


def test_any_loads_give_the_newest_row_of_every_key(spark):
    target, whole = shared_path(spark, "t_any"), []
    for seed in range(4):
        whole += _some(seed, 60)
        D.merge_latest(_rows(spark, _some(seed, 60)), target, 4)
        got = D.read_target(spark, target, _rows(spark, whole[:1]).schema)
        assert sorted(map(str, got.collect())) == sorted(map(str, D.latest_per_key(_rows(spark, whole)).collect()))


def test_a_load_without_news_leaves_all_files_and_unseen_keys_join_them(spark):
    target = shared_path(spark, "t_news")
    first = _rows(spark, [(f"k{i}", "2024-01-02", "1995-01-01", "x", 1.0) for i in range(200)])
    D.merge_latest(first, target, 4)
    before = _files(target)
    D.merge_latest(first, target, 4)
    D.merge_latest(_rows(spark, [(f"k{i}", "2024-01-01", None, "older", 2.0) for i in range(200)]), target, 4)
    assert _files(target) == before and len(before) == 4
    D.merge_latest(_rows(spark, [(f"n{i}", "2024-01-01", None, "unseen", 2.0) for i in range(200)]), target, 4)
    assert before < _files(target)
    assert D.read_target(spark, target, first.schema).count() == 400


def test_a_bucket_of_many_files_is_made_one(spark, monkeypatch):
    monkeypatch.setattr(D, "MOST_FILES", 3)
    target = shared_path(spark, "t_many")
    for k in range(5):
        load = _rows(spark, [(f"k{k}-{i}", "2024-01-02", None, "x", 1.0) for i in range(50)])
        D.merge_latest(load, target, 2)
        assert len(_files(target)) <= 6
    assert D.read_target(spark, target, load.schema).count() == 250


def test_new_files_that_were_half_moved_are_moved_by_the_next_load(spark, monkeypatch):
    target = shared_path(spark, "t_half")
    first = _rows(spark, [(f"k{i}", "2024-01-02", None, "x", 1.0) for i in range(50)])
    D.merge_latest(first, target, 4)
    moves, move = [], D.move_into

    def once(*args):
        moves.append(args)
        if len(moves) == 2:
            raise RuntimeError("lost driver")
        return move(*args)

    with monkeypatch.context() as m:
        m.setattr(D, "move_into", once)
        with pytest.raises(RuntimeError):
            D.merge_latest(_rows(spark, [(f"n{i}", "2024-01-02", None, "x", 1.0) for i in range(50)]), target, 4)
    D.merge_latest(_rows(spark, [("last", "2024-01-02", None, "x", 1.0)]), target, 4)
    ids = [r.shipment_id for r in D.read_target(spark, target, first.schema).collect()]
    assert len(ids) == len(set(ids)) == 101


def test_a_message_is_parsed_once(spark):
    lines = [('{"shipment_id":"a","customer_rating":4}',), ('{"shipment_id":"n/a"}',), ("no json",), (None,), ('{"route":"x"}',)]
    events = typed_events(spark.createDataFrame(lines, "value string"))
    assert [(r.shipment_id, r.customer_rating) for r in events.collect()] == [("a", 4)]
    assert T1.decode(spark.createDataFrame(lines, "value string")).count() == 5
    assert events._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_a_topic_of_many_files_is_read_in_three_batches(spark, sf_small, monkeypatch):
    want = Rg.q_stream_run_summary(spark, sf_small).collect()
    monkeypatch.setitem(T1.TEXT_OPTIONS, "maxRecordsPerFile", "300")
    assert Rg.q_stream_run_summary(spark, sf_small).collect() == want and want[0].batches == 3


def test_a_large_table_goes_out_as_it_lies(spark):
    small, large = shared_path(spark, "t_parts_small"), shared_path(spark, "t_parts_large")
    rows = spark.range(2000).selectExpr("cast(id as string) shipment_id")
    Rg._publish_in_parts(spark, rows.coalesce(1), small, f"{small}-source")
    assert sum(n.startswith("part-") for n in list_names(spark, small)) == 8
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # a split per file
    try:
        Rg._publish_in_parts(spark, rows.repartition(11), large, f"{large}-source")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(n.startswith("part-") for n in list_names(spark, large)) >= 11
    assert spark.read.text(large).count() == spark.read.text(small).count() == 2000


def test_jobs_give_back_their_shuffle_files(spark):
    def held():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = manager.getAllFiles()
        return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))

    before = held()
    with tidy_shuffles(spark):
        spark.range(1000).repartition(7, "id").write.parquet(shared_path(spark, "t_tidy"))
    assert held() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
