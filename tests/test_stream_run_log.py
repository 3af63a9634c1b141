"""Run log of a stream: one row per batch, its sums equal the sink."""

import pytest

from parcelwise import schema as S
from parcelwise.plans import registry as Rg
from parcelwise.session import delete_path, list_names, shared_path
from parcelwise.streaming import messages as T1
from parcelwise.streaming import run_log as RL


@pytest.fixture
def places(spark):
    base = shared_path(spark, "t_run_log")
    return {"topic": f"{base}/topic", "sink": f"{base}/sink", "checkpoint": f"{base}/ckpt", "log": f"{base}/log"}


def test_one_row_per_batch_and_sums_equal_the_sink(spark, sf_small, places):
    T1.publish(Rg.raw_shipments(spark, sf_small).repartition(5), places["topic"])
    spark.createDataFrame([('{"route":"no id"}',), ("no json",)], "value string").coalesce(1).write.mode("append").text(places["topic"])
    rows = RL.ingest_logged(spark, **places, max_files_per_trigger=2).orderBy("batch_id").collect()
    assert [r.batch_id for r in rows] == [0, 1, 2]
    sink = spark.read.schema(S.RAW_SCHEMA).parquet(places["sink"])
    got = sink.selectExpr("count(*) n", "count_if(shipment_date IS NULL) u", "sum(cost_of_product) c", "min(shipment_date) a", "max(shipment_date) b").first()
    assert sum(r.landed_rows for r in rows) == got.n == sum(r.source_rows for r in rows) - 2
    assert sum(r.undated_rows for r in rows) == got.u
    assert sum(r.total_cost for r in rows) == pytest.approx(got.c)
    assert (min(r.first_date for r in rows), max(r.last_date for r in rows)) == (got.a, got.b)
    assert RL.unlogged_batches(spark, places["checkpoint"], places["log"]) == []


def test_a_repeated_batch_has_one_row_and_a_lost_one_is_found(spark, sf_small, places):
    raw = Rg.raw_shipments(spark, sf_small)
    T1.publish(raw.repartition(2), places["topic"])
    RL.ingest_logged(spark, **places, max_files_per_trigger=1)
    delete_path(spark, f"{places['checkpoint']}/commits/1")  # stopped before the commit: the batch is run again
    T1.publish(raw.limit(7).coalesce(1), places["topic"])
    rows = {r.batch_id: r.landed_rows for r in RL.ingest_logged(spark, **places, max_files_per_trigger=1).collect()}
    assert sorted(rows) == [0, 1, 2] and rows[2] == 7
    assert sum(rows.values()) == spark.read.parquet(places["sink"]).count()
    delete_path(spark, f"{places['log']}/shipments/1.json")
    assert RL.unlogged_batches(spark, places["checkpoint"], places["log"]) == [1]


def test_nothing_new_logs_nothing(spark, sf_small, places):
    T1.publish(Rg.raw_shipments(spark, sf_small).limit(5).coalesce(1), places["topic"])
    RL.ingest_logged(spark, **places)
    RL.ingest_logged(spark, **places)
    assert list_names(spark, f"{places['log']}/shipments") == ["0.json"]
    assert RL.read_log(spark, shared_path(spark, "t_no_log")).count() == 0


def test_a_log_that_cannot_be_written_fails_the_run(spark, sf_small, places, monkeypatch):
    T1.publish(Rg.raw_shipments(spark, sf_small).limit(5).coalesce(1), places["topic"])

    def refused(*_):
        raise OSError("no space")

    monkeypatch.setattr(RL, "create_exclusively", refused)
    with pytest.raises(RuntimeError, match="run log of shipments"):
        RL.ingest_logged(spark, **places)
