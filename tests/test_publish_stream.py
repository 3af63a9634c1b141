"""Stream publishing: an epoch that is run again publishes once, wherever it stopped."""

import pytest

from parcelwise.plans import registry as Rg
from parcelwise.session import list_names, shared_path
from parcelwise.sinks import writers as W
from parcelwise.streaming import messages as T1
from parcelwise.streaming import publish_stream as PS


def _ids(spark, topic):
    return sorted(r.shipment_id for r in T1.decode(spark.read.text(topic)).select("shipment_id").collect())


@pytest.fixture
def landed(spark, sf_small):
    path = shared_path(spark, "t_publish_landed")
    W.land_raw(Rg.raw_shipments(spark, sf_small).repartition(6), path)
    return path


@pytest.mark.parametrize("step", ["move_into", "create_exclusively", "write_finished"])
def test_a_stopped_epoch_is_taken_up(spark, landed, monkeypatch, step):
    topic, checkpoint = shared_path(spark, "t_topic"), shared_path(spark, "t_topic_ckpt")
    rows = PS.follow_table(spark, landed, max_files_per_trigger=2)
    whole, calls = getattr(PS, step), []

    def once(*args):
        calls.append(args)
        if len(calls) == 2:  # the second file of the first epoch, or the second epoch
            raise RuntimeError("lost driver")
        return whole(*args)

    monkeypatch.setattr(PS, step, once)
    with pytest.raises(Exception):
        PS.publish_available(rows, topic, checkpoint)
    PS.publish_available(PS.follow_table(spark, landed, max_files_per_trigger=2), topic, checkpoint)
    want = sorted(r.shipment_id for r in spark.read.parquet(landed).select("shipment_id").collect())
    assert len(calls) > 2 and _ids(spark, topic) == want


def test_epochs_are_logged_and_skipped(spark, landed):
    topic = shared_path(spark, "t_topic")
    batch = spark.read.parquet(landed)
    PS.publish_epoch(batch, 7, topic, "p")
    once = _ids(spark, topic)
    PS.publish_epoch(batch, 7, topic, "p")
    assert _ids(spark, topic) == once and list_names(spark, f"{topic}/_published/p") == ["7"]
    PS.publish_epoch(batch, 7, topic, "q")  # another publisher's epoch of the same number
    assert len(_ids(spark, topic)) == 2 * len(once)


def test_an_unfinished_staging_folder_is_written_anew(spark, landed):
    topic = shared_path(spark, "t_topic")
    spark.range(3).selectExpr("'half' AS value").write.text(f"{topic}/_staged/p/0")
    from parcelwise.session import delete_path
    delete_path(spark, f"{topic}/_staged/p/0/_SUCCESS")
    batch = spark.read.parquet(landed)
    PS.publish_epoch(batch, 0, topic, "p")
    assert len(_ids(spark, topic)) == batch.count()
    assert spark.read.text(topic).where("value = 'half'").count() == 0


def test_later_files_come_as_later_epochs(spark, landed, sf_small):
    topic, checkpoint = shared_path(spark, "t_topic"), shared_path(spark, "t_topic_ckpt")
    PS.publish_available(PS.follow_table(spark, landed), topic, checkpoint)
    first = len(_ids(spark, topic))
    Rg.raw_shipments(spark, sf_small).limit(10).write.mode("append").parquet(landed)
    PS.publish_available(PS.follow_table(spark, landed), topic, checkpoint)
    PS.publish_available(PS.follow_table(spark, landed), topic, checkpoint)
    assert len(_ids(spark, topic)) == first + 10


def test_connector_topics_send_an_epoch_once(spark, landed):
    """Any batch sink takes part; a logged epoch is not sent again."""
    out, log = shared_path(spark, "t_conn"), shared_path(spark, "t_conn_log")
    batch = spark.read.parquet(landed)
    for _ in range(2):
        PS.publish_epoch(batch, 3, "topic", "p", fmt="parquet", path=out, epoch_log=log)
    assert spark.read.parquet(out).count() == batch.count()
