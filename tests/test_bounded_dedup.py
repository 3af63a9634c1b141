"""Bounded-state stream dedup: repeats within the watermark, state that shrinks, restarts."""

from pyspark.sql import functions as F

from parcelwise.operators import dedup as D
from parcelwise.plans import registry as Rg
from parcelwise.session import shared_path
from parcelwise.streaming import bounded_dedup as BD
from parcelwise.streaming import messages as T1


def _at(df, days):
    return df.withColumn("ingested_at", F.to_timestamp(F.lit(Rg.RUN_TS)) + F.make_dt_interval(hours=F.lit(int(24 * days))))


def test_old_ids_leave_the_state_and_a_restart_repeats_nothing(spark, sf_small):
    raw = D.latest_per_key(Rg.raw_shipments(spark, sf_small))
    old, new = raw.where("customer_id < '5'"), raw.where("customer_id >= '5'")
    n_old, n_new = old.count(), new.count()
    topic, base = shared_path(spark, "t_bounded_topic"), shared_path(spark, "t_bounded")

    def run():
        return BD.ingest_distinct(spark, topic, f"{base}/events", f"{base}/_checkpoint")

    T1.publish(_at(old, 0).unionByName(_at(old, 1)), topic)
    assert run().count() == n_old
    held = BD.remembered_ids(spark, f"{base}/_checkpoint")
    assert held.count() == n_old and held.columns == ["shipment_id", "leaves_at"]
    assert run().count() == n_old                                                    # a restart without new messages
    T1.publish(_at(new, 10), topic)
    T1.publish(_at(new.limit(7), 10), topic)
    assert run().count() == n_old + n_new
    T1.publish(_at(new.limit(5), 10.5), topic)                                       # a batch after the watermark has moved
    got = run()
    assert got.count() == n_old + n_new == got.select("shipment_id").distinct().count()
    held = {r.shipment_id for r in BD.remembered_ids(spark, f"{base}/_checkpoint").collect()}
    assert held == {r.shipment_id for r in new.select("shipment_id").collect()}      # the old ids are gone
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != BD.STATE_STORE["spark.sql.streaming.stateStore.providerClass"]


def test_an_event_behind_the_watermark_is_dropped_as_late(spark, sf_small):
    raw = D.latest_per_key(Rg.raw_shipments(spark, sf_small)).orderBy("shipment_id")
    first, late = raw.limit(20), raw.orderBy(F.desc("shipment_id")).limit(20)
    topic, base = shared_path(spark, "t_late_topic"), shared_path(spark, "t_late")
    for batch in (_at(first, 10), _at(late, 1)):
        T1.publish(batch, topic)
        got = BD.ingest_distinct(spark, topic, f"{base}/events", f"{base}/_checkpoint")
    assert got.count() == 20
