"""Stream deduplication with bounded state: repeated deliveries within the watermark are dropped.

Messages carry their event time (``ingested_at`` of the publisher). An id is
remembered until the watermark, the highest event time seen so far less
``delay``, has passed its first delivery by ``delay``; then its state goes.
State therefore holds the ids of the last ``delay`` of event time and not of
the whole history. It lives in RocksDB on the executors, outside the JVM heap,
with its changelog in the checkpoint folder, so a lost executor rebuilds it.

A repeat that comes later than that is not recognised, and a message whose
event time is behind the watermark is dropped as late: where no delay bounds
the repeats, use the keyed merge of ``ingest_stream`` instead. A message
without an event time would never leave the state and is stamped with the time
it is read at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from parcelwise import schema as S
from parcelwise.session import session_settings
from parcelwise.streaming.ingest_stream import subscribe, typed_events

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
DELAY = "2 days"


def distinct_events(messages: DataFrame, delay: str = DELAY, key: str = "shipment_id") -> DataFrame:
    """Typed events, each id once within the watermark; works on a stream."""
    return typed_events(messages).withWatermark("ingested_at", delay).dropDuplicatesWithinWatermark([key])


def start_distinct_ingest(spark: SparkSession, topic: str, sink: str, checkpoint: str, fmt: str = "text", delay: str = DELAY,
                          processing_time: str | None = None, max_files_per_trigger: int | None = None, **options: str) -> StreamingQuery:
    """Start the stream into ``sink`` (Parquet, exactly once per accepted event)."""
    events = distinct_events(subscribe(spark, topic, fmt, max_files_per_trigger, **options), delay)
    writer = (events.writeStream.outputMode("append").format("parquet").option("path", sink).option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    with session_settings(spark, STATE_STORE):
        return writer.start()


def ingest_distinct(spark: SparkSession, topic: str, sink: str, checkpoint: str, **kwargs) -> DataFrame:
    """Process everything available now, then return the sink as a batch frame."""
    query = start_distinct_ingest(spark, topic, sink, checkpoint, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream ingest failed: {query.exception()}")
    return spark.read.schema(S.RAW_SCHEMA).parquet(sink)


def remembered_ids(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The ids that the stream's state holds after its last batch, with the time at which each one leaves it."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.selectExpr("key.*", "timestamp_micros(value.expiresAtMicros) AS leaves_at")
