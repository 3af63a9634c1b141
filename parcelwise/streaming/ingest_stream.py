"""Streaming ingestion: subscribe to shipment messages, type them, append to a table.

``readStream`` -> JSON decode -> the batch ingestion rules (missing tokens,
lenient casts, key check) -> ``writeStream`` to Parquet with a checkpoint in
shared storage, so a restarted query resumes from its last committed offsets
(exactly-once into the file sink). Delivery can repeat; with ``keyed`` every
batch is merged by shipment id into a target with a key index
(``operators.keyed_table``), with ``dedup_buckets`` into a bucketed one
(``operators.dedup.merge_latest``): an id that was not seen before is never
dropped, however late, and a known id keeps its newest row. A batch that is
repeated after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelwise import schema as S
from parcelwise.operators.dedup import merge_latest, read_target
from parcelwise.operators.ingest import typed_columns
from parcelwise.operators.keyed_table import load_keyed, read_keyed
from parcelwise.streaming.messages import decode


def subscribe(spark: SparkSession, topic: str, fmt: str = "text", max_files_per_trigger: int | None = None,
              **options: str) -> DataFrame:
    """A stream of messages with a ``value`` column (file folder or a connector topic).

    A compressed file is read by one task, so a batch of fewer files than cores deals its lines out to all of them.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "text":
        if not max_files_per_trigger:
            return reader.options(**options).load(topic)
        lines = reader.option("maxFilesPerTrigger", max_files_per_trigger).options(**options).load(topic)
        cores = spark.sparkContext.defaultParallelism
        return lines.repartition(cores, F.xxhash64("value")) if max_files_per_trigger < cores else lines
    return reader.option("subscribe", topic).options(**options).load()


def typed_events(messages: DataFrame) -> DataFrame:
    """Decoded, typed, keyed events with ``ingested_at`` (publisher's, else now)."""
    text = decode(messages)
    stamped = F.coalesce(F.col("ingested_at").try_cast("timestamp"),
                         F.date_trunc("second", F.current_timestamp())).alias("ingested_at")
    events = text.select(*typed_columns(), stamped).dropna(subset=["shipment_id"])
    return events.select(*S.RAW_SCHEMA.fieldNames())


def start_ingest(spark: SparkSession, topic: str, sink: str, checkpoint: str, fmt: str = "text",
                 dedup_buckets: int | None = None, keyed: bool = False, available_now: bool = True,
                 processing_time: str | None = None, max_files_per_trigger: int | None = None,
                 **options: str) -> StreamingQuery:
    """Start the stream into ``sink`` (Parquet): append, or with ``keyed`` or ``dedup_buckets`` a merge by id per batch."""
    events = typed_events(subscribe(spark, topic, fmt, max_files_per_trigger, **options))
    writer = events.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if keyed:
        writer = writer.foreachBatch(lambda batch, _: load_keyed(batch, sink) and None)
    elif dedup_buckets:
        writer = writer.foreachBatch(lambda batch, _: merge_latest(batch, sink, dedup_buckets))
    else:
        writer = writer.format("parquet").option("path", sink)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_to_completion(spark: SparkSession, topic: str, sink: str, checkpoint: str, **kwargs) -> DataFrame:
    """Process everything available now, then return the sink as a batch frame."""
    query = start_ingest(spark, topic, sink, checkpoint, available_now=True, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream ingest failed: {query.exception()}")
    if kwargs.get("keyed"):
        return read_keyed(spark, sink, S.RAW_SCHEMA)
    if kwargs.get("dedup_buckets"):
        return read_target(spark, sink, S.RAW_SCHEMA)
    return spark.read.schema(S.RAW_SCHEMA).parquet(sink)
