"""Publishing as a stream: rows of a growing table become messages, each epoch exactly once.

A micro-batch that fails after its messages are out is run again by Spark, and
its messages would go out twice. An epoch therefore has a log entry, made with
a file that must not exist yet, and for a text topic three steps that a
repeated run takes up where the last one stopped:

1. the messages are written to a staging folder, by Spark's commit protocol;
   a staging folder without its commit mark is written anew;
2. its files are moved into the topic one by one, under names of the epoch;
   what has been moved is no longer staged, so it is not moved again;
3. the epoch is logged; an epoch that is logged is skipped.

Names that begin with an underscore are hidden from readers of the topic, so
staging and log lie inside it. ``publisher`` tells apart several streams that
share a topic; it must stay the same for one checkpoint. A connector topic has
no staging: an epoch that is logged is not sent again, one that stopped half-way
is (at least once), and ``key`` lets the subscriber drop repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from parcelwise import schema as S
from parcelwise.session import create_exclusively, list_names, move_into, path_exists, write_finished
from parcelwise.streaming.messages import TEXT_OPTIONS, publish, to_messages


def follow_table(spark: SparkSession, landed: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landed raw table as a stream: files that later loads add come as later batches."""
    reader = spark.readStream.schema(S.RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landed).select(*S.RAW_SCHEMA.fieldNames())


def publish_epoch(batch: DataFrame, epoch: int, topic: str, publisher: str, fmt: str = "text", **options: str) -> None:
    """Publish the rows of one epoch; a repeated call adds nothing."""
    spark = batch.sparkSession
    entry = f"{topic.rstrip('/')}/_published/{publisher}/{epoch}" if fmt == "text" else f"{options.pop('epoch_log')}/{publisher}/{epoch}"
    if path_exists(spark, entry):
        return
    if fmt == "text":
        staged = f"{topic.rstrip('/')}/_staged/{publisher}/{epoch}"
        if not write_finished(spark, staged):
            to_messages(batch, key=None).write.mode("overwrite").options(**TEXT_OPTIONS).text(staged)
        for name in list_names(spark, staged):
            if name.startswith("part-"):
                move_into(spark, f"{staged}/{name}", f"{topic.rstrip('/')}/{publisher}-{epoch:010d}-{name}")
    else:
        publish(batch, topic, fmt, **options)
    create_exclusively(spark, entry, str(epoch))


def start_publish(rows: DataFrame, topic: str, checkpoint: str, publisher: str = "shipments", fmt: str = "text",
                  processing_time: str | None = None, **options: str) -> StreamingQuery:
    """Start publishing a stream of rows; without ``processing_time`` it ends when all that is there has gone out."""
    if fmt != "text":
        options.setdefault("epoch_log", f"{checkpoint.rstrip('/')}/_published")

    def send(batch: DataFrame, epoch: int) -> None:
        publish_epoch(batch, epoch, topic, publisher, fmt, **options)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(send)
    return (writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)).start()


def publish_available(rows: DataFrame, topic: str, checkpoint: str, **kwargs) -> None:
    """Publish everything there is, then return."""
    query = start_publish(rows, topic, checkpoint, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream publish failed: {query.exception()}")
