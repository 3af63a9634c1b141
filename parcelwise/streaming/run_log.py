"""Run log of a streaming ingest: one row per batch, from metrics that Spark observes while the batch runs.

Counts and totals are ``observe``d on the batch's own plan, so nothing is read
twice. A listener takes them from the batch's progress event and makes one
small file per batch in the log folder, under the query's name and batch id; a
file that is there already stays, so a batch that is run again after a failure
has one row. The event comes after the batch is committed: a driver that is
lost in between leaves a batch without a row, which ``unlogged_batches`` finds.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from parcelwise import schema as S
from parcelwise.session import create_exclusively, list_names
from parcelwise.streaming.ingest_stream import subscribe, typed_events

#: How long to wait for the last events of a query that has ended.
SETTLE_SECONDS = 60
LOG_SCHEMA = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("batch_id", T.LongType()), T.StructField("source_rows", T.LongType()),
    T.StructField("landed_rows", T.LongType()), T.StructField("undated_rows", T.LongType()), T.StructField("total_cost", T.DoubleType()),
    T.StructField("first_date", T.DateType()), T.StructField("last_date", T.DateType()),
])


class BatchLog(StreamingQueryListener):
    """Writes the observed metrics of the batches of one named query below ``path``."""

    def __init__(self, spark: SparkSession, path: str, name: str) -> None:
        self.spark, self.folder, self.name = spark, f"{path.rstrip('/')}/{name}", name
        self.ended, self.run, self.failure = threading.Event(), None, None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name or "landed" not in p.observedMetrics:  # an idle trigger runs no batch
            return
        landed = p.observedMetrics["landed"].asDict()
        row = {"query": self.name, "batch_id": p.batchId, "source_rows": p.observedMetrics["source"]["source_rows"],
               **{k: v.isoformat() if hasattr(v, "isoformat") else v for k, v in landed.items()}}
        try:
            create_exclusively(self.spark, f"{self.folder}/{p.batchId}.json", json.dumps(row))
        except Exception as exc:  # raised again by the caller: a listener's own errors are only logged by Spark
            self.failure = exc

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.ended.set()


def watched_events(messages: DataFrame) -> DataFrame:
    """Typed events of a stream of messages, with the metrics of the log observed before and after the key check."""
    read = messages.observe("source", F.count(F.lit(1)).alias("source_rows"))
    return typed_events(read).observe(
        "landed", F.count(F.lit(1)).alias("landed_rows"), F.count_if(F.col("shipment_date").isNull()).alias("undated_rows"),
        F.sum("cost_of_product").alias("total_cost"), F.min("shipment_date").alias("first_date"), F.max("shipment_date").alias("last_date"))


def ingest_logged(spark: SparkSession, topic: str, sink: str, checkpoint: str, log: str, name: str = "shipments",
                  fmt: str = "text", max_files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Land everything available in ``sink`` (Parquet, append) with a log row per batch; returns the log."""
    events = watched_events(subscribe(spark, topic, fmt, max_files_per_trigger, **options))
    listener = BatchLog(spark, log, name)
    spark.streams.addListener(listener)
    try:
        query = (events.writeStream.queryName(name).outputMode("append").format("parquet").option("path", sink)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        if not listener.ended.wait(SETTLE_SECONDS):
            raise RuntimeError(f"no end event of {name} within {SETTLE_SECONDS} s: the log may lack its last batches")
    finally:
        spark.streams.removeListener(listener)
    if listener.failure is not None:
        raise RuntimeError(f"the run log of {name} could not be written") from listener.failure
    return read_log(spark, log)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The rows of all queries that log below ``log``."""
    if not any(list_names(spark, f"{log.rstrip('/')}/{name}") for name in list_names(spark, log)):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).json(f"{log.rstrip('/')}/*")


def unlogged_batches(spark: SparkSession, checkpoint: str, log: str, name: str = "shipments") -> list[int]:
    """Batches that the checkpoint has committed and the log lacks."""
    done = {int(n) for n in list_names(spark, f"{checkpoint.rstrip('/')}/commits") if n.isdigit()}
    return sorted(done - {int(n.removesuffix(".json")) for n in list_names(spark, f"{log.rstrip('/')}/{name}") if n.endswith(".json")})
