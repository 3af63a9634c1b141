"""Shipment rows as JSON messages: publish (batch or stream) and decode.

A message is one UTF-8 JSON object per row holding the raw columns. Times
keep all six fraction digits (Spark's JSON default writes milliseconds).
The sink format is a parameter: ``text`` writes one message per line into
compressed files of a folder that a file stream can follow; ``kafka`` (when its connector is on
the classpath) takes the same ``value`` column plus connection options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise import schema as S

JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
    "ignoreNullFields": "true",
}

# Messages repeat the field names in every line, so a text topic is written compressed; the third level takes hardly longer than the first
# and saves a fifth of its bytes. Readers tell the codec by the files' names. A compressed file is read by one task, so files are bounded.
TEXT_OPTIONS = {"compression": "gzip", "zlib.compress.level": "THREE", "maxRecordsPerFile": "250000"}

# Message fields read as text, so the stream path types them with the same
# ingestion rules as a CSV file; ``ingested_at`` is kept when the publisher set it.
MESSAGE_TEXT_SCHEMA = T.StructType(S.SOURCE_TEXT_SCHEMA.fields + [T.StructField("ingested_at", T.StringType())])


def to_messages(df: DataFrame, key: str | None = "shipment_id") -> DataFrame:
    """Rows -> ``value`` (JSON text) and, when a key column is named, ``key``."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias("value")
    return df.select(F.col(key).alias("key"), value) if key else df.select(value)


def publish(df: DataFrame, topic: str, fmt: str = "text", **options: str) -> None:
    """Publish every row as one message (batch). ``topic`` is a folder for ``text``."""
    if fmt == "text":
        to_messages(df, key=None).write.mode("append").options(**TEXT_OPTIONS).text(topic)
    else:
        to_messages(df).write.format(fmt).mode("append").option("topic", topic).options(**options).save()


def decode(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> text columns (the raw fields) + ``ingested_at`` text.

    The columns leave a generator: a later filter on them (the key check) would
    otherwise be moved below and parse every message again for itself.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), MESSAGE_TEXT_SCHEMA, {"mode": "PERMISSIVE"})
    return messages.select(F.inline(F.array(parsed)))
