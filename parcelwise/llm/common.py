"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.session import shared_path, table_path

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, which the cluster sizes to its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextlib.contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Arrow batches of about ``size`` bytes for the jobs run inside; a batch is otherwise bounded by its rows.

    A batch is held by the executor's JVM (off the heap, in buffers that double
    as they grow) and by its Python worker at the same time, so rows of many
    kilobytes make batches that count several times.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def words(text: Column) -> Column:
    """Words of a text in order; null gives an empty array."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def give_back() -> None:
    """Return freed memory of this Python worker to the system (idle workers keep what they once used)."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it by name in ``body`` (a function of the bound column).

    The optimizer may copy a projected column into every place that reads it,
    also into a lambda that runs once per element; a lambda variable is not copied.
    """
    return F.transform(F.array(value), body)[0]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node for every node of ``edges`` (columns a, b): rows (node, component).

    Alternating large-star and small-star rounds: every node hands its
    neighbours the smallest node it knows of, until no edge changes. A round
    is two aggregations with partial sums per task and two equi-joins, so a
    node with very many neighbours is split by the skew-join handling; no
    component is gathered in one place. Each round is stored, so a lost
    executor costs at most one round.
    """
    spark = edges.sparkSession
    kind = edges.schema["a"].dataType
    current = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "components",
    )
    seen = None
    for _ in range(max_rounds):
        # large star: neighbours above a node move to its smallest neighbour (or itself)
        both = current.select("u", "v").union(current.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: a node and its smaller neighbours all move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        current = stored(small, "components")
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or not state["n"]:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    pairs = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.union(roots).select(F.col("node").cast(kind), F.col("component").cast(kind))
