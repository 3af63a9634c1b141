"""A training corpus from raw documents: five stages, each written as Parquet and read again as the next one's input.

1. quality rules drop documents that the base rule or the learned list rejects;
2. the n-gram Jaccard join leaves one document of each group of near copies;
3. suffix-array dedup removes passages that occur again, within or across documents;
4. mixing repeats or drops documents so that every source meets its target, in training order;
5. packing fills windows of tokens; its rows are pieces of documents.

Every function takes (spark, docs, sf_dir). Stages 1 to 4 return the columns
of ``documents``; a null in any column, an empty table and repeated rows pass
through by the rules of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import mixing, ngram_join, packing, quality, suffix_dedup
from parcelwise.llm.common import read_table, stored


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of texts that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(suffix_dedup.without_repeats(docs))


def curriculum_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the other columns travel in one field, as their names may be the operator's own
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_row")
    mixed = mixing.training_order(docs.select("doc_id", "text", "source", rest))
    return _counted(mixed.select(*["text" if c == "text" else f"_row.`{c}`" for c in docs.columns]))


def retrieval_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, forget=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("curriculum_mixing", curriculum_mixing),
    ("retrieval_packing", retrieval_packing),
]

#: The learned list of the first stage is not expressible in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
