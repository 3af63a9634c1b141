"""The registered queries of this subpackage: each takes (spark, sf_dir) and applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwise.llm import (
    chat, cover_tree, forest, katz, langid, mixing, ngram_join, packing, prefix_trie, quality, sharding, suffix_dedup, warc)
from parcelwise.llm.common import read_table, stored


def op1_language_id(spark, sf_dir):
    return langid.identify_table(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op2_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.join_components(read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text"))


def op3_quality_rules(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = stored(quality.with_stats(docs).drop("text"), "quality-stats")
    rules = quality.learn_from(stats, read_table(spark, sf_dir, "labels"))
    return quality.apply_rules(stats, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_chat_formatting(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string")
    rows = turns.union(probe).withColumn("parts", chat.text_part(F.col("text")))
    return chat.chat_digests(chat.format_chats(rows))


def op5_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.repeat_digests(read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text"))


def op6_retrieval_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text"))


def op7_katz_scoring(spark, sf_dir):
    return katz.score_table(read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text"))


def op8_warc_salvage(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select(F.col("page_id").cast("long"), "url", "html")
    manifest = warc.write_archives(warc.with_record_types(pages))
    return warc.read_archives(manifest).where("kind = 'record'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_embedding_dedup(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long"), "embedding")
    return forest.near_duplicates(rows)


def op10_curriculum_mixing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixed_words(docs)


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op12_rendezvous_sharding(spark, sf_dir):
    return sharding.shard_digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_hard_negatives(spark, sf_dir):
    return cover_tree.hard_negatives(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_quality_rules": op3_quality_rules,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_retrieval_packing": op6_retrieval_packing,
    "op7_katz_scoring": op7_katz_scoring,
    "op8_warc_salvage": op8_warc_salvage,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_curriculum_mixing": op10_curriculum_mixing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_rendezvous_sharding": op12_rendezvous_sharding,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE_SQL = {
    "op2_ngram_jaccard_join": ngram_join.ORACLE_SQL,
    "op4_chat_formatting": chat.ORACLE_SQL,
    "op8_warc_salvage": warc.ORACLE_SQL,
    "op10_curriculum_mixing": mixing.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
    "op12_rendezvous_sharding": sharding.ORACLE_SQL,
    "op13_hard_negatives": cover_tree.ORACLE_SQL,
}
