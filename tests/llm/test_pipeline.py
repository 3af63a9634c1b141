"""The stages of the pipeline, each on odd rows and on an empty table, and the whole run against its parts."""

import re
from collections import Counter

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from parcelwise.llm import packing, suffix_dedup
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return cases.documents(spark).cache()


def test_stages_keep_the_columns(spark, docs, sf_small):
    for name, stage in P.STAGES:
        for table in (docs, cases.nothing(spark)):
            got = stage(spark, table, sf_small)
            rows = got.collect()
            if name != P.STAGES[-1][0]:
                assert got.columns == table.columns, name
            assert table is docs or not rows, name
            if name == "suffix_array_dedup" and table is docs:
                assert len(rows) == docs.count()
            if name in ("suffix_array_dedup", "curriculum_mixing"):
                assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
            if name not in ("suffix_array_dedup", P.STAGES[-1][0]):
                assert all(r.node == "x" and r["size"] == 1 and r.taken == "y" for r in rows), name


def test_run_is_its_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    kept = P.quality_rules(spark, docs, sf_small).cache()
    one = P.ngram_jaccard_join(spark, kept, sf_small).cache()
    assert {r.doc_id for r in one.collect()} <= {r.doc_id for r in kept.collect()} and 0 < one.count() < kept.count() < docs.count()
    clean = P.suffix_array_dedup(spark, one, sf_small).cache()
    assert clean.count() == one.count()
    left = suffix_dedup.repeat_digests(one).agg(F.sum(F.col("n_bytes") - F.col("n_removed"))).first()[0]
    assert 0 <= sum(len((r.text or "").encode()) for r in clean.collect()) - left <= 8 * one.count()
    mixed = P.curriculum_mixing(spark, clean, sf_small).cache()
    sizes = {r.doc_id: len(WORD.findall(r.text or "")) for r in clean.collect()}
    taken = Counter()
    for r in mixed.collect():
        taken[r.doc_id] += len(WORD.findall(r.text))
        assert r.source == given[r.doc_id].source and r.lang == given[r.doc_id].lang
    assert all(n <= 3 * sizes[k] for k, n in taken.items()) and abs(sum(taken.values()) - sum(sizes.values())) <= 40
    want = packing.pack(mixed).agg(F.sum("length")).first()[0]
    assert P.run(spark, sf_small).agg(F.sum("length")).first()[0] == want
