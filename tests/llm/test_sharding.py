"""Operator 12 on odd rows and against its own laws."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from parcelwise.llm import sharding
from parcelwise.session import shared_path
from tests.llm import cases


def brute_shard(key, weights):
    text = "n" if key is None else f"k{key}"
    draws = [(math.log((int(hashlib.md5(f"{text}/{s}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13) / w, -s)
             for s, w in enumerate(weights) if w > 0]
    return -max(draws)[1]


def test_digests_of_odd_rows(spark):
    got = sharding.shard_digests(cases.documents(spark)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", brute_shard(i, [1.0] * 8), brute_shard(i, [1.0] * 9))
                   for i, t, *_ in cases.rows())
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_digests(cases.nothing(spark)).count() == 0


def test_a_new_shard_takes_rows_only_into_itself_and_weights_hold(spark):
    rows = spark.range(20000).withColumnRenamed("id", "doc_id")
    got = sharding.shard_rows(rows, (1.0, 2.0, 1.0), (1.0, 2.0, 1.0, 1.0)).collect()
    moved = [r for r in got if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {3} and abs(len(moved) / 20000 - 1 / 5) < 0.02
    share = Counter(r.shard for r in got)
    assert abs(share[1] / 20000 - 0.5) < 0.02 and abs(share[0] / 20000 - 0.25) < 0.02
    heavier = {r.doc_id: r.shard for r in sharding.shard_rows(rows, (1.0, 3.0, 1.0)).collect()}
    assert {heavier[r.doc_id] for r in got if heavier[r.doc_id] != r.shard} == {1}
    none = {r.shard for r in sharding.shard_rows(rows, (1.0, 0.0, 1.0)).collect()}
    assert none == {0, 2}


def test_shard_depends_on_the_key_alone(spark):
    rows = [(k, f"text {k}") for k in range(300)]
    one = {r.doc_id: r.shard for r in sharding.shard_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    some = spark.createDataFrame([(k, "another") for k, _ in rows[::-3]], "doc_id long, text string").repartition(7)
    assert all(one[r.doc_id] == r.shard for r in sharding.shard_digests(some).collect())


def test_a_key_on_a_third_of_the_rows_is_cut_over_partitions(spark):
    rows = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    got = sharding.shard_digests(rows)
    hot = got.where("doc_id = 7").select("shard", "slot").collect()
    assert len({r.shard for r in hot}) == 1 and len({r.slot for r in hot}) == len(hot) >= 10000
    ends = got.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("top"), F.min("slot").alias("low")).collect()
    assert all(r.low == 0 and r.top == r.n - 1 for r in ends)


def test_internal_names_as_extra_columns(spark):
    names = ["row", "spread", "key", "by0", "by1", "tie", "part", "at", "n", "first", "shift", "shard", "slot", "grown_shard", "score", "minus"]
    rows = spark.createDataFrame([(1, "a", *[f"v{i}" for i in range(len(names))]), (2, None, *["w"] * len(names))],
                                 "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    got = {r["doc_id"]: r for r in sharding.shard_rows(rows, by=("text", "at")).collect()}
    kept = [n for n in names if n not in sharding.ADDED]
    assert all(got[1][n] == f"v{names.index(n)}" and got[2][n] == "w" for n in kept) and got[1]["text"] == "a"
    assert [got[k]["shard"] for k in (1, 2)] == [brute_shard(k, [1.0] * 8) for k in (1, 2)]


def test_written_shards_hold_their_rows(spark):
    path = shared_path(spark, "t_shards")
    sharding.write_shards(cases.documents(spark).select("doc_id", "text"), path)
    back = spark.read.parquet(path).collect()
    assert Counter((r.doc_id, r.text, r.shard) for r in back) == Counter((i, t, brute_shard(i, [1.0] * 8)) for i, t, *_ in cases.rows())
