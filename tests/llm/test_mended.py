"""Cases that once went wrong: structured words, clashing column names, long headers."""

import io
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelwise.llm import ngram_join, packing, quality, shingles, suffix_dedup, warc
from tests.llm import cases

OWN_NAMES = ["node", "id", "text_key", "row", "own", "hash", "again", "component", "_id", "_key", "_again", "_node", "_gone", "_spans",
             "gone", "spans", "rest", "copies", "n_bytes", "low_id", "check", "rank", "offset", "skey", "bucket", "start", "spread", "size", "taken"]


def thue_morse(letters: str, n: int = 10) -> str:
    out = letters
    for _ in range(n - 1):
        out += out.translate(str.maketrans(letters, letters[::-1]))
    return out


def test_structured_words_have_different_hashes():
    for n in (6, 10, 13):
        one, two = thue_morse("ab", n), thue_morse("ba", n)
        h = shingles.word_hashes(f"{one} {two}".encode())[1]
        assert len(one) == 2 ** n and h[0] != h[1]


def test_word_hashes_follow_words_alone():
    words = ["a", "b", "ab", "ba", "x" * 63, "x" * 64, "x" * 65, "x" * 200, "y" + "x" * 199, "é", "ab" * 500]
    starts, h = shingles.word_hashes("\t".join(words).encode())
    again = {w: int(shingles.word_hashes(f"  {w}\n".encode())[1][0]) for w in words}
    assert [again[w] for w in words] == h.tolist() and len(set(again.values())) == len(words) == len(starts)
    assert len(shingles.word_hashes(b" \n\t")[0]) == 0 and len(shingles.word_hashes(b"")[1]) == 0
    rng = np.random.default_rng(1)
    many = {bytes(rng.integers(97, 101, rng.integers(1, 90))) for _ in range(20000)}
    assert len(set(shingles.word_hashes(b" ".join(many))[1].tolist())) == len(many)


def test_structured_words_do_not_link(spark):
    rows = [(1, thue_morse("ab")), (2, thue_morse("ba")), (3, thue_morse("ab").upper())]
    got = {tuple(r) for r in ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1, 1), (2, 1, 2), (3, 1, 1)}


def _with_names(spark):
    rows = [(*r[:5], *[f"{k}.{n}" for n in OWN_NAMES]) for k, r in enumerate(cases.rows())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in OWN_NAMES))


def test_operators_keep_columns_that_have_their_names(spark):
    docs, plain = _with_names(spark), cases.documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for run in (ngram_join.keep_one, suffix_dedup.without_repeats):
        got, want = run(docs), run(plain)
        assert got.columns == docs.columns
        assert Counter(tuple(r) for r in got.select(*plain.columns).collect()) == Counter(tuple(r) for r in want.collect())
        for r in got.collect():
            k = r["node"].split(".")[0]
            assert [r[n] for n in OWN_NAMES] == [f"{k}.{n}" for n in OWN_NAMES] and r["doc_id"] == cases.rows()[int(k)][0]


def test_pipeline_stages_take_clashing_names(spark, sf_small):
    docs = _with_names(spark)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        got = stage(spark, docs, sf_small)
        assert got.columns == docs.columns and got.count() > 0, name
        assert got.where(F.col("rank").isNull() | ~F.col("rank").endswith(".rank")).count() == 0, name


class _File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_a_plain_record_with_a_long_header_is_read():
    url = "http://example.org/" + "u" * 70_000
    block = b"HTTP body"
    head = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:00000000-0000-0000-0000-000000000000>\r\nWARC-Target-URI: {url}\r\n"
            f"WARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: {len(block)}\r\n\r\n").encode()
    data = head + block + b"\r\n\r\n"
    window = warc._Window(_File(data + data))
    end, found = warc._plain_record(window, 0)
    assert end == len(data) and url in str(found)
    assert warc._plain_record(window, end)[0] == 2 * len(data)


@pytest.mark.parametrize("kind", [np.uint16, np.uint32, np.uint64])
def test_packed_numbers_come_back(kind):
    r = np.random.default_rng(3)
    for x in (np.zeros(0, kind), np.array([0, np.iinfo(kind).max], kind), r.integers(0, np.iinfo(kind).max, 5000, dtype=kind), np.sort(r.integers(0, 900, 5000, dtype=kind))):
        back = ngram_join.loose(ngram_join.tight(x))
        assert back.dtype == kind and (back == x).all()
    small = np.full(5000, 3, kind)
    assert len(ngram_join.tight(small)) < 100


def test_sets_sent_in_many_pieces_are_merged(spark, monkeypatch):
    """Tiny flushes, many buckets and copies in every task: the links are those of one flush."""
    docs = cases.documents(spark).select("doc_id", "text")
    docs = docs.union(docs.where("doc_id in (1, 3, 10, 14)")).repartition(5)
    want = sorted(map(repr, ngram_join.join_components(docs).collect()))
    monkeypatch.setattr(ngram_join, "FLUSH", 100)
    monkeypatch.setattr(ngram_join, "partitions", lambda spark: 70)  # more buckets than the six bits of an entry tell apart
    assert sorted(map(repr, ngram_join.join_components(docs).collect())) == want


def test_join_bounds_its_arrow_batches(spark, monkeypatch):
    """Whole texts in batches of the session's size are held by the JVM and Python at once."""
    key, real, seen = "spark.sql.execution.arrow.maxBytesPerBatch", ngram_join.stored, {}

    def stored(df, name):
        seen[name] = spark.conf.get(key)
        return real(df, name)

    before = spark.conf.get(key)
    monkeypatch.setattr(ngram_join, "stored", stored)
    ngram_join.keep_one(cases.documents(spark)).collect()
    assert seen["join-signatures"] == seen["join-sets"] == ngram_join.ARROW_BYTES and spark.conf.get(key) == before


def test_rules_are_learned_without_moving_texts(spark, monkeypatch):
    seen, real = {}, quality.stored

    def stored(df, name):
        seen[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(quality, "stored", stored)
    docs = cases.documents(spark)
    quality.keep_good(docs, spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")).collect()
    assert seen and not any("Join" in plan for plan in seen.values())


def test_packing_worker_forgets_between_tasks(monkeypatch):
    """What a worker remembers when its task has ended stays in memory while it waits; ids are the same afterwards."""
    class Frame:
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(packing, "KEPT_RUNS", 5, raising=False)
    monkeypatch.setattr(packing, "KEPT_WORDS", 4, raising=False)
    monkeypatch.setattr(packing, "_tokenizers", {})
    texts = [" ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)), None]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts)], names=["doc_id", "text"])
    run = packing.pack(Frame(), forget=True)
    first = [b.to_pylist() for b in run(iter([batch]))]
    (known,) = packing._tokenizers.values()
    assert len(known.runs) <= 5 and len(known.words) <= 4
    assert [b.to_pylist() for b in run(iter([batch]))] == first and sum(p["length"] for p in first[0]) == first[0][0]["doc_tokens"] + 1


def test_set_keys_travel_once_per_group_of_buckets(spark):
    docs = cases.documents(spark).select("text").coalesce(1)
    buckets = 160
    first = ngram_join._groups(buckets).tolist()
    assert first[0] == 0 and first[-1] == buckets and len(first) == 41 and ngram_join._groups(12).tolist() == list(range(13))
    rows = ngram_join._packed_shingles(docs, "text", 5, buckets).collect()
    assert len(rows) <= 40  # one flush: a row per bucket before
    sets = {int(k) for t in docs.collect() for s in shingles.shingle_sets([shingles.lowered(t["text"])]) if len(s) for k in [ngram_join.set_key(s)]}
    assert {int(k) for r in rows for k in ngram_join._nodes(r["nodes"])} == sets
    for r in rows:
        assert len(r["own"]) == len(r["low"]) == len(r["mid"]) == first[r["part"] + 1] - first[r["part"]]


def test_hub_rounds_go_on_with_the_rows_that_are_apart(spark):
    bits = dict.fromkeys(ngram_join.BITS, 7)
    sets = spark.createDataFrame([dict(node=k, n=9, m=8, weight=float(k), entries=[1], **bits) for k in range(1, 7)])
    at = [(10, 1, 0), (10, 2, 1), (11, 1, 1), (11, 3, 0), (12, 4, 0), (13, 5, 0), (13, 6, 0)]
    rows = spark.createDataFrame([dict(gram=g, node=k, place=p, n=9, m=8, weight=float(k), comp=-1, **bits) for g, k, p in at])
    comps = spark.createDataFrame([(1, 1), (2, 1), (5, 5)], "node long, component long")
    left = ngram_join._still_apart(rows, sets, comps)
    assert set(left.columns) == {"gram", "node", "place", "n", "m", "weight", "comp", *ngram_join.BITS}
    found = sorted((r["gram"], r["node"], r["place"], r["comp"], r["weight"], r["b3"]) for r in left.collect())
    assert found == [(11, 1, 1, 1, 1.0, 7), (11, 3, 0, 3, 3.0, 7), (13, 5, 0, 5, 5.0, 7), (13, 6, 0, 6, 6.0, 7)]


def test_later_hub_rounds_do_not_read_all_rows_again(spark, monkeypatch):
    """The second round starts from what the first has left open."""
    seen, whole = [], ngram_join._still_apart

    def apart(rows, sets, comps):
        seen.append(rows.columns)
        return whole(rows, sets, comps)

    monkeypatch.setattr(ngram_join, "_still_apart", apart)
    # every n-gram of a text is in one of the others, and no two texts link
    x, y, z = (" ".join(f"{c}{i}" for i in range(80)) for c in "xyz")
    texts = [f"{x} {y}", f"{x} {z}", f"{y} {z}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ngram_join.join_components(docs).collect()
    assert len(seen) > 1 and "comp" not in seen[0] and all("comp" in columns for columns in seen[1:])


def test_a_pair_is_weighed_by_what_is_left_of_both_sets(spark):
    """At its first common n-gram a linking pair has enough of both left, at a later one it may be refused."""
    bits = dict.fromkeys([*ngram_join.BITS, *(f"{b}2" for b in ngram_join.BITS)], 0)
    places = [(0, 0), (14, 14), (15, 14), (14, 15), (20, 20), (0, 24)]
    rows = spark.createDataFrame([dict(n=100, n2=100, m=100, m2=100, place=p, place2=q, **bits) for p, q in places])
    left = rows.where(ngram_join._possible(75)).select("place", "place2").collect()
    assert sorted(map(tuple, left)) == [(0, 0), (14, 14)]  # 86 of 100 and 100 are the least that link


def test_outliers_of_a_group_are_not_compared_with_all_of_it(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(240)]

    def edited(words, places, mark):
        return [f"{mark}{i}" if i in places else w for i, w in enumerate(words)]

    texts = [base] + [edited(base, set(rng.choice(240, 3, replace=False).tolist()), f"m{k}x") for k in range(40)]
    for k in range(8):  # about 0.68 of the base, each with a twin, so that its own n-grams are shared too
        far = edited(base, set(range(5 + k, 240, 26)), f"o{k}x")
        texts += [far, edited(far, {3}, f"t{k}x")]
    texts += [edited(base, set(range(9, 240, 34)), "c"), edited(base, {*range(9, 240, 34), 20, 60, 100, 140}, "c")]  # a chain out of the group
    docs = spark.createDataFrame([(k, " ".join(ws)) for k, ws in enumerate(texts)], "doc_id long, text string")

    sets = [{tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} for ws in texts]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    assert 9 <= len(set(root)) < len(texts) - 40

    compared, real = [], ngram_join.stored

    def stored(df, name):
        out = real(df, name)
        if name == "join-pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", stored)
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.join_components(docs).collect()}
    assert found == dict(enumerate(root))
    assert len(compared) == ngram_join.HUB_ROUNDS + 1 and compared[-1] <= len(texts), compared
    near = {(r["a"], r["b"]) for r in ngram_join.similar_pairs(docs).collect()}
    assert len(near) == sum(100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for a in range(len(sets)) for b in range(a))


def test_pairs_within_the_main_component_are_not_met(spark):
    bits = dict.fromkeys(ngram_join.BITS, 0)
    at = [(1, 1, 1, 0), (1, 2, 1, 0), (1, 3, 1, 0), (1, 4, 4, 0), (1, 5, 5, 20), (2, 1, 1, 0), (2, 2, 1, 0), (2, 5, 5, 30)]
    rows = spark.createDataFrame([dict(gram=g, node=k, comp=c, place=p, n=100, m=100, weight=1.0, **bits) for g, k, c, p in at])
    left = ngram_join._within_reach(rows, 75).select("gram", "node", "main").collect()
    assert sorted(map(tuple, left)) == [(1, 1, 1), (1, 2, 1), (1, 3, 1), (1, 4, 1)]
    assert sorted(map(tuple, ngram_join._apart_candidates(rows, 75).collect())) == [(1, 4), (2, 4), (3, 4)]
