"""Every operator on odd rows and an empty table, against brute force."""

import base64
import hashlib
import io
import math
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelwise.llm import chat, forest, katz, langid, mixing, ngram_join, packing, quality, queries, suffix_dedup, warc
from parcelwise.llm.common import connected_components
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return cases.documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return cases.nothing(spark)


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_components(spark):
    edges = [(5, 4), (4, 3), (10, 11), (3, 9), (7, 7), (20, 21), (21, 22), (22, 20), (None, 1)] + [(100, k) for k in range(101, 180)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {3: 3, 4: 3, 5: 3, 9: 3, 10: 10, 11: 10, 20: 20, 21: 20, 22: 20} | {k: 100 for k in range(100, 180)}
    assert got == want


# 1 ---------------------------------------------------------------- language id

def test_language_id_odd_rows(docs, empty):
    got = langid.identify_table(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.lang_pred in ("a", "b", "und")
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    by_id = {r.doc_id: r for r in got if r.doc_id not in (None, 4)}
    assert [by_id[k].lang_pred for k in (5, 6, 7, -3)] == ["und"] * 4 and by_id[5].score == 0 and not by_id[5].accepted
    assert by_id[8].lang_pred != "und"
    assert langid.identify_table(empty).count() == 0


def test_language_id_without_labels_is_und(docs):
    got = langid.identify_table(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in got} == {"und"}


def test_language_id_held_out_accuracy(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = langid.identify_table(table.select("doc_id", "text", "lang")).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20 and np.mean([r.lang == r.lang_pred for r in got]) > 0.95


def test_language_id_one_labelled_row(spark):
    rows = [(k, "the cat sat on the mat", "x" if k == 0 else None) for k in range(3)]
    assert not zlib.crc32(b"0") % 4 == 2
    script = "from parcelwise.llm import langid; m = langid.train([('the cat sat on the mat', 'x')]); print(langid.predict(['the mat'], m)[0])"
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=60)  # it once never ended
    assert out.stdout.split() == ["['x']"], out.stderr
    got = langid.identify_table(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert [r.lang_pred for r in got] == ["x"] * 3


def test_language_id_keeps_columns(docs):
    model = langid.train([("the cat sat on the mat", "x"), ("le chat noir dort", "y")] * 10)
    got = langid.identify(docs, model)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score", "accepted"]
    assert langid.predict(["the mat", "chat noir"], model)[0] == ["x", "y"]


# 2 ---------------------------------------------------------------- n-gram join

def shingles(text):
    ws = WORD.findall(lower(text))
    return {tuple(ws[k:k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()


def join_brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    out = []
    for members in groups.values():
        ids = [rows[k][0] for k in members if rows[k][0] is not None]
        out += [(rows[k][0], len(sets[k]), min(ids) if ids else None) for k in members]
    return out, len(groups)


def near_copies(n, seed=0):
    r = random.Random(seed)
    rows, at = [], 1000
    for g in range(n):
        words = cases.prose(100 + g, r.choice([6, 20, 60, 150])).split()
        for _ in range(r.randint(1, 7)):
            copy = list(words)
            for _ in range(r.randint(0, max(1, len(copy) // 25))):
                copy[r.randrange(len(copy))] = f"w{r.randrange(99)}"
            rows.append((at, " ".join(copy[: r.randint(max(1, len(copy) - 6), len(copy))])))
            at += 1
    return rows


def test_join_odd_rows_and_near_copies(spark, docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + near_copies(40)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, groups = join_brute(rows)
    assert bag(ngram_join.join_components(table).collect()) == Counter(want)
    kept = ngram_join.keep_one(table).collect()
    no_words = sum(not shingles(t) for _, t in rows)
    assert len(kept) == groups and sum(not shingles(r.text) for r in kept) == no_words
    assert ngram_join.join_components(empty).count() == 0 and ngram_join.keep_one(empty).columns == empty.columns


def test_join_all_pairs(spark):
    rows = near_copies(30, seed=5)
    sets = {frozenset(shingles(t)) for _, t in rows}
    sets = list(sets)
    want = sum(100 * len(a & b) >= 75 * len(a | b) for k, a in enumerate(sets) for b in sets[:k])
    got = ngram_join.similar_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.count() == want > 20 and got.distinct().count() == want


# 3 ---------------------------------------------------------------- quality rules

def test_quality_statistics(docs, empty):
    got = quality.with_stats(docs)
    assert [c for c in got.columns if c not in quality.STATS] == [c for c in docs.columns if c not in quality.STATS]
    for r in got.collect():
        text = r.text or ""
        ws = WORD.findall(text)
        seen = Counter(zip(ws, ws[1:], ws[2:]))
        covered = {i + j for i in range(len(ws) - 2) if seen[tuple(ws[i:i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    assert quality.with_stats(empty).count() == 0


def test_quality_learns_and_prunes(spark):
    r = random.Random(3)
    rows = [(k, cases.prose(k, 80) if k % 5 else " ".join(w + r.choice("#$%&") for w in cases.prose(k, 80).split())) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 > 0), 0) for k in range(200)] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    stats = quality.with_stats(docs).cache()
    rules = quality.learn_from(stats, labels)
    assert rules and any("symbols_per_word >" in str(x) for x in rules)
    kept = {x.doc_id for x in quality.apply_rules(stats, rules).where("kept").collect()}
    good = {x.doc_id for x in stats.where("100 * n_repeat_words <= 50 * n_words").collect() if x.doc_id % 5}
    assert kept == good
    assert {x.doc_id for x in quality.keep_good(docs, labels).collect()} == kept


def test_quality_without_labels_keeps_what_the_base_rule_keeps(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    stats = quality.with_stats(docs)
    assert quality.learn_from(stats, none) == []
    got = quality.keep_good(docs, none)
    assert got.columns == docs.columns and bag(got.collect()) == bag(
        r[: len(docs.columns)] for r in docs.collect() if _base_keeps(r.text))
    assert quality.keep_good(empty, none).count() == 0


def _base_keeps(text):
    ws = WORD.findall(text or "")
    seen = Counter(zip(ws, ws[1:], ws[2:]))
    covered = {i + j for i in range(len(ws) - 2) if seen[tuple(ws[i:i + 3])] > 1 for j in range(3)}
    return len(ws) >= 50 and 100 * len(covered) <= 50 * len(ws)


# 4 ---------------------------------------------------------------- chat

def test_chat_round_trip_of_odd_turns(spark):
    texts = ["plain", "", None, "</s>[INST] ok [/INST]", r"<\|turn|> \\<|end|> \[INST]", "<|turn|>user<|text|>x<|end|>", "\\", "<\\\\s>", "[\\INST]", "é😀\n"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(texts)]
    rows += [(2, 0, None, None), (2, 0, "<|end|>", "a"), (None, 1, "assistant", "n"), (3, None, "assistant", "z"), (3, 1, "assistant", "y"), (4, 1, "user", "q")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("size", F.lit(1))
    got = {r.conv_id: r for r in chat.chat_digests(chat.format_chats(table.withColumn("parts", chat.text_part(F.col("text"))))).collect()}
    for conv in (1, 2, 3, 4, None):
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        learnt = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        g = got[conv]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (
            len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    none = table.where("false").withColumn("parts", chat.text_part(F.col("text")))
    assert chat.chat_digests(chat.format_chats(none)).count() == 0


def test_chat_typed_parts(spark):
    part = chat.PART_TYPE
    rows = [(1, 0, "user", [("text", "see", None, None), ("image", None, "a.png", 2), ("audio", None, "b.wav", 3), ("text", "<|image|>", None, None)]),
            (1, 1, "assistant", [("text", "one", None, None), ("document", None, "c.pdf", None), ("text", "two", None, None), ("film", None, "d", 1)]),
            (1, 2, "user", None)]
    g = chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")).first()
    assert [(a.type, a.ref, a.tokens) for a in g.attachments] == [("image", "a.png", 512), ("audio", "b.wav", 150), ("document", "c.pdf", 800), ("document", "d", 800)]
    assert re.findall(r"<\|(image|audio|document)\|>", g.formatted) == ["image", "audio", "document", "document"]
    assert g.expanded_tokens == 512 + 150 + 1600
    at, learnt = 0, []
    for m in g.loss_mask:
        learnt.append(g.formatted[at + m.skip: at + m.skip + m.learn])
        at += m.skip + m.learn
    assert at == len(g.formatted) and "".join(learnt) == "onetwo"


# 5 ---------------------------------------------------------------- suffix-array dedup

def repeats_brute(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k:k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for k in range(len(d) - length + 1):
            if seen[d[k:k + length]] > 1:
                gone[k:k + length] = True
        left = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(left).hexdigest()))
    return out


def repeating(seed):
    """Texts that share cuts of one another at every length around the limit, and repeat themselves."""
    r = random.Random(seed)
    base = cases.prose(seed, 400)
    out = []
    for _ in range(40):
        parts = [cases.prose(r.randrange(10**6), r.randint(5, 40))]
        for _ in range(r.randint(1, 4)):
            a = r.randrange(len(base) - 400)
            parts.append(base[a:a + r.randint(150, 330)])
            parts.append(cases.prose(r.randrange(10**6), r.randint(1, 30)))
        out.append("".join(parts))
    return out + ["ab" * 300, "q" * 199, "q" * 200, "z" * 201, "y" * 400]


@pytest.mark.parametrize("seed,chunk", [(1, None), (2, 3)])
def test_suffix_dedup(spark, docs, empty, monkeypatch, seed, chunk):
    if chunk:  # collections above it take the exact way for large ones
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
        monkeypatch.setattr(suffix_dedup, "FREQUENT", 3)
    texts = [r.text for r in docs.collect() if r.text is None or len(r.text) < 5000] + repeating(seed)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.repeat_digests(table).collect()}
    assert [got[k] for k in range(len(texts))] == repeats_brute(texts)
    if not chunk:
        assert suffix_dedup.repeat_digests(empty).count() == 0


def test_suffix_dedup_texts(docs):
    got = suffix_dedup.without_repeats(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    texts = {r.doc_id: r.text for r in got.collect() if r.doc_id not in (4, None)}
    assert texts[1] == texts[2] == "" and texts[5] is None and texts[12].startswith("é" * 0 + cases.prose(7, 60)[:5])
    passage = cases.prose(2, 70)
    assert passage not in texts[10] and passage not in texts[11] and texts[8] == "one two"


def test_collection_orders_suffixes():
    r = np.random.default_rng(0)
    strings = r.integers(0, 2, (60, 12)).astype(np.int16)
    groups = np.sort(r.integers(0, 4, 60))
    c = suffix_dedup.Collection(groups)
    for d in range(11, -1, -1):
        c.insert(strings[:, d])
        suffix = [(groups[k], *strings[k, d:]) for k in c.order]
        assert suffix == sorted(suffix)
        for i in range(1, 60):
            same = groups[c.order[i]] == groups[c.order[i - 1]]
            common = next((j for j, (x, y) in enumerate(zip(strings[c.order[i - 1], d:], strings[c.order[i], d:], strict=True)) if x != y), 12 - d)
            assert c.lcp[i] == (common if same else 0)


# 6 ---------------------------------------------------------------- packing

def test_packing_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(packing.default_vocabulary())
    table = docs.withColumn("doc_id", F.monotonically_increasing_id()).cache()
    want = {r.doc_id: [*encode.encode(r.text or "", add_special_tokens=False).ids, 1] for r in table.collect()}
    rows = packing.pack(table, with_ids=True, shard_tokens=30_000).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.length == len(r.ids) > 0 and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    for k, ids in want.items():
        parts = sorted(by_doc[k], key=lambda r: r.start)
        assert [r.start for r in parts] == list(np.cumsum([0] + [r.length for r in parts])[:-1]) and sum((list(r.ids) for r in parts), []) == ids
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == list(np.cumsum([0] + [r.length for r in parts])[:-1])
        total = sum(r.length for r in parts)
        assert total == packing.WINDOW or total & (total - 1) == 0
    assert packing.pack(empty).count() == 0


def test_packing_prefers_lexical_neighbours():
    r = np.random.default_rng(1)
    topics = [r.integers(100 + 300 * t, 400 + 300 * t, (12, 500)).astype(np.uint16) for t in range(4)]
    docs = [d for k in range(12) for d in (t[k] for t in topics)]
    windows = packing.pack_shard(docs, 2000)
    pure = sum(len({k % 4 for k, _, _ in w}) == 1 for w in windows)
    assert pure == len(windows) == 12


def test_packing_takes_filler_only_without_neighbours():
    r = np.random.default_rng(2)
    # 70 short documents a topic, each with a topic word: more neighbours than are handed out at once
    docs = [np.append(np.append(r.integers(1000 * t + 1000, 1000 * t + 1900, 29), 10 + t), packing.END_ID).astype(np.uint16)
            for _ in range(70) for t in range(4)]
    windows = packing.pack_shard(docs, 31 * 70)
    assert [len({k % 4 for k, _, _ in w}) for w in windows] == [1] * 4
    # the seed's rarest terms lead to few documents, its further terms to the others
    pairs = [np.array([100 + k, packing.END_ID]) for k in range(30)]
    same = [np.array([7, 50_000 - k, packing.END_ID]) for k in range(40)]
    other = [np.array([8, 40_000 - k, 40_100 - k, packing.END_ID]) for k in range(40)]
    docs = [d.astype(np.uint16) for d in (*other, np.array([*range(100, 130), 7, packing.END_ID]), *pairs, *same)]
    window = packing.pack_shard(docs, 32 + 2 * 30 + 3 * 40)[0]
    assert sorted(k for k, _, _ in window) == list(range(40, 111))


# 7 ---------------------------------------------------------------- Katz

def test_katz_counts_and_base(docs, empty):
    rows = docs.collect()
    got = bag((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in katz.score_table(docs).collect())
    held = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in rows]
    tokens = [[*WORD.findall(lower(r.text)), None] for r in rows]
    c = Counter(x for h, ts in zip(held, tokens, strict=True) if not h for x in ts)
    n, v = sum(c.values()), len(c)
    want = bag((r.doc_id, h, len(ts), sum(c[x] > 0 for x in ts), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in ts), 5))
               for r, h, ts in zip(rows, held, tokens, strict=True))
    assert got == want
    assert katz.score_table(empty).count() == 0


def test_katz_sums_to_one_and_beats_base(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    training = docs.where(~katz.held_out("doc_id"))
    frequent = katz.frequent_words(training, "text")
    types = katz.count_types(training, "text", frequent, 8)
    m = katz.fit(types, frequent)
    pairs, rare = {}, {}
    for r in types.collect():
        width = np.uint32 if r.kind == katz.PAIR_TYPES else np.uint64
        (pairs if r.kind == katz.PAIR_TYPES else rare).update(zip(np.frombuffer(r.a, width).tolist(), np.frombuffer(r.b, np.int64).tolist(), strict=True))
    used = np.flatnonzero(np.isfinite(m.uni))
    assert abs((10 ** m.uni[used]).sum() - 1) < 1e-9
    by_context = defaultdict(dict)
    for p, n in pairs.items():
        by_context[p >> 16][p & 0xFFFF] = n
    for context in sorted(by_context, key=lambda k: -len(by_context[k]))[:40] + [60_001, katz.START]:
        seen = by_context.get(context, {})
        pair = (np.uint32(context) << np.uint32(16)) | used.astype(np.uint32)
        n = np.array([seen.get(int(k), 0) for k in used])
        p = 10 ** m.backed_off(pair)
        if seen:
            p[n > 0] = 10 ** m.seen(pair[n > 0], n[n > 0])
        assert abs(p.sum() - 1) < 1e-9
    by_class = defaultdict(float)
    for h, n in rare.items():
        by_class[1 + katz.VOCABULARY + h % katz.RARE] += 10 ** m.known(np.array([h], np.uint64), np.array([n]))[0]
    for k, p in by_class.items():
        assert abs(p + 10 ** m.unknown[k] - 1) < 1e-9
    got = katz.score_table(docs).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got) and all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_katz_ranks_words_on_all_training_texts(spark, monkeypatch):
    texts = [" ".join(f"w{j}" for j in range(k % 50 + 1)) + f" only{k}" for k in range(200)] + ["third " * 3] * 100 + [None, ""]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    count = Counter(x for t in texts for x in WORD.findall(t or ""))
    name = {int(katz.word_hashes(w.encode())[1][0]): w for w in count}
    assert sorted(name[int(h)] for h in katz.frequent_words(docs, "text")) == sorted(count)  # all of them fit
    for most in (1, 20, 51, 100):
        monkeypatch.setattr(katz, "VOCABULARY", most)
        got = katz.frequent_words(docs, "text")
        assert len(set(got.tolist())) == len(got) == most and (np.diff(got.astype(float)) > 0).all()
        assert sorted((count[name[int(h)]] for h in got), reverse=True) == sorted(count.values(), reverse=True)[:most]
        assert (got == katz.frequent_words(docs.repartition(3), "text")).all()


def test_katz_counts_beyond_32_bits(spark, monkeypatch):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["a b c"] * 3 + ["b b"])], "doc_id long, text string").coalesce(1)
    frequent = katz.frequent_words(docs, "text")
    types = katz.count_types(docs, "text", frequent, 2)
    model, real = katz.fit(types, frequent), katz.token_classes

    def long_texts(texts, frequent):
        *parts, tokens = real(texts, frequent)
        return *parts, tokens + 5_000_000_000

    monkeypatch.setattr(katz, "token_classes", long_texts)
    got = katz.score_texts(docs, "text", types, model, 2).collect()
    assert sorted(r.n_tokens // r.sent for r in got) == [5_000_000_003, 5_000_000_004]


# 8 ---------------------------------------------------------------- WARC

def test_warc_round_trip(spark):
    html = ["<p>é</p>", "", None, "<p>é</p>", "x" * 3_000_000, "<p>é</p>", "\r\n\r\nWARC/1.1\r\n", "\x1f\x8b\x08"]
    rows = [(k, None if k == 3 else f"http://h/{k}\r\nX: 1 é", t) for k, t in enumerate(html)] + [(None, "u", "only"), (None, "u", "x" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).repartition(3)
    for compress in (True, False):
        got = warc.read_archives(warc.write_archives(warc.with_record_types(pages), compress=compress, roll_bytes=1000)).collect()
        assert {r.kind for r in got} == {"record"} and len(got) == len(rows)
        payload = {r.page_id: (r.payload or b"").decode() for r in got if r.record_type == "response" and r.page_id is not None}
        first = {}
        for k, t in enumerate(html):
            first.setdefault(t or "", k)
        assert payload == {k: t for t, k in first.items()}
        for r in got:
            if r.page_id is not None:
                t = (html[r.page_id] or "").encode()
                assert (r.payload_bytes, r.payload_digest) == (len(t), base64.b32encode(hashlib.sha1(t).digest()).decode())
                revisit = first[t.decode()] != r.page_id
                assert (r.record_type, r.refers_to) == (("revisit", first[t.decode()]) if revisit else ("response", None))
    small = warc.with_record_types(pages, min_payload=100).where("record_type = 'revisit'").collect()
    assert [r.page_id for r in small] == [None]
    assert warc.read_archives(warc.write_archives(warc.with_record_types(pages.where("false")))).count() == 0


@pytest.mark.parametrize("compress", [True, False])
def test_warc_salvage(compress):
    r = random.Random(4)
    records = [warc.record_bytes(k, f"http://h/{k}", t, base64.b32encode(hashlib.sha1(t).digest()).decode(), "response", None, "2024-01-01T00:00:00Z")
               for k, t in ((k, bytes(r.randrange(256) for _ in range(r.randint(0, 4000)))) for k in range(12))]
    parts = [warc.member(x) if compress else x for x in records]
    for damage in ("flip", "cut", "insert", "length"):
        blobs = [bytearray(p) for p in parts]
        bad = {3, 7}
        for k in bad:
            if damage == "flip":
                blobs[k][len(blobs[k]) // 2] ^= 0xFF
            elif damage == "cut":
                del blobs[k][len(blobs[k]) // 2:]
            elif damage == "insert":
                blobs[k] = blobs[k] + bytearray(b"garbage \x1f\x8b\x08 WARC/1. more")
            else:
                broken = re.sub(rb"Content-Length: \d+", b"Content-Length: 99999999999", records[k], count=1)
                blobs[k] = bytearray(warc.member(broken) if compress else broken)
        data = b"".join(blobs)
        found = list(warc.salvage(pa.BufferReader(data)))
        ids = [x[4][2] for x in found if x[0] == "record"]
        lost = bad if damage != "insert" else set()
        assert ids == [k for k in range(12) if k not in lost], damage
        spans = sorted((x[1], x[2]) for x in found)
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and sum(spans[-1]) == len(data)
        assert sum(x[0] == "gap" for x in found) == 2
    assert list(warc.salvage(pa.BufferReader(b""))) == [] and io.BytesIO


# 9 ---------------------------------------------------------------- embeddings

def vectors(seed=0, n=1500, d=24):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, d))
    for k in range(n // 3, n):  # near and exact copies
        x[k] = x[r.integers(0, n // 3)] + r.standard_normal(d) * r.choice([0, 0.05, 0.15, 0.3])
    return x.astype(np.float32)


def links_brute(x, threshold=0.95):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    return near


@pytest.mark.parametrize("block", [400, 60])
def test_forest_recall(spark, monkeypatch, block):
    monkeypatch.setattr(forest, "SAMPLE", 500)
    x = vectors()
    near = links_brute(x)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    got = {r.vec_id: r for r in forest.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), block=block).collect()}
    found = sum(r.n_links for r in got.values())
    assert found >= 0.9 * near.sum() and all(got[k].n_links <= near[k].sum() for k in range(len(x)))
    for k in range(len(x)):
        assert got[k].component_id <= k and got[k].kept == (got[k].component_id == k) and got[got[k].component_id].kept


def test_forest_odd_rows(spark):
    one, inf = [1.0, 0.0], float("inf")
    rows = [(1, one), (2, [2.0, 0.0]), (3, one), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [1.0, inf]), (9, [float("nan"), 1.0]),
            (10, [1.0, 0.0, 0.0]), (None, one), (12, [0.0, -1.0]), (12, [-0.0, -1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit(1)).withColumn("label", F.lit("x"))
    got = bag(forest.near_duplicates(table).collect())
    assert got == Counter([(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (None, 3, 1, False), (12, 1, 12, True), (12, 1, 12, True)]
                          + [(k, 0, k, True) for k in (4, 5, 6, 7, 8, 9, 10)])
    assert forest.near_duplicates(table.where("false")).count() == 0


# 10 --------------------------------------------------------------- mixing

def test_mixing(docs, empty):
    got = mixing.plan_mix(docs).select(*mixing.plan_columns(docs)).collect()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, free, left = {}, set(order), sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        capped = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not capped:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: 3 * sizes[s] for s in capped}
        left -= sum(3 * sizes[s] for s in capped)
        free -= capped
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.size == len(WORD.findall(r.text or "")) and 0 <= r.taken <= 3 * r.size
        assert (r.first_position is None) == (r.taken == 0) and (r.taken == 0 or 0 <= r.first_position <= 1)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)
    assert bag(got) == bag(mixing.plan_mix(docs.repartition(5)).select(*mixing.plan_columns(docs)).collect())
    assert mixing.plan_mix(empty).count() == 0


def test_mixing_training_order(docs, empty):
    plan = bag((r.doc_id, r.text, r.source, r.taken) for r in mixing.plan_mix(docs).collect())
    rows = mixing.training_order(docs).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    words = sum(len(WORD.findall(r.text)) for r in rows)
    assert words == sum(k[3] * n for k, n in plan.items())
    assert mixing.training_order(empty).count() == 0 and mixing.training_order(empty).columns == [c for c in docs.columns if c not in mixing.ADDED] + ["copy", "position"]


def test_mixing_query_counts_the_mixed_corpus(spark, docs, empty, sf_small, monkeypatch):
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    assert bag(mixing.mixed_words(docs).collect()) == bag(mixing.plan_mix(docs).select(*columns).collect())
    assert mixing.mixed_words(empty).count() == 0 and mixing.mixed_words(empty).columns == columns
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = bag(mixing.plan_mix(table).select(*columns).collect())
    assert bag(queries.op10_curriculum_mixing(spark, sf_small).collect()) == want
    real = mixing.training_order
    monkeypatch.setattr(mixing, "training_order", lambda *a, **b: real(*a, **b).where("copy = 0"))
    first = bag((*r[:4], min(r[1], r[4])) for r in want.elements())
    assert bag(queries.op10_curriculum_mixing(spark, sf_small).collect()) == first != want


def test_mixing_inverse_of_the_schedules(spark):
    shares = [k / 50 for k in range(51)]
    rows = spark.createDataFrame([(s, k) for s in shares for k in range(3)], "s double, k int")
    for r in rows.withColumn("t", mixing.position(F.col("s"), F.col("k"))).collect():
        knots = mixing.SCHEDULES[r.k]

        def area(t, knots=knots):
            out = 0.0
            for (t0, a), (t1, b) in zip(knots, knots[1:], strict=False):
                x = min(max(t - t0, 0), t1 - t0)
                out += a * x + (b - a) / (t1 - t0) * x * x / 2
            return out

        assert abs(area(r.t) / area(1.0) - r.s) < 1e-9
