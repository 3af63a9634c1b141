"""Operator 11 against a trie built turn by turn."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from parcelwise.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def code(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, code(role, text), role or "", text or ""))
    own = {c: [(r, t) for _, _, _, r, t in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - int(abs(c) % 20 * (1 if c > 0 else -1))
        rebuilt[c] = own.get(donor, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(ids) if len(rebuilt[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(ids), len(path), parent, len(ids), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def odd_rows():
    r = random.Random(5)
    rows = []
    for c in range(-25, 90):
        for t in range(r.choice([1, 1, 2, 3, 5])):
            rows.append((c, t, r.choice(["user", "assistant", None]), r.choice(["", None, "hello there", "a b  c", "é\tx\n"])))
    rows += [(200, t, "user", f"turn {t % 3}") for t in range(60)] + [(221, t, "user", f"turn {t % 3}") for t in range(55)]   # deep
    rows += [(300, None, "user", "first"), (300, -1, "user", "second"), (300, 7, "user", "tie"), (300, 7, "user", "tie"), (300, 7, "user", "eit")]
    rows += [(None, 0, "user", "nobody"), (None, 1, "user", "nobody")]
    rows += [(c, 0, "user", "hi") for c in range(500, 620)]                                                                 # one large group
    rows += [(1000, 0, "ab", "c"), (1001, 0, "a", "bc"), (1002, 0, "user", "long " * 20000)]
    return rows


@pytest.mark.parametrize("group_turns", [1, 30, 4096])
def test_trie_equals_brute_force(spark, group_turns):
    rows = odd_rows()
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    convs = prefix_trie.with_shared_heads(prefix_trie.sequences(table))
    got = Counter(tuple(r) for r in prefix_trie.trie_nodes(convs, group_turns).collect())
    assert got == brute(rows)


def test_empty_table_has_no_node(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0


def test_turnless_conversations_belong_to_the_root(spark):
    rows = [(c, 0, "user", "x") for c in range(21, 39)]                                     # conversation 20 is absent
    got = Counter(tuple(r) for r in prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows) and any(depth == 0 and ends != prefix_trie.NO_ENDS for _, depth, *_, ends in got)


def test_ids_of_one_node_are_digested_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    rows = [(c, b"k" if c % 3 else b"l") for c in range(-50, 400)]
    got = dict(tuple(r) for r in prefix_trie.ends_digests(spark.createDataFrame(rows, "conv_id long, key binary").repartition(6)).collect())
    want = {k: hashlib.sha256(",".join(str(c) for c, x in rows if x == k).encode()).hexdigest() for k in (b"k", b"l")}
    assert {bytes(k): v for k, v in got.items()} == want


def test_internal_names_as_extra_columns(spark):
    names = ["code", "seq", "key", "donor", "h", "head", "depth", "lo", "found", "n_convs", "parent_key"]
    rows = odd_rows()[:60]
    table = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], SCHEMA + ", " + ", ".join(f"`{n}` string" for n in names))
    assert Counter(tuple(r) for r in prefix_trie.conversation_trie(table).collect()) == brute(rows)
