"""Prefix trie of conversations by truncation peeling (operator 11).

A node is a distinct sequence of first turns. Conversations are reduced to
their turns' SHA-256 digests and word counts, 40 bytes a turn, and equal ones
to one row. The trie is then peeled from its deepest level: the conversations
that end at a level are merged with the nodes that survived from below, each
merged group is a node and is finished there and then (members, children,
leaves, tokens that sharing saves), its last turn is stripped, and the shorter
sequences are grouped again one level up. No node is built before its subtree
is known, and none is visited twice.

A level is one grouping with partial sums per task, so a first turn that a
third of all conversations share crosses the shuffle as one row per task. Deep
levels hold few sequences, and a job for each would take as many jobs as the
longest conversation has turns; levels ``hi`` down to ``lo`` are therefore
peeled inside tasks, one per distinct sequence of ``lo`` turns, whenever no
such task gets more than ``GROUP_TURNS`` turns. ``lo`` is chosen from the
measured sizes before each step; where no ``lo`` is small enough, one level is
peeled by a shuffle, which merges what made the group large.

The digest of a node's own conversation ids is SHA-256 over one long text,
which only one reader can take in order. Ids are range-sorted and joined to
texts of at most ``CHUNK_IDS`` ids on all executors; one task per node streams
these texts in order and keeps nothing but the running digest.

Rules for odd rows: turns are ordered by turn number, null first, equal
numbers by the digest of (role, text); a null role or text is empty; repeated
rows are turns of their own; rows with a null conversation id belong to no
conversation; a conversation whose turns are all replaced by an absent or
shorter head has no turn and is a member of the root only; an empty table has
no node; other columns are ignored. A conversation's digests (not its texts)
are held as one value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import WORD, stored

#: Bytes of a turn in a sequence: a SHA-256 digest and a count of words.
TURN = 40
#: Turns that one task peels in memory at most.
GROUP_TURNS = 4096
#: Ids that are joined to one text at most.
CHUNK_IDS = 65536
#: A conversation's head comes from the first of every ``FAMILY`` ids and has fewer than ``HEADS`` turns.
FAMILY = 20
HEADS = 4
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ("depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")
#: A sequence to be merged: one that ended (ends_sha256 is set) or a stripped node.
SEQUENCE = "seq binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
SEQUENCE_COLUMNS = [c.split()[0] for c in SEQUENCE.split(", ")]


def _depth(seq: Column) -> Column:
    return (F.octet_length(seq) / TURN).cast("long")


def turn_code(role: Column, text: Column) -> Column:
    """80 hexadecimal digits: SHA-256 of the role's length, the role and the text; the text's words."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(digest, F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), 16, "0"))


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, seq): every conversation's turn codes in order, joined."""
    coded = turns.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        turn_code(F.col(f"`{role}`"), F.col(f"`{text}`")).alias("code"))
    inside = F.sort_array(F.collect_list(F.struct("turn", "code")))
    return coded.groupBy("conv_id").agg(F.unhex(F.array_join(F.transform(inside, lambda t: t["code"]), "")).alias("seq"))


def with_shared_heads(convs: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Conversations whose first h turns are those of conversation c - c % ``family``; h = crc32(c) % ``heads``."""
    first = F.col("conv_id") - F.col("conv_id") % family
    donors = convs.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("donor"), F.expr(f"substring(seq, 1, {TURN * (heads - 1)})").alias("head"))
    asked = F.crc32(F.col("conv_id").cast("string")) % heads
    rebuilt = convs.withColumns({"donor": first, "h": asked}).join(donors, "donor", "left")
    seq = F.expr(f"concat(substring(coalesce(head, X''), 1, cast(h * {TURN} as int)), substring(seq, cast(h * {TURN} as int) + 1))")
    return rebuilt.select("conv_id", seq.alias("seq"))


def ends_digests(members: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv_id): SHA-256 of each key's ids in order, joined by commas."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def text() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"key": [key], "first": [ids[0]], "ids": [",".join(map(str, ids))]},
                                              pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))

        for batch in batches:
            for k, c in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if ids and (k != key or len(ids) == CHUNK_IDS):
                    yield text()
                    ids = []
                key = k
                ids.append(c)
        if ids:
            yield text()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
        key, state = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if k == key:
                    state.update(b",")
                else:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], schema=schema)

    texts = (members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
             .mapInArrow(join, "key binary, first long, ids string"))
    return (texts.repartition("key").sortWithinPartitions("key", "first").select("key", "ids")
            .mapInArrow(digest, "key binary, ends_sha256 string"))


def ended(convs: DataFrame) -> DataFrame:
    """Distinct whole sequences as rows of ``SEQUENCE``."""
    keyed = stored(convs.withColumn("key", F.unhex(F.sha2("seq", 256))), "trie-conversations")
    distinct = keyed.groupBy("key", "seq").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    none = F.lit(0).cast("long")
    return distinct.join(ends_digests(keyed), "key").select(
        "seq", "conv_id", "n_convs", none.alias("n_children"), none.alias("n_leaves"), none.alias("saved_tokens"), "ends_sha256")


def peel_group(rows: list[tuple], lo: int) -> tuple[list[dict], list[tuple]]:
    """Peel sequences that share their first ``lo`` turns down to ``lo``: the nodes below it, and what is left at ``lo``.

    ``rows`` and the second result are rows of ``SEQUENCE``.
    """
    ends: dict[int, list] = {}
    for row in rows:
        seq = row[0]
        state, keys = hashlib.sha256(seq[:lo * TURN]), {}
        keys[lo] = state.digest()
        for d in range(lo + 1, len(seq) // TURN + 1):
            state.update(seq[(d - 1) * TURN:d * TURN])
            keys[d] = state.digest()
        ends.setdefault(len(seq) // TURN, []).append((row, keys))
    nodes: list[dict] = []
    alive: dict[bytes, dict] = {}

    def merge(into: dict, key: bytes, keys: dict, row: tuple, below: list) -> None:
        seq, conv, convs, children, leaves, saved, digest = row
        node = into.get(key)
        if node is None:
            into[key] = {"seq": seq, "keys": keys, "conv_id": conv, "n_convs": convs, "n_children": children, "n_leaves": leaves,
                         "saved_tokens": saved, "ends_sha256": digest, "below": below}
            return
        node["conv_id"] = min(node["conv_id"], conv)
        node["n_convs"] += convs
        node["n_children"] += children
        node["n_leaves"] += leaves
        node["saved_tokens"] += saved
        node["ends_sha256"] = node["ends_sha256"] or digest
        node["below"] += below

    for d in range(max(ends), lo, -1):
        for row, keys in ends.get(d, []):
            merge(alive, keys[d], keys, row, [])
        stripped: dict[bytes, dict] = {}
        for key, n in alive.items():
            seq, keys = n["seq"], n["keys"]
            words = int.from_bytes(seq[d * TURN - 8:d * TURN], "big")
            node = {"depth": d, "key": key, "parent_key": keys[d - 1], "conv_id": n["conv_id"], "parent_conv_id": None,
                    "n_convs": n["n_convs"], "n_children": n["n_children"], "n_leaves": n["n_leaves"] or 1,
                    "saved_tokens": n["saved_tokens"] + (n["n_convs"] - 1) * words, "ends_sha256": n["ends_sha256"] or NO_ENDS}
            for child in n["below"]:
                child["parent_key"], child["parent_conv_id"] = None, n["conv_id"]
            nodes.append(node)
            up = (seq, n["conv_id"], n["n_convs"], 1, node["n_leaves"], node["saved_tokens"], None)
            merge(stripped, keys[d - 1], keys, up, [node])
        alive = stripped
    left = [(n["seq"][:lo * TURN], n["conv_id"], n["n_convs"], n["n_children"], n["n_leaves"], n["saved_tokens"], n["ends_sha256"])
            for n in alive.values()]
    return nodes, left


def _peel_block(rows: DataFrame, lo: int) -> DataFrame:
    """All sequences deeper than ``lo`` peeled down to it: rows of ``NODE``, and with ``seq`` set rows of ``SEQUENCE``."""
    names = [c.split()[0] for c in NODE.split(", ")]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        plain = [(bytes(s), *map(int, numbers), digest) for s, *numbers, digest in group[SEQUENCE_COLUMNS].itertuples(index=False)]
        nodes, left = peel_group(plain, lo)
        out = pd.DataFrame(nodes, columns=names).assign(seq=None)
        rest = pd.DataFrame(left, columns=SEQUENCE_COLUMNS).reindex(columns=[*names, "seq"])
        return pd.concat([out.astype(object), rest.astype(object)]).where(lambda x: x.notna(), None)

    deep = rows.where(F.octet_length("seq") > lo * TURN)
    return deep.groupBy(F.expr(f"substring(seq, 1, {lo * TURN})").alias("prefix")).applyInPandas(run, f"{NODE}, seq binary")


def _peel_level(rows: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """One level by a shuffle: (its nodes with their sequence, the stripped sequences)."""
    here = rows.where(F.octet_length("seq") == depth * TURN).groupBy("seq").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"))
    words = F.expr(f"cast(conv(hex(substring(seq, {depth * TURN - 7}, 8)), 16, 10) as long)") if depth else F.lit(0)
    parent = F.expr(f"substring(seq, 1, {(depth - 1) * TURN})") if depth else F.lit(None).cast("binary")
    nodes = here.select(
        F.lit(depth).cast("long").alias("depth"), F.unhex(F.sha2("seq", 256)).alias("key"), F.unhex(F.sha2(parent, 256)).alias("parent_key"),
        "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.greatest("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * words).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), parent.alias("stripped"))
    nodes = stored(nodes, "trie-level")
    left = nodes.where("stripped is not null").select(
        F.col("stripped").alias("seq"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.lit(None).cast("string").alias("ends_sha256"))
    return nodes.drop("stripped"), left


def block_bottom(rows: DataFrame, hi: int, group_turns: int) -> int | None:
    """The lowest level, 1 or more, to which all groups of one prefix can be peeled in a task; None if there is none below ``hi``."""
    levels = sorted({lo for k in range(hi.bit_length() + 1) for lo in (1 << k, 3 << k >> 1, hi - 1) if 1 <= lo < hi})
    if not levels:
        return None
    depth = _depth(F.col("seq"))
    each = rows.select("seq", depth.alias("depth"), F.explode(F.array(*[F.lit(x) for x in levels])).alias("lo")).where("depth > lo")
    sizes = each.groupBy("lo", F.expr(f"substring(seq, 1, lo * {TURN})").alias("prefix")).agg(F.sum(F.col("depth") - F.col("lo")).alias("turns"))
    most = {r["lo"]: r["turns"] for r in sizes.groupBy("lo").agg(F.max("turns").alias("turns")).collect()}  # one row per level asked for
    return min((lo for lo in levels if most.get(lo, 0) <= group_turns), default=None)


def peel(rows: DataFrame, group_turns: int = GROUP_TURNS) -> DataFrame:
    """All nodes (rows of ``NODE``) of the trie of ``rows`` (rows of ``SEQUENCE``, one per distinct whole sequence)."""
    rows = stored(rows, "trie-sequences")
    found: list[DataFrame] = []
    hi = rows.agg(F.max(_depth(F.col("seq")))).first()[0]
    if hi is None:
        return rows.sparkSession.createDataFrame([], NODE)
    while hi >= 0:
        lo = block_bottom(rows, hi, group_turns) if hi > 2 else None
        if lo is not None:
            both = stored(_peel_block(rows, lo), "trie-block")
            nodes, left, reached = both.where("seq is null").drop("seq"), both.where("seq is not null").select(*SEQUENCE_COLUMNS), lo
        else:
            (nodes, left), reached = _peel_level(rows, hi), hi - 1
        found.append(nodes)
        rows = rows.where(F.octet_length("seq") <= reached * TURN).unionByName(left) if reached >= 0 else left
        hi = reached
    out = found[0]
    for nodes in found[1:]:
        out = out.unionByName(nodes)
    return out


def trie_nodes(convs: DataFrame, group_turns: int = GROUP_TURNS) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id, seq): see the module's text for the columns' meaning."""
    nodes = stored(peel(ended(convs), group_turns), "trie-nodes")
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    # nodes peeled inside a task know their parent already
    known = nodes.where("parent_key is null").withColumn("found", F.lit(None).cast("long"))
    joined = nodes.where("parent_key is not null").join(parents, "parent_key").select(*known.columns)
    return known.union(joined).select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "found").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256")


ORACLE_SQL = r"""
with own as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, code) as n, code, words from (
    select conv_id, turn, sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as code,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
    from conversations where conv_id is not null)),
asked as (
  select c, c - c % 20 as donor, xor(4294967295, list_reduce(
      list_transform(range(1, length(c::varchar) + 1), lambda i: ascii((c::varchar)[i])::bigint),
      lambda r, b: list_reduce(range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(r, b)),
      4294967295::bigint)) % 4 as h
  from (select distinct c from own)),
rebuilt as (
  select a.c, row_number() over (partition by a.c order by p.part, p.n) as d, p.code, p.words from asked a join (
    select a.c, 0 as part, o.n, o.code, o.words from asked a join own o on o.c = a.donor and o.n <= a.h
    union all select a.c, 1, o.n, o.code, o.words from asked a join own o on o.c = a.c and o.n > a.h) p on p.c = a.c),
prefixes as (
  select c, d, list(code) over (partition by c order by d) as path, words from rebuilt
  union all select c, 0, []::varchar[], 0 from asked),
lengths as (select c, max(d) as len from prefixes group by c),
nodes as (
  select path, p.d as depth, min(c) as conv_id, count(*) as n_convs, any_value(words) as words,
         sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (len = p.d), '')) as ends_sha256
  from prefixes p join lengths using (c) group by path, p.d),
linked as (select n.*, p.conv_id as parent_conv_id from nodes n left join nodes p on p.path = n.path[:n.depth - 1] and n.depth > 0 and p.depth = n.depth - 1),
children as (select path[:depth - 1] as path, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by all),
filled as (select l.*, coalesce(n_children, 0) as n_children from linked l left join children k on k.path = l.path and k.depth = l.depth),
above as (select unnest(range(0, depth + 1)) as up, path, (n_children = 0)::bigint as leaf, (n_convs - 1) * words as saved from filled),
sums as (select path[:up] as path, up as depth, sum(leaf) as n_leaves, sum(saved) as saved_tokens from above group by all)
select conv_id, f.depth::bigint as depth, parent_conv_id, n_convs::bigint as n_convs, n_children::bigint as n_children,
       n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, ends_sha256
from filled f join sums s on s.path = f.path and s.depth = f.depth
"""


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the conversations of ``turns`` (conv_id, turn, role, text) with shared heads."""
    return trie_nodes(with_shared_heads(sequences(turns)))
