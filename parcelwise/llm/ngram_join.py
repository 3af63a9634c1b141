"""N-gram Jaccard join of texts (operator 2).

Documents link when the Jaccard similarity of their sets of word n-grams
reaches the threshold. Documents with equal sets are one node. The join is a
prefix filter over one global order of n-grams, rarest first:

1. every n-gram of every distinct set travels, sorted and compressed, to
   the partition of its hash, where its number of sets is counted; n-grams of
   one set alone can match nothing and end there;
2. the shared n-grams come back to their sets and are sorted rarest first. A
   set whose shared n-grams are fewer than the threshold asks for has no
   partner; of the others the prefix (n - ceil(t n) + 1 rarest) is kept;
3. sets that share a prefix n-gram are candidates if their sizes allow it
   (length filter), enough n-grams of both are left from this one on, as they
   are from the first common one of a pair that links (positional filter), and
   bitmaps of their n-grams do not show too many that the other lacks; every
   pair is taken once;
4. a pair is probed at the middle of its n-grams (suffix filter) and verified
   once by its exact intersection.

``similar_pairs`` gives all linked pairs of sets. Components need fewer: the
sets of a prefix n-gram are first compared with one of them (HUB_ROUNDS rounds
with different hubs), and then all candidate pairs whose ends are still apart,
less the rows that are too late in their set for any partner of the n-gram. So a
group of many near copies costs a multiple of its size, not its square (sets
that all but link with it can still meet many of it in the last round), and no
link that matters is lost.

Rules for odd rows: a null text or one without words has the empty set, links
with nothing and is its own component; a text of fewer than n words is one
shingle; repeated rows have equal sets and link; a null id never names a
component unless all its members are null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import batches_of, connected_components, give_back, partitions, stored
from parcelwise.llm.shingles import lowered, mixed, shingle_sets

#: Jaccard threshold in percent and words per n-gram.
PERCENT = 75
WORDS = 5
#: Bytes of a batch between the JVM and Python.
ARROW_BYTES = "4m"
#: n-grams a task packs before it sends them on.
FLUSH = 1_500_000
#: Buckets of n-grams that are sent together, when there are this many groups at least.
GROUPED = 4
LEAST_GROUPS = 16
#: Rounds in which sets are compared with one hub per n-gram, before all pairs that are still apart.
HUB_ROUNDS = 3
#: Counts are told apart up to here when n-grams are ordered (any order is right, if all sets use the same).
MOST_COUNT = 511
#: Bitmap words by which an n-gram of one set can be seen to be missing in another.
BITS = ("b0", "b1", "b2", "b3")


def set_key(shingles: np.ndarray) -> int:
    """A 64-bit key of a sorted set."""
    place = np.arange(1, len(shingles) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = mixed(shingles ^ mixed(place)).sum(dtype=np.uint64) + np.uint64(len(shingles))
        return int(mixed(np.array([h], dtype=np.uint64)).view(np.int64)[0])


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """(id, text_key, n_shingles, node, check) per row; node and check are keys of the set, null for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets([lowered(t) for t in batch.column(2).to_pylist()], words)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([set_key(s ^ np.uint64(0xA5A5A5A5)) if len(s) else None for s in sets], pa.int64()),
            ], names=["id", "text_key", "n_shingles", "node", "check"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, text_key long, n_shingles long, node long, check long")


def one_set_per_key(sigs: DataFrame) -> DataFrame:
    """One row per node (node, low_id); fail loudly should a 64-bit key ever stand for two sets."""
    nodes = stored(sigs.where("node is not null").groupBy("node").agg(
        F.min("id").alias("low_id"), F.min("check").alias("c0"), F.max("check").alias("c1")), "join-nodes")
    if not nodes.where("c0 <> c1").isEmpty():
        raise RuntimeError("two different n-gram sets have the same 64-bit key")
    return nodes.select("node", "low_id")


def tight(x: np.ndarray) -> bytes:
    """An array as bytes, compressed byte plane by byte plane (high bytes of small numbers take next to nothing)."""
    width = x.dtype.itemsize
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, width).T.tobytes()
    return width.to_bytes(1, "little") + len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def loose(data: bytes) -> np.ndarray:
    """The unsigned numbers that ``tight`` was given."""
    width, size = data[0], int.from_bytes(data[1:9], "little")
    planes = pa.decompress(data[9:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).reshape(-1).view(f"<u{width}")


def _places(n: np.ndarray, most: int) -> np.ndarray:
    """Numbers below ``most`` in as few bytes as hold them."""
    return n.astype(np.uint16 if most <= 1 << 16 else np.uint32)


def _groups(buckets: int) -> np.ndarray:
    """First bucket of every group, and the end: a set's key travels once per group, so a group holds several buckets."""
    n = min(buckets, max(LEAST_GROUPS, buckets // GROUPED))
    return np.arange(n + 1) * buckets // n


def _keys(nodes: np.ndarray) -> bytes:
    """Ascending node keys, as their steps."""
    return tight(np.diff(nodes.view(np.uint64), prepend=np.uint64(0)))


def _nodes(data: bytes) -> np.ndarray:
    return np.cumsum(loose(data), dtype=np.uint64).view(np.int64)


def _packed_shingles(docs: DataFrame, text_col: str, words: int, buckets: int) -> DataFrame:
    """Rows (part, nodes, sizes, own, low, mid): the n-grams of many sets that fall into one group of buckets.

    ``own``, ``low`` and ``mid`` have an element for each bucket. Its n-grams
    are sorted by the lower 48 bits of their hash: ``low`` holds 32 of these,
    ``mid`` the steps of the upper 16, ``own`` the place of each n-gram's set
    in ``nodes`` and ``sizes``.
    """
    groups = _groups(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        sent: set[int] = set()
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            keys = sorted(held)
            nodes = np.array(keys, dtype=np.int64)
            sizes = np.array([len(held[k]) for k in keys], dtype=np.uint32)
            h = np.concatenate([held[k] for k in keys])
            own = np.repeat(np.arange(len(nodes)), sizes)
            key = ((h >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)) << np.uint64(48) | h & np.uint64((1 << 48) - 1)
            order = np.argsort(key)
            key, own = key[order], own[order]
            edges = np.searchsorted(key >> np.uint64(48), np.arange(buckets + 1, dtype=np.uint64))
            for part, (first, last) in enumerate(zip(groups[:-1], groups[1:], strict=True)):
                s, e = edges[first], edges[last]
                if s == e:
                    continue
                who, at = np.unique(own[s:e], return_inverse=True)
                at = _places(at, len(who))
                columns: list[list[bytes]] = [[], [], []]
                for x, y in zip(edges[first:last], edges[first + 1:last + 1], strict=True):
                    mid = (key[x:y] >> np.uint64(32)).astype(np.uint16)
                    for column, c in zip(columns, (at[x - s:y - s], key[x:y].astype(np.uint32), np.diff(mid, prepend=np.uint16(0))), strict=True):
                        column.append(tight(c))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([_keys(nodes[who])], pa.binary()), pa.array([tight(sizes[who])], pa.binary()),
                     *(pa.array([c], pa.list_(pa.binary())) for c in columns)],
                    names=["part", "nodes", "sizes", "own", "low", "mid"])

        for batch in batches:
            for s in shingle_sets([lowered(t) for t in batch.column(0).to_pylist()], words):
                if len(s) and (key := set_key(s)) not in sent:  # copies within a task travel once
                    sent.add(key)
                    held[key] = s
                    size += len(s)
                    if size >= FLUSH:
                        yield from packed()
                        held, size = {}, 0
                        if len(sent) >= FLUSH:  # bounded; what is sent again is merged where it arrives
                            sent = set()
        if held:
            yield from packed()
        held, sent = {}, set()
        give_back()

    return docs.select(text_col).mapInArrow(run, "part int, nodes binary, sizes binary, own array<binary>, low array<binary>, mid array<binary>")


def _shared(packed: DataFrame, buckets: int) -> DataFrame:
    """Rows (place, part, nodes, sizes, runs, low, mid, counts, sub): the n-grams that other sets have too, packed by the partition of their set.

    ``runs`` holds the number of n-grams per set, the n-grams lie set by set;
    ``counts`` the sets that have each, up to MOST_COUNT, ``sub`` the bucket
    of each among those of the group.
    """

    def of_bucket(h: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(h, kind="stable")
        h, own = h[order], own[order]
        again = h[1:] == h[:-1]
        several = np.concatenate([again, [False]]) | np.concatenate([[False], again]) if len(h) else np.zeros(0, bool)
        h, own = h[several], own[several]
        order = np.lexsort((own, h))  # copies sent by several tasks fall together
        h, own = h[order], own[order]
        fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])]) if len(h) else np.zeros(0, bool)
        h, own = h[fresh], own[fresh]
        _, gram, count = np.unique(h, return_inverse=True, return_counts=True)
        count = np.minimum(count, MOST_COUNT).astype(np.uint16)[gram]
        return h[count > 1], own[count > 1], count[count > 1]

    def of_part(part: int, rows: list[list]) -> Iterator[pa.RecordBatch]:
        sent = [_nodes(row[0]) for row in rows]
        offsets = np.cumsum([0] + [len(x) for x in sent])
        sent = np.concatenate(sent)
        nodes, first = np.unique(sent, return_index=True)
        sizes = np.concatenate([loose(row[1]) for row in rows])[first]
        at = np.searchsorted(nodes, sent)
        found = []
        for k in range(len(rows[0][2])):
            own = np.concatenate([at[o + loose(row[2][k]).astype(np.int64)] for o, row in zip(offsets, rows, strict=False)])
            h = np.concatenate([loose(row[3][k]).astype(np.uint64) | np.cumsum(loose(row[4][k]), dtype=np.uint16).astype(np.uint64) << np.uint64(32) for row in rows])
            h, own, count = of_bucket(h, own)
            found.append((h, own, count, np.full(len(h), k, np.uint16)))
        h, own, count, sub = (np.concatenate(c) for c in zip(*found, strict=True))
        place = ((mixed(nodes.view(np.uint64)) >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int64)
        order = np.lexsort((h, sub, own, place[own]))
        h, own, count, sub = h[order], own[order], count[order], sub[order]
        turn = np.flatnonzero(np.concatenate([[True], place[own][1:] != place[own][:-1], [True]])) if len(own) else np.zeros(1, int)
        for s, e in zip(turn[:-1], turn[1:], strict=True):
            who, runs = np.unique(own[s:e], return_counts=True)
            columns = (sizes[who], runs.astype(np.uint32), h[s:e].astype(np.uint32), (h[s:e] >> np.uint64(32)).astype(np.uint16), count[s:e], sub[s:e])
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(place[own[s]])], pa.int32()), pa.array([part], pa.int32()), pa.array([_keys(nodes[who])], pa.binary()),
                 *(pa.array([tight(c)], pa.binary()) for c in columns)],
                names=["place", "part", "nodes", "sizes", "runs", "low", "mid", "counts", "sub"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            for part, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != current and rows:
                    yield from of_part(current, rows)
                    rows = []
                current = part
                rows.append(row)
        if rows:
            yield from of_part(current, rows)
        rows = []
        give_back()

    dealt = packed.repartition(buckets, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "place int, part int, nodes binary, sizes binary, runs binary, low binary, mid binary, counts binary, sub binary")


def _gathered(shared: DataFrame, buckets: int, percent: int) -> DataFrame:
    """Rows (node, n, m, weight, bitmap, entries) of the sets with enough shared n-grams, sorted rarest first."""
    groups = _groups(buckets)

    def of_place(parts: list[list]) -> Iterator[pa.RecordBatch]:
        sent, sizes, node, entry = [], [], [], []
        for part, nodes, *packed in parts:
            size, runs, low, mid, count, sub = (loose(c) for c in packed)
            bucket = sub.astype(np.uint64) + np.uint64(groups[part])
            sent.append(_nodes(nodes))
            sizes.append(size.astype(np.int64))
            node.append(np.repeat(sent[-1], runs))
            # count, bucket and hash in one number: entries sort rarest first and are equal for equal n-grams
            gram = (bucket % np.uint64(64)) << np.uint64(48) | mid.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)
            entry.append((count.astype(np.uint64) << np.uint64(54) | gram).view(np.int64))
        sent, sizes, node, entry = (np.concatenate(x) for x in (sent, sizes, node, entry))
        order = np.lexsort((entry, node))
        entry, node = entry[order], node[order]
        ids, first, m = np.unique(node, return_index=True, return_counts=True)
        known, at = np.unique(sent, return_index=True)
        n = sizes[at][np.searchsorted(known, ids)]
        weight = np.add.reduceat(entry >> 54, first) / n
        bit = mixed(entry.view(np.uint64))
        one = np.uint64(1) << (bit & np.uint64(63))
        word = (bit >> np.uint64(6)) % np.uint64(len(BITS))
        bits = [np.bitwise_or.reduceat(np.where(word == np.uint64(w), one, np.uint64(0)), first).view(np.int64) for w in range(len(BITS))]
        for k in np.array_split(np.flatnonzero(100 * m >= percent * n), 1 + len(ids) // 2000):
            if len(k):
                some = np.concatenate([np.arange(first[j], first[j] + m[j]) for j in k])
                edges = np.concatenate([[0], np.cumsum(m[k])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[k]), pa.array(n[k]), pa.array(m[k]), pa.array(weight[k]), *(pa.array(b[k]) for b in bits), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(entry[some]))],
                    names=["node", "n", "m", "weight", *BITS, "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            for place, *part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != current and parts:
                    yield from of_place(parts)
                    parts = []
                current = place
                parts.append(part)
        if parts:
            yield from of_place(parts)
        parts = []
        give_back()

    dealt = shared.repartition(buckets, "place").sortWithinPartitions("place")
    return dealt.mapInArrow(run, f"node long, n long, m long, weight double, {', '.join(f'{b} long' for b in BITS)}, entries array<long>")


def _least_overlap(n, percent: int):
    """Common n-grams that a set of size n needs at least, with any partner."""
    return F.ceil(n * F.lit(percent) / F.lit(100))


def candidates(docs: DataFrame, text_col: str, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Sets that can have a partner: (node, n, m, weight, entries), m shared n-grams sorted rarest first, weight their mean count."""
    buckets = partitions(docs.sparkSession)
    return _gathered(_shared(_packed_shingles(docs, text_col, words, buckets), buckets), buckets, percent)


def prefixes(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows (node, n, m, weight, bitmap, place, gram) of the prefix n-grams.

    N-grams of one set alone come first in its order and match nothing, so
    the prefix is what is left of its length, and places count shared n-grams.
    """
    length = F.col("m") - _least_overlap(F.col("n"), percent) + 1
    prefix = F.posexplode(F.slice("entries", F.lit(1), length.cast("int"))).alias("place", "gram")
    return sets.where(length > 0).select("node", "n", "m", "weight", *BITS, prefix)


def _possible(percent: int):
    """Length, positional and bitmap filters for a row with both ends of a pair (n, m, place and n2, m2, place2).

    All common n-grams of a pair lie from its first one on, so at the first a
    pair that links passes; at later ones, where less is left, it need not.
    """
    n, n2, m, m2, p, p2 = (F.col(c) for c in ("n", "n2", "m", "m2", "place", "place2"))
    most = F.least(m - p, m2 - p2)
    missing = [sum((F.bit_count(F.col(a).bitwiseAND(F.bitwise_not(F.col(b)))) for a, b in ends), F.lit(0))
               for ends in ([(c, f"{c}2") for c in BITS], [(f"{c}2", c) for c in BITS])]
    most = F.least(most, m - missing[0], m2 - missing[1])
    return (100 * F.least(n, n2) >= percent * F.greatest(n, n2)) & (100 * most >= percent * (n + n2 - most))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that link, with their overlap; each is verified once."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("entries").alias("ea"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("entries").alias("eb"))
    both = pairs.join(one, "a").join(two, "b")
    # suffix filter: n-grams on the same side of a pivot only can be common
    pivot = F.element_at("eb", (F.size("eb") / 2).cast("int") + 1)
    la, lb = F.size(F.filter("ea", lambda x: x < pivot)), F.size(F.filter("eb", lambda x: x < pivot))
    most = F.least(la, lb) + F.least(F.size("ea") - la, F.size("eb") - lb)
    enough = 100 * most >= percent * (F.col("na") + F.col("nb") - most)
    overlap = F.when(enough, F.size(F.array_intersect("ea", "eb"))).otherwise(F.lit(0))
    return both.select("a", "b", "na", "nb", overlap.alias("overlap")).where(
        100 * F.col("overlap") >= percent * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b", "overlap")


def _beside(rows: DataFrame) -> DataFrame:
    """``rows`` as the other end of a pair."""
    return rows.select("gram", *[F.col(c).alias(f"{c}2") for c in rows.columns if c != "gram"])


def _all_candidates(rows: DataFrame, percent: int) -> DataFrame:
    return _ordered(rows.join(_beside(rows), "gram").where((F.col("node") < F.col("node2")) & _possible(percent)))


def _within_reach(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` that leave their set n-grams enough to link with the smallest set of the n-gram.

    N-grams whose rows then lie in one component go; of the others ``main`` is
    the component with most rows.
    """
    small = rows.groupBy("gram").agg(F.min("n").alias("small"))
    enough = (100 + percent) * (F.col("m") - F.col("place")) >= percent * (F.col("n") + F.col("small"))
    near = stored(rows.join(small, "gram").where(enough).drop("small"), "join-near")
    comps = near.groupBy("gram", "comp").agg(F.count("*").alias("k"))
    main = comps.groupBy("gram").agg(F.max(F.struct("k", "comp")).alias("most"), F.count("*").alias("comps")).where("comps > 1")
    return near.join(main.select("gram", F.col("most.comp").alias("main")), "gram")


def _apart_candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of different components; one end at least is outside the main component of the n-gram."""
    near = stored(_within_reach(rows, percent), "join-reach")
    met = near.where("comp <> main").drop("main").join(_beside(near.drop("main")), "gram")
    return _ordered(met.where((F.col("comp") != F.col("comp2")) & _possible(percent)))


def similar_pairs(docs: DataFrame, text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """All linked pairs (a, b, overlap) of distinct sets; nodes as in ``signatures``."""
    sets = stored(candidates(docs, text_col, words, percent), "join-sets")
    return verified(_all_candidates(prefixes(sets, percent), percent), sets, percent)


def _hub_pairs(rows: DataFrame, percent: int, turn: int) -> DataFrame:
    """Every set of a prefix n-gram against one hub of that n-gram.

    The first hub is the set whose n-grams most others have (the original of
    a group of edited copies); later ones are drawn by hash.
    """
    order = F.struct(-F.col("weight"), "node") if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)), "node")
    hub = rows.groupBy("gram").agg(F.min(F.struct(order.alias("o"), "node", "n", "m", "place", *BITS)).alias("h"))
    hub = hub.select("gram", *[F.col(f"h.{c}").alias(f"{c}2") for c in ("node", "n", "m", "place", *BITS)])
    return _ordered(rows.join(hub, "gram").where((F.col("node") != F.col("node2")) & _possible(percent)))


def _still_apart(rows: DataFrame, sets: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` of n-grams whose sets lie in several components, with these (comp).

    Components only grow, so what is left out once stays out. Bitmaps and
    sizes are moved for the rows that stay only.
    """
    comps = comps.select("node", F.col("component").alias("comp"))
    places = rows.select("gram", "node", "place")
    known = places.select("gram", "node").join(comps, "node", "left").select("gram", F.coalesce("comp", "node").alias("comp"))
    alive = known.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("gram")
    left = places.join(alive, "gram", "left_semi").join(sets.select("node", "n", "m", "weight", *BITS), "node")
    return left.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def set_components(docs: DataFrame, text_col: str, words: int = WORDS, percent: int = PERCENT, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """(node, component) for every set that has a partner."""
    sets = stored(candidates(docs, text_col, words, percent), "join-sets")
    rows = stored(prefixes(sets, percent), "join-prefixes")
    links, tried, comps, open_rows = None, None, None, rows
    for turn in range(hub_rounds + 1):
        if turn < hub_rounds:
            pairs = _hub_pairs(open_rows, percent, turn)
        else:
            pairs = _apart_candidates(open_rows, percent)
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "join-pairs")
        met = sets
        if turn:  # most sets are settled by now: the few that are still compared are moved alone
            ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "join-ends")
            met = stored(sets.join(ends, "node", "left_semi"), "join-met")
        found = stored(verified(pairs, met, percent).select("a", "b"), "join-links")
        links = found if links is None else links.union(found)
        tried = pairs if tried is None else tried.union(pairs)
        comps = connected_components(links)
        if turn < hub_rounds:  # n-grams whose sets are all united have nothing left to find
            open_rows = stored(_still_apart(open_rows, sets, comps), "join-open")
            if open_rows.isEmpty():
                break
    return comps


def _components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and (node, component, low_id) of all sets."""
    with batches_of(docs.sparkSession, ARROW_BYTES):
        sigs = stored(signatures(docs, id_col, text_col, words), "join-signatures")
        nodes = one_set_per_key(sigs)
        comps = set_components(docs, text_col, words, percent)
    return sigs, nodes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links)."""
    sigs, grouped = _components(docs, id_col, text_col, words, percent)
    lowest = grouped.groupBy("component").agg(F.min("low_id").alias("component_id"))
    known = stored(grouped.join(lowest, "component").select("node", "component_id"), "join-known")
    return sigs.join(known, "node", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with one of each component: that with the smallest id (then text key). Rows without words all stay."""
    sigs, grouped = _components(docs, id_col, text_col, words, percent)
    rows = sigs.groupBy("node", "id", "text_key").agg(F.count("*").alias("n"))
    placed = rows.join(stored(grouped.select("node", "component"), "join-known"), "node")
    # nulls come last
    key = F.struct(F.col("id").isNull().alias("late"), "id", "text_key", "n")
    picks = placed.groupBy("component").agg(F.min(key).alias("k")).select("k.id", "k.text_key", (F.col("k.n") > 1).alias("again"))
    empty = rows.where("node is null").select("id", "text_key", F.lit(False).alias("again"))
    kept = stored(picks.union(empty), "join-kept")
    # the row travels in one field, as its columns may have the names used here
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("own"), F.xxhash64(F.col(f"`{text_col}`")).alias("hash"))
    met = packed.join(kept, packed["own"].eqNullSafe(kept["id"]) & (packed["hash"] == kept["text_key"]))
    # rows that come several times over, id and text alike, stay once
    rows = met.where("not again").select("row").union(met.where("again").dropDuplicates(["id", "text_key"]).select("row"))
    return rows.select(*[F.col(f"row.`{c}`") for c in docs.columns])


ORACLE_SQL = r"""
with recursive
w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, case when len(ws) = 0 then []::varchar[] when len(ws) < 5 then [array_to_string(ws, ' ')]
        else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) end as ss from w),
n as (select doc_id, len(ss)::bigint as n from s),
g as (select doc_id, unnest(ss) as sh from s),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from g a join g b on a.sh = b.sh and a.doc_id <> b.doc_id group by all),
link as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
reach as (select doc_id as root, doc_id as node from n union select r.root, l.b from reach r join link l on l.a = r.node)
select n.doc_id, n.n as n_shingles, (select min(node) from reach where root = n.doc_id) as component_id from n
"""
