"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere (operator 5).

A column-wise construction over whole documents takes as many rounds as the
longest document has bytes and passes over the whole collection in each. As
only common prefixes of LENGTH bytes count, the collection is cut into many
small ones whose strings are short:

1. every run of windows with one anchor (see ``windows``) travels as some 20
   packed bytes to the partition of its anchor; anchors that occur once end
   there, and with them most of the text;
2. runs whose region (the bytes their windows cover) occurs twice as a whole
   are repeated throughout;
3. what is left are regions with equal anchors and different surroundings. By
   32 columns each, their windows share a core of 169 bytes; regions with
   equal cores are the documents of one small collection. Its Burrows-Wheeler
   transform and common prefixes are built column-wise (``Collection``): every
   round inserts the next symbol to the left of every document, sorts stably
   by it, and carries the common prefixes along. After a column's round, a
   window is repeated if its common prefix with a neighbour reaches LENGTH;
4. repeated windows are united to spans per document.

The steps hand over tables in the shared checkpoint folder, written and read
sequentially; one task holds a bounded chunk of short strings. Strings are
judged on the input. Documents with equal texts are one node, repeated
throughout if the text has LENGTH bytes.

Rules for odd rows: a null text is empty; a text of fewer than LENGTH bytes
keeps everything; repeated rows are separate documents; an empty table gives
an empty result; input columns are kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import give_back, partitions, stored
from parcelwise.llm.windows import LENGTH, anchors

#: Columns that one collection spans, and the bytes that all its strings share.
WIDTH = 32
CORE = LENGTH - WIDTH + 1
#: Anchors that a task packs before it sends them on, and strings that one construction holds.
FLUSH = 250_000
CHUNK = 60_000
#: Anchors are called frequent, and skip the count, if a sample of 1 text in SAMPLE holds them FREQUENT times; at most MOST_FREQUENT.
SAMPLE = 64
FREQUENT = 16
MOST_FREQUENT = 8192
BATCH_BYTES = 1 << 19

CANDIDATE = "gram long, region long, node long, lo int, hi int, at int"


def _text_batches(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with at most about BATCH_BYTES of text, and their texts as bytes."""
    for batch in batches:
        column = batch.column(text).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        at = 0
        while at < len(sizes):
            end, size = at, 0
            while end < len(sizes) and (end == at or size + sizes[end] < BATCH_BYTES):
                size += sizes[end]
                end += 1
            yield batch.slice(at, end - at), [t or b"" for t in column.slice(at, end - at).to_pylist()]
            at = end


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_bytes, node, check, sha256) of every row's whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.xxhash64(text).alias("node"), F.crc32(text.cast("binary")).alias("check"), F.sha2(text, 256).alias("sha256"))


def text_nodes(sigs: DataFrame) -> DataFrame:
    """One row per text: (node, low_id, copies, n_bytes, sha256); fails loudly should a 64-bit key stand for two texts."""
    nodes = stored(sigs.groupBy("node").agg(
        F.min("id").alias("low_id"), F.count("*").alias("copies"), F.max("n_bytes").alias("n_bytes"), F.max("sha256").alias("sha256"),
        F.min("sha256").alias("other")), "suffix-nodes")
    if not nodes.where("sha256 <> other").isEmpty():
        raise RuntimeError("two different texts have the same 64-bit key")
    return nodes.drop("other")


def frequent_anchors(docs: DataFrame, text_col: str) -> np.ndarray:
    """Sorted hashes of anchors that very many places share, from a hash sample of the texts (bounded, only a routing hint)."""
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _text_batches(batches, 0):
            values, counts = np.unique(anchors(texts)[4], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["gram", "n"])

    sample = docs.select(text_col).where(F.pmod(key, F.lit(SAMPLE)) == 0).mapInArrow(run, "gram long, n long")
    top = sample.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "gram").limit(MOST_FREQUENT)
    return np.sort(np.array([r["gram"] for r in top.collect()], dtype=np.int64).view(np.uint64))


def _packed_anchors(docs: DataFrame, text_col: str, buckets: int, frequent: np.ndarray) -> DataFrame:
    """Rows (bucket, sure, runs, low, mid, region, lo, span, at): the anchors of many texts that fall into one bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most MOST_FREQUENT numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        often = shared.value

        def packed() -> Iterator[pa.RecordBatch]:
            node, lo, hi, at, gram, region = (np.concatenate(c) for c in zip(*held, strict=True))
            if len(often):
                found = np.minimum(np.searchsorted(often, gram), len(often) - 1)
                sure = often[found] == gram
            else:
                sure = np.zeros(len(gram), dtype=bool)
            # frequent anchors need no count: they are dealt out by their region and pass through
            bucket = (np.where(sure, region ^ node.view(np.uint64), gram) >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)
            kind = bucket.astype(np.int64) * 2 + sure
            order = np.argsort(kind, kind="stable")
            node, lo, hi, at, gram, region, kind = (x[order] for x in (node, lo, hi, at, gram, region, kind))
            edges = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1], [True]]))
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                turn = np.flatnonzero(np.concatenate([[True], node[s + 1:e] != node[s:e - 1], [True]]))
                columns = [np.stack([node[s:e][turn[:-1]], np.diff(turn)]), gram[s:e].astype(np.uint32), (gram[s:e] >> np.uint64(32)).astype(np.uint32),
                           region[s:e], lo[s:e].astype(np.uint32), (hi[s:e] - lo[s:e]).astype(np.uint8), (at[s:e] - lo[s:e]).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(kind[s]) // 2], pa.int32()), pa.array([bool(kind[s] % 2)])] + [pa.array([c.tobytes()], pa.binary()) for c in columns],
                    names=_PACKED)

        for batch, texts in _text_batches(batches, 1):
            keys = batch.column(0).to_pylist()
            fresh = [k for k, key in enumerate(keys) if key not in seen and not seen.add(key)]  # copies within a task travel once
            if not fresh:
                continue
            owner, lo, hi, at, gram, region = anchors([texts[k] for k in fresh])
            if len(gram):
                held.append((np.array([keys[k] for k in fresh], dtype=np.int64)[owner], lo, hi, at, gram, region))
                size += len(gram)
            if size >= FLUSH:
                yield from packed()
                held, size, seen = [], 0, set()
        if held:
            yield from packed()
        held, seen = [], set()
        give_back()

    texts = docs.select(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("node"), text_col)
    return texts.mapInArrow(run, "bucket int, sure boolean, runs binary, low binary, high binary, region binary, lo binary, span binary, at binary")


_PACKED = ["bucket", "sure", "runs", "low", "high", "region", "lo", "span", "at"]


def _shared_anchors(packed: DataFrame, buckets: int) -> DataFrame:
    """CANDIDATE rows: runs whose anchor occurs at another place too, or is frequent."""

    def rows_of(sure: bool, parts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        columns = [b"".join(p) for p in zip(*parts, strict=True)]
        runs = np.concatenate([np.frombuffer(p[0], np.int64).reshape(2, -1) for p in parts], axis=1)
        node = np.repeat(runs[0], runs[1])
        gram = np.frombuffer(columns[1], np.uint32).astype(np.uint64) | np.frombuffer(columns[2], np.uint32).astype(np.uint64) << np.uint64(32)
        region, lo = np.frombuffer(columns[3], np.uint64), np.frombuffer(columns[4], np.uint32)
        span, at = np.frombuffer(columns[5], np.uint8), np.frombuffer(columns[6], np.uint8)
        if sure:
            keep = np.arange(len(gram))
        else:
            order = np.argsort(gram, kind="stable")
            g = gram[order]
            again = g[1:] == g[:-1]
            keep = order[np.concatenate([again, [False]]) | np.concatenate([[False], again])] if len(g) else order
            keep = keep[np.lexsort((lo[keep], node[keep], gram[keep]))]  # copies sent by several tasks count once
            same = (gram[keep][1:] == gram[keep][:-1]) & (node[keep][1:] == node[keep][:-1]) & (lo[keep][1:] == lo[keep][:-1])
            keep = keep[np.concatenate([[True], ~same])] if len(keep) else keep
            _, group, count = np.unique(gram[keep], return_inverse=True, return_counts=True)
            keep = keep[count[group] > 1]
        for s in range(0, len(keep), 50_000):
            k = keep[s:s + 50_000]
            first = lo[k].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[k].view(np.int64)), pa.array(region[k].view(np.int64)), pa.array(node[k]), pa.array(first),
                 pa.array(first + span[k].astype(np.int32)), pa.array(first + at[k].astype(np.int32))],
                names=["gram", "region", "node", "lo", "hi", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, size = None, [], 0
        for batch in batches:
            for bucket, sure, *part in zip(*(batch.column(c).to_pylist() for c in _PACKED), strict=True):
                if parts and ((bucket, sure) != current or sure and size > FLUSH):
                    yield from rows_of(current[1], parts)
                    parts, size = [], 0
                current = (bucket, sure)
                parts.append(part)
                size += len(part[5])
        if parts:
            yield from rows_of(current[1], parts)
        parts = []
        give_back()

    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "sure")
    return dealt.mapInArrow(run, CANDIDATE)


class Collection:
    """Column-wise construction over many small collections at once, from the right end to the left.

    ``order`` lists the strings by the suffixes inserted so far, collection by
    collection; ``lcp[i]`` is the common prefix of the suffixes at i - 1 and i
    (0 where a collection begins); ``bwt`` is the column of symbols that the
    last round inserted, in the order before it.
    """

    MISSING = 256

    def __init__(self, groups: np.ndarray):
        """``groups``: collection number of each string, ascending."""
        self.groups = groups
        self.order = np.arange(len(groups))
        self.lcp = np.zeros(len(groups), dtype=np.int32)
        self.bwt = np.zeros(len(groups), dtype=np.int16)
        # empty suffixes are equal, with a common prefix of 0 everywhere

    def _range_min(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """min(lcp[lo..hi]) for each pair, by a table of doubling ranges."""
        out = np.empty(len(lo), dtype=np.int32)
        width = hi - lo + 1
        level = np.frexp(width.astype(np.float64))[1] - 1  # floor(log2(width))
        table, step = self.lcp, 1
        for k in range(int(level.max(initial=-1)) + 1):
            here = level == k
            if here.any():
                out[here] = np.minimum(table[lo[here]], table[hi[here] - step + 1])
            table = np.minimum(table[:-step], table[step:]) if len(table) > step else table
            step *= 2
        return out

    def insert(self, symbols: np.ndarray) -> None:
        """Put one symbol in front of every string (MISSING: the string has ended)."""
        self.bwt = symbols[self.order].astype(np.int16)
        group = self.groups[self.order]
        place = np.argsort(group * 512 + self.bwt, kind="stable")
        fresh_group, fresh_symbol = group[place], self.bwt[place]
        equal = (fresh_group[1:] == fresh_group[:-1]) & (fresh_symbol[1:] == fresh_symbol[:-1]) & (fresh_symbol[1:] != self.MISSING)
        after = np.flatnonzero(equal) + 1
        lcp = np.zeros(len(self.lcp), dtype=np.int32)
        lcp[after] = 1 + self._range_min(place[after - 1] + 1, place[after])
        self.order, self.lcp = self.order[place], lcp

    def insert_common(self, length: int) -> None:
        """Put ``length`` symbols, the same for all strings of a collection, in front of every string."""
        inner = np.concatenate([[False], self.groups[self.order][1:] == self.groups[self.order][:-1]])
        self.lcp = np.where(inner, self.lcp + length, 0).astype(np.int32)

    def repeated(self, length: int) -> np.ndarray:
        """Strings whose suffix shares ``length`` symbols with a neighbour's."""
        long = self.lcp >= length
        out = np.zeros(len(self.order), dtype=bool)
        out[self.order] = long | np.concatenate([long[1:], [False]])
        return out


def repeated_windows(groups: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For every string and column 0..WIDTH-1 whether its window of LENGTH symbols occurs in another string of its collection.

    ``left[:, d]`` is the symbol d + 1 places left of the core, ``right[:, d]``
    the one d places behind it (MISSING where the string does not reach).
    Column d's window starts d symbols left of the core.
    """
    c = Collection(groups)
    for d in range(WIDTH - 2, -1, -1):
        c.insert(right[:, d])
    c.insert_common(CORE)
    out = np.zeros((len(groups), WIDTH), dtype=bool)
    out[:, 0] = c.repeated(LENGTH)
    for d in range(1, WIDTH):
        c.insert(left[:, d - 1])
        out[:, d] = c.repeated(LENGTH)
    return out


STRINGS = "core long, gram long, region long, klass int, left binary, right binary"


def _strings(reps: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The strings of the small collections: per region and class of columns the core's key and what lies around it."""
    wanted = reps.groupBy("node", "low_id").agg(F.collect_list(F.struct("gram", "region", "lo", "hi", "at")).alias("regions"))
    texts = docs.select(F.col(id_col).alias("low_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("node", F.xxhash64("text"))
    met = texts.join(wanted, (texts["node"] == wanted["node"]) & texts["low_id"].eqNullSafe(wanted["low_id"])).select("text", "regions")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, regions in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.encode("utf-8", "replace")
                for r in regions:
                    lo, hi, at = r["lo"], r["hi"], r["at"]
                    for k in range((at - hi) // WIDTH, (at - lo) // WIDTH + 1):
                        start = at - WIDTH * k  # the core starts here; column d's window d bytes before
                        first, last = max(lo, start - WIDTH + 1), min(hi, start)
                        core = hashlib.blake2b(data[start:start + CORE], digest_size=8, salt=bytes([k])).digest()
                        # only bytes that the region's windows of this class cover
                        rows.append((int.from_bytes(core, "little", signed=True), r["gram"], r["region"], k,
                                     data[first:start], data[start + CORE:last + LENGTH], start - last))
                if len(rows) > 20_000:
                    yield _string_batch(rows)
                    rows = []
            if rows:
                yield _string_batch(rows)
        give_back()

    return met.mapInArrow(run, STRINGS + ", low int")


def _string_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["core", "gram", "region", "klass", "left", "right", "low"])


RUNS = "gram long, region long, runs array<struct<near:int,far:int>>"


def _tails(values: list[bytes], reverse: bool) -> np.ndarray:
    """Rows of WIDTH - 1 symbols, MISSING beyond each tail's end."""
    width = WIDTH - 1
    padded = b"".join((v[::-1] if reverse else v).ljust(width, b"\0") for v in values)
    out = np.frombuffer(padded, dtype=np.uint8).reshape(-1, width).astype(np.int16)
    lengths = np.array([len(v) for v in values])
    out[np.arange(width)[None, :] >= lengths[:, None]] = Collection.MISSING
    return out


def _found(core: np.ndarray, batch: pa.Table) -> Iterator[pa.RecordBatch]:
    """Results of whole collections: the ranges of repeated windows of each string that has some."""
    gram, region, klass = (batch.column(c).to_numpy() for c in ("gram", "region", "klass"))
    same = (core[1:] == core[:-1]) & (gram[1:] == gram[:-1]) & (region[1:] == region[:-1]) & (klass[1:] == klass[:-1])
    fresh = np.concatenate([[True], ~same])  # a string that came twice is one
    batch, core = batch.filter(pa.array(fresh)), core[fresh]
    _, groups = np.unique(core, return_inverse=True)
    bits = repeated_windows(groups, _tails(batch.column("left").to_pylist(), True), _tails(batch.column("right").to_pylist(), False))
    low, high = batch.column("low").to_numpy(), np.array([len(v) for v in batch.column("left").to_pylist()])
    d = np.arange(WIDTH)[None, :]
    bits &= (d >= low[:, None]) & (d <= high[:, None])
    columns = (bits.astype(np.int64) << d).sum(axis=1)
    some = np.flatnonzero(columns)
    if len(some):
        part = batch.select(["gram", "region", "klass"]).take(pa.array(some)).combine_chunks()
        runs = _ranges(part.column("klass").to_pylist(), columns[some].tolist())
        yield from part.select(["gram", "region"]).append_column("runs", runs).to_batches()


def _ranges(klass: list[int], columns: list[int]) -> pa.Array:
    """Runs of set bits as ranges of distances from the anchor back to the windows' starts."""
    out = []
    for k, bits in zip(klass, columns, strict=True):
        edge = np.flatnonzero(np.diff([0, *(bits >> d & 1 for d in range(WIDTH)), 0]))
        out.append([{"near": k * WIDTH + int(a), "far": k * WIDTH + int(z) - 1} for a, z in zip(edge[::2], edge[1::2], strict=True)])
    return pa.array(out, pa.list_(pa.struct([("near", pa.int32()), ("far", pa.int32())])))


def collections_found(strings: DataFrame) -> DataFrame:
    """RUNS rows: the repeated windows of regions, class by class.

    Collections of up to CHUNK strings are built in one task. In a larger one
    no order of all its strings is needed: its windows are told apart column
    by column by their key and counted with partial sums.
    """
    sizes = stored(strings.groupBy("core").agg(F.count("*").alias("n")).where("n > 1"), "suffix-cores")
    met = strings.join(sizes, "core")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        last = None
        for batch in batches:
            # rows come sorted by core: cut before the core that may go on
            core = batch.column("core").to_numpy()
            cut = int(np.searchsorted(core, core[-1], side="left"))
            if size + cut >= CHUNK // 4 and (cut or last != core[0]):
                whole = pa.Table.from_batches([*held, batch.slice(0, cut)])
                if len(whole):
                    yield from _found(whole.column("core").to_numpy(), whole)
                held, size = [batch.slice(cut)], len(batch) - cut
            else:
                held.append(batch)
                size += len(batch)
            last = core[-1]
        if held:
            whole = pa.Table.from_batches(held)
            yield from _found(whole.column("core").to_numpy(), whole)
        held = whole = None
        give_back()

    n = partitions(strings.sparkSession)
    small = met.where(F.col("n") <= CHUNK).drop("n").repartition(n, "core").sortWithinPartitions("core", "gram", "region", "klass")
    # the exact way for the rest: one key per window
    d = F.explode(F.sequence(F.col("low"), F.length("left")))
    large = met.where(F.col("n") > CHUNK).dropDuplicates(["core", "gram", "region", "klass"]).withColumn("d", d)
    key = F.sha1(F.concat(F.expr("substring(left, length(left) - d + 1, d)"), F.lit(b"|"), F.expr(f"substring(right, 1, {WIDTH - 1} - d)")))
    large = large.select("core", "gram", "region", "klass", "d", key.alias("key"))
    twice = large.groupBy("core", "d", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    rest = large.join(twice, ["core", "d", "key"]).groupBy("gram", "region", "klass").agg(
        F.sum(F.expr("shiftleft(1L, d)")).alias("columns"))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = _ranges(batch.column("klass").to_pylist(), batch.column("columns").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("gram"), batch.column("region"), runs], names=["gram", "region", "runs"])

    return small.mapInArrow(run, RUNS).union(rest.mapInArrow(ranges, RUNS))


def repeated_spans(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, spans): byte ranges [s, e) of repeated windows of every text that has some, sorted, not merged."""
    spark = docs.sparkSession
    buckets = partitions(spark)
    packed = _packed_anchors(docs, text_col, buckets, frequent_anchors(docs, text_col))
    places = stored(_shared_anchors(packed, buckets), "suffix-anchors")
    here = F.struct("node", "lo", "hi", "at")
    regions = stored(places.groupBy("gram", "region").agg(F.min(here).alias("rep"), F.max(here).alias("other")).select(
        "gram", "region", "rep", (F.col("rep") != F.col("other")).alias("whole")), "suffix-regions")
    mixed_grams = regions.groupBy("gram").agg(F.count("*").alias("n"), F.min("whole").alias("all")).where("n > 1 and not all").select("gram")
    reps = regions.join(mixed_grams, "gram").select("gram", "region", "rep.*").join(nodes.select("node", "low_id"), "node")
    strings = stored(_strings(reps, docs, id_col, text_col), "suffix-strings")
    runs = collections_found(strings).groupBy("gram", "region").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    known = stored(regions.join(runs, ["gram", "region"], "left").where("whole or runs is not null").select(
        "gram", "region", "whole", "runs"), "suffix-known")
    whole = F.array(F.struct(F.col("lo").alias("s"), (F.col("hi") + LENGTH).alias("e")))
    parts = F.transform("runs", lambda r: F.struct((F.col("at") - r["far"]).alias("s"), (F.col("at") - r["near"] + LENGTH).alias("e")))
    hits = places.join(known, ["gram", "region"]).select("node", F.when(F.col("whole"), whole).otherwise(parts).alias("some"))
    return hits.groupBy("node").agg(F.array_sort(F.flatten(F.collect_list("some"))).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal ranges of sorted ranges that may overlap or touch."""
    out: list[list[int]] = []
    for x in spans:
        if out and x["s"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], x["e"])
        else:
            out.append([x["s"], x["e"]])
    return [(s, e) for s, e in out]


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def kept_text(data: bytes, spans: list[tuple[int, int]]) -> str:
    """What is left as text: a code point goes if all its bytes go."""
    inner = []
    for s, e in spans:
        while s < e and data[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            inner.append((s, e))
    return kept_bytes(data, inner).decode("utf-8", "replace")


def _facts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sigs = stored(signatures(docs, id_col, text_col), "suffix-signatures")
    nodes = text_nodes(sigs)
    spans = repeated_spans(docs, nodes, id_col, text_col)
    single = nodes.where("copies = 1").join(spans, "node").select("node", "low_id", "spans")
    return sigs, nodes, stored(single, "suffix-spans")


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, n_bytes, n_removed, n_spans, kept_sha256."""
    sigs, nodes, single = _facts(docs, id_col, text_col)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))
    met = texts.join(single, (texts["node"] == single["node"]) & texts["id"].eqNullSafe(single["low_id"])).select(texts["node"], "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, text, spans in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                data, ranges = text.encode("utf-8", "replace"), merged(spans)
                rows.append((node, sum(e - s for s, e in ranges), len(ranges), hashlib.sha256(kept_bytes(data, ranges)).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["node", "n_removed", "n_spans", "kept"])

    removed = met.mapInArrow(run, "node long, n_removed long, n_spans long, kept string")
    all_gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    known = stored(nodes.join(removed, "node", "left").select(
        "node", F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(all_gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha256")).alias("kept_sha256")), "suffix-results")
    return sigs.select("id", "n_bytes", "node").join(known, "node").select(
        F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows with repeated bytes removed from the text (whole code points only); null texts stay null."""
    _, nodes, single = _facts(docs, id_col, text_col)
    known = stored(nodes.select("node", "copies", "n_bytes").join(single.select("node", "spans"), "node", "left").select(
        "node", ((F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)).alias("gone"), "spans"), "suffix-known")
    # the other columns travel in one field, as they may have the names used here
    others = [c for c in docs.columns if c != text_col]
    rest = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    text = F.col(f"`{text_col}`")
    rows = docs.select(text.alias("text"), rest.alias("rest"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("node"))
    rows = rows.join(known, "node").select("text", "gone", "spans", "rest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone, spans in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if text is not None and gone:
                    text = ""
                elif text is not None and spans:
                    text = kept_text(text.encode("utf-8", "replace"), merged(spans))
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(3)], names=["text", "rest"])

    done = rows.mapInArrow(run, rows.select("text", "rest").schema)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.c{others.index(c)}").alias(c) for c in docs.columns])
