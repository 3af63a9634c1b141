"""Language-model scoring with Katz backoff over word bigrams (operator 7).

Every word keeps its own bigram counts, as a context and as the next word. The
VOCABULARY most frequent words (counted over all training texts) have a number,
so that pairs of them are four bytes; this only routes the counts. All other
words, the rare ones, are known by their hash and share the number RARE_CLASS:

    P(w | v)   v frequent, w frequent: Katz over the words' numbers, RARE_CLASS among them
               v frequent, w rare:     P(RARE_CLASS | v) * Q(w | v), Q by Katz over the rare words after v, backing off to P(w | RARE_CLASS)
               v rare:                 Katz over the words after v, backing off to P(w)
    P(w)       of a rare word: P(RARE_CLASS) * P(w | RARE_CLASS)

Counts up to CUTOFF are discounted by Good-Turing, the mass that this frees
goes to what is unseen after the context in proportion to the lower order,
with a weight per context that makes the probabilities sum to one exactly
(``backoff``). P(w | RARE_CLASS) discounts in the same way; what it frees is
the probability of an unknown word. A context that training lacks leaves the
lower order as it is.

Counts are packed types (pairs of numbers; pairs with a rare word) per task
and flush, summed in the partition of their hash, and stored as a table
partitioned by it. Pairs with a rare next word lie with that word, where its
count is known, and move on to their context, if it is rare too. Scoring sends
a document's pairs to the same partitions, where they meet the table; very
frequent pairs (above FREQUENT of all, so at most 1 / FREQUENT of them) are
looked up before anything is sent, so no pair is hot. What is broadcast is
bounded by VOCABULARY.

Rules for odd rows: a null text is empty and has the end token only; texts
that are equal have equal scores and count as often as they occur; without
training rows the model is uniform; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import batches_of, give_back, partitions, stored
from parcelwise.llm.shingles import mixed, word_hashes

#: Words with a number of their own, and numbers that all others share (their counts are kept by hash).
VOCABULARY = 60_000
RARE = 1
#: Counts above this are not discounted.
CUTOFF = 5
#: Pairs above this share of all are looked up where the documents are read.
FREQUENT = 1e-6
#: Tokens that a task packs before it sends them on.
FLUSH = 500_000
BATCH_BYTES = 1 << 18
#: Sums of documents that a partition of the table holds before it adds up those of one document.
FOLD = 100_000
#: Documents whose sums it holds before it sends these on; what is met later is added up with them.
HELD_DOCS = 250_000
#: Bytes of a batch between the JVM and Python.
ARROW_BYTES = "4m"

CLASSES = 1 << 16
END = 0
START = CLASSES - 1  # a context only
RARE_CLASS = 1 + VOCABULARY

BLOBS = "bucket int, kind int, a binary, b binary, c binary"
# pairs of numbers, rare words; rare next words by their context, rare contexts by a frequent next word; frequent contexts of a rare word; pairs of rare words
(PAIR_TYPES, RARE_TYPES, INTO_TYPES, AFTER_TYPES, LED_TYPES, BOTH_TYPES,
 PAIR_TABLE, RARE_TABLE, LED_TABLE, AFTER_TABLE, DOC_PAIRS, DOC_RARE, DOC_AFTER, DOC_SUMS) = range(14)


def class_of(h: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Numbers of words by hash: 1.. for frequent words, RARE_CLASS for all others."""
    if not len(frequent):
        return np.full(len(h), RARE_CLASS, np.uint32)
    at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
    return np.where(frequent[at] == h, at + 1, RARE_CLASS).astype(np.uint32)


def token_classes(texts: list[bytes], frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token incl. the end: pair of numbers, owner, its own and its context's id (the number, or the hash of a rare word); tokens per text."""
    starts, h = word_hashes(b"\n".join(texts))
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(starts, edges)
    count = np.diff(first)
    classes = class_of(h, frequent)
    ids = np.where(classes == RARE_CLASS, h, classes.astype(np.uint64))
    # events: the words of each text and its end; contexts: the start and the words
    event = np.insert(classes, first[1:], END)
    context = np.insert(classes, first[:-1], START)
    tokens = count + 1
    pair = (context.astype(np.uint32) << np.uint32(16)) | event.astype(np.uint32)
    return pair, np.repeat(np.arange(len(texts)), tokens), np.insert(ids, first[1:], np.uint64(END)), np.insert(ids, first[:-1], np.uint64(START)), tokens


def _place(key: np.ndarray) -> np.ndarray:
    return mixed(key.astype(np.uint64) + np.uint64(0x51ED27))


def _rare(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that are rare words, and tokens after one."""
    return pair & np.uint32(0xFFFF) == RARE_CLASS, pair >> np.uint32(16) == RARE_CLASS


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Partitions are ranges of places."""
    return ((_place(key) >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int64)


def _pieces(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, int)
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(bucket[s]), s, e


def _blob(bucket: int, kind: int, *arrays: np.ndarray) -> tuple:
    parts = [x.tobytes() for x in arrays]
    return (bucket, kind, *parts, *[b""] * (3 - len(parts)))


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "kind", "a", "b", "c"])


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """A few blobs at a time."""
    for s in range(0, len(rows), 16):
        yield _blobs(rows[s:s + 16])


def _type_blobs(kind: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> list[tuple]:
    bucket = _bucket(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    keys, counts, bucket = keys[order], counts[order], bucket[order]
    return [_blob(b, kind, keys[s:e], counts[s:e].astype(np.uint32)) for b, s, e in _pieces(bucket)]


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Slices of at most about BATCH_BYTES: their starts and their texts as lower-cased bytes."""
    column = texts.cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    at = 0
    while at < len(sizes):
        end, size = at, 0
        while end < len(sizes) and (end == at or size + sizes[end] < BATCH_BYTES):
            size += sizes[end]
            end += 1
        yield at, [(t or b"").lower() for t in column.slice(at, end - at).to_pylist()]
        at = end


def frequent_words(training: DataFrame, text_col: str) -> np.ndarray:
    """Sorted hashes of the most frequent words of all training texts (at most VOCABULARY).

    Words are counted like the types below. How many words there are of each
    count gives the least count that fits; of the words with that count, those
    with the smallest places (see ``_place``) are taken, and partitions are
    ranges of places, so each one knows its own part of them.
    """
    buckets = partitions(training.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, group in _groups(batch.column(0)):
                held.append(word_hashes(b"\n".join(group))[1])
                size += len(held[-1])
                if size >= FLUSH:
                    yield from _batches(_type_blobs(RARE_TYPES, *np.unique(np.concatenate(held), return_counts=True), buckets))
                    held, size = [], 0
        if held:
            yield from _batches(_type_blobs(RARE_TYPES, *np.unique(np.concatenate(held), return_counts=True), buckets))
        held = []
        give_back()

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _parts(batches):
            values, words = np.unique(np.frombuffer(parts[0][1], np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(words)], names=["n", "words"])

    table = _summed(training.select(text_col).mapInArrow(packed, BLOBS), buckets, "katz-words")
    least, room = 0, VOCABULARY  # all words above ``least`` fit, and ``room`` of those with that count
    for r in table.mapInArrow(levels, "n long, words long").groupBy("n").agg(F.sum("words").alias("words")).orderBy(F.desc("n")).toLocalIterator():
        if r["words"] > room:
            least = r["n"]
            break
        room -= r["words"]

    def tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, _), parts in _parts(batches):
            n = int((np.frombuffer(parts[0][1], np.int64) == least).sum())
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([n], pa.int64())], names=["bucket", "n"])

    quota = {}
    if least and room:
        for r in sorted(table.mapInArrow(tied, "bucket int, n long").collect()):
            quota[r["bucket"]] = min(r["n"], room)
            room -= quota[r["bucket"]]

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, _), parts in _parts(batches):
            h, n = np.frombuffer(parts[0][0], np.uint64), np.frombuffer(parts[0][1], np.int64)
            some = h[n == least]
            some = some[np.argsort(_place(some))[:quota.get(bucket, 0)]]
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([h[n > least], some]).tobytes()], pa.binary())], names=["words"])

    rows = table.mapInArrow(taken, "words binary").collect()
    return np.sort(np.frombuffer(b"".join(bytes(r["words"]) for r in rows), np.uint64))


def _distinct(*keys: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """Distinct rows of parallel columns sorted by the first, then the next; the order of the rows and the start of every distinct one in it."""
    order = np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    return tuple(k[starts] for k in keys), order, starts


def _totals(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values[order], starts) if len(starts) else values[:0]


def _link_blobs(kind: int, near: np.ndarray, other: np.ndarray, buckets: int) -> list[tuple]:
    """Distinct pairs with their counts, by the partition of ``near``."""
    (near, other), order, starts = _distinct(near, other)
    counts, bucket = np.diff(np.append(starts, len(order))), _bucket(near, buckets)
    order = np.argsort(bucket, kind="stable")
    near, other, counts, bucket = near[order], other[order], counts[order], bucket[order]
    return [_blob(b, kind, near[s:e], counts[s:e].astype(np.uint32), other[s:e]) for b, s, e in _pieces(bucket)]


def count_types(training: DataFrame, text_col: str, frequent: np.ndarray, buckets: int) -> DataFrame:
    """The counts of pairs of numbers and of rare words: per partition one row of each (keys, counts)."""
    return count_all(training, text_col, frequent, buckets).where(F.col("kind").isin(PAIR_TYPES, RARE_TYPES))


def count_all(training: DataFrame, text_col: str, frequent: np.ndarray, buckets: int) -> DataFrame:
    """The counts table: per partition one row each of

    pairs of numbers (pair, count); rare words (hash, count); frequent contexts of rare words (place of the word among them and
    number of the context, count, counts of the words); pairs of rare words (word, count and the word's own, context);
    frequent words after rare ones (context, count, number).
    """
    shared = training.sparkSession.sparkContext.broadcast(frequent)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, into, after, size = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            yield from _batches(_type_blobs(PAIR_TYPES, *np.unique(np.concatenate(pairs), return_counts=True), buckets))
            for kind, held in ((INTO_TYPES, into), (AFTER_TYPES, after)):
                yield from _batches(_link_blobs(kind, *(np.concatenate(h) for h in zip(*held, strict=True)), buckets))

        for batch in batches:
            for _, group in _groups(batch.column(0)):
                pair, _, event, context, _ = token_classes(group, shared.value)
                rare, led = _rare(pair)
                pairs.append(pair)
                into.append((event[rare], context[rare]))
                after.append((context[led & ~rare], event[led & ~rare]))
                size += len(pair)
                if size >= FLUSH:
                    yield from flush()
                    pairs, into, after, size = [], [], [], 0
        if pairs:
            yield from flush()
        pairs, into, after = [], [], []
        give_back()

    return _summed(training.select(text_col).mapInArrow(packed, BLOBS), buckets, "katz-types")


def _summed(blobs: DataFrame, buckets: int, name: str) -> DataFrame:
    """Counts of packed types, summed in the partition of their hash and stored: one row per partition and kind (see ``count_all``)."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, kind), parts in _parts(batches):
            if kind in (INTO_TYPES, AFTER_TYPES):
                (near, other), order, starts = _distinct(*(np.concatenate([np.frombuffer(p[k], np.uint64) for p in parts]) for k in (0, 2)))
                n = _totals(np.concatenate([np.frombuffer(b, np.uint32) for _, b, _ in parts]).astype(np.int64), order, starts)
                if kind == AFTER_TYPES:
                    yield _blobs([_blob(bucket, kind, near, n, other)])
                    continue
                words, at = np.unique(near, return_inverse=True)
                count = np.bincount(at, n, len(words)).astype(np.int64)
                led = other < CLASSES
                yield _blobs([_blob(bucket, RARE_TYPES, words, count),
                              _blob(bucket, LED_TYPES, (at[led].astype(np.uint64) << np.uint64(16)) | other[led], n[led], count),
                              _blob(bucket, BOTH_TYPES, near[~led], np.stack([n[~led], count[at[~led]]]), other[~led])])
                continue
            keys = np.concatenate([np.frombuffer(a, np.uint32 if kind == PAIR_TYPES else np.uint64) for a, _, _ in parts])
            counts = np.concatenate([np.frombuffer(b, np.uint32) for _, b, _ in parts])
            values, group = np.unique(keys, return_inverse=True)
            yield _blobs([_blob(bucket, kind, values, np.bincount(group, counts, len(values)).astype(np.int64))])
        give_back()

    return stored(blobs.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(summed, BLOBS), name)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[tuple]]]:
    """Blobs of rows sorted by (bucket, kind), gathered by it."""
    current, parts = None, []
    for batch in batches:
        for bucket, kind, *blob in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if parts and (bucket, kind) != current:
                yield current, parts
                parts = []
            current = (bucket, kind)
            parts.append(tuple(blob))
    if parts:
        yield current, parts


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[tuple]]]:
    """Blobs one by one, in the order they come."""
    for batch in batches:
        for k in range(batch.num_rows):
            bucket, kind, *blob = (batch.column(c)[k].as_py() for c in range(5))
            yield (bucket, kind), [tuple(blob)]


def good_turing(n: np.ndarray, cutoff: int = CUTOFF) -> np.ndarray:
    """Discount ratios d[0..cutoff+1] (d[r] * r is the discounted count) from counts of counts n[r]; d[cutoff+1] = 1.

    Katz's formula; where the counts of counts are too irregular for it, absolute discounting.
    """
    d = np.ones(cutoff + 2)
    n1, n2 = float(n[1]), float(n[2])
    if not n1:
        return d
    common = (cutoff + 1) * n[cutoff + 1] / n1
    ratios = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else 0.0 for r in range(1, cutoff + 1)]
    if all(0 < x < 1 for x in ratios):
        d[1:cutoff + 1] = ratios
    else:
        off = n1 / (n1 + 2 * n2) if n2 else 0.5
        d[1:cutoff + 1] = [(r - min(off, 0.9)) / r for r in range(1, cutoff + 1)]
    return d


def backoff(total: np.ndarray, kept: np.ndarray, lower: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Per context: the factor of what it has seen, and log10 of the weight of the lower order for what it has not.

    From its counts, the discounted ones, and the lower order's share of what it has seen; of that order at least ``least`` is never seen.
    """
    factor = np.where(total - kept < 1e-9 * total, total / (total + 1), 1.0)  # nothing was discounted: one count's worth for what is unseen
    return factor, np.log10((1 - factor * kept / total) / np.maximum(1 - lower, least))


@dataclass
class Model:
    """What is shared with every task: arrays by class (a word's number), discounts and frequent pairs."""

    frequent: np.ndarray  # hashes of words with a number of their own
    tokens: int  # training tokens
    distinct: int  # distinct training tokens
    counts: np.ndarray  # training tokens by class
    uni: np.ndarray  # log10 P(class)
    pair_discount: np.ndarray
    word_discount: np.ndarray
    link_discount: np.ndarray  # of pairs with a rare word
    total: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))  # tokens after a context
    alpha: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))  # log10 backoff weight of a context
    gamma: np.ndarray = field(default_factory=lambda: np.ones(CLASSES))  # factor of a context's seen events
    scale: np.ndarray = field(default_factory=lambda: np.ones(CLASSES))  # factor of a class's known words
    unknown: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))  # log10 P(unknown word | class)
    into: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))  # log10 P(RARE_CLASS | context)
    rare_total: np.ndarray = field(default_factory=lambda: np.ones(CLASSES))  # rare words after a context
    rare_alpha: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES))  # log10 weight of P(w | RARE_CLASS) there
    rare_gamma: np.ndarray = field(default_factory=lambda: np.ones(CLASSES))
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))  # frequent pairs and their log10 probabilities
    pair_logs: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def seen(self, pair: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 P(class | context) of pairs that training has, by Good-Turing."""
        context = pair >> np.uint32(16)
        d = self.pair_discount[np.minimum(count, CUTOFF + 1)]
        return np.log10(self.gamma[context] * d * count / self.total[context])

    def backed_off(self, pair: np.ndarray) -> np.ndarray:
        """log10 P of pairs that training lacks: the context's weight and, one order down, the class's probability."""
        return self.alpha[pair >> np.uint32(16)] + self.uni[pair & np.uint32(0xFFFF)]

    def known(self, h: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 P(word | RARE_CLASS) of rare words that training has so often."""
        return np.log10(self.scale[RARE_CLASS] * self.word_discount[np.minimum(count, CUTOFF + 1)] * count / np.maximum(self.counts[RARE_CLASS], 1))

    def unseen(self, h: np.ndarray) -> np.ndarray:
        return np.full(len(h), self.unknown[RARE_CLASS])

    def led(self, context: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 Q(word | context) of rare words that training has after that frequent context."""
        return np.log10(self.rare_gamma[context] * self.link_discount[np.minimum(count, CUTOFF + 1)] * count / self.rare_total[context])

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def _sums(table: DataFrame, run, names: list[str]) -> dict[tuple[int, int], np.ndarray]:
    """Totals of (what, key, values...) rows over the counts table; keys are classes or counts, so few."""
    schema = "what int, key int, " + ", ".join(f"{n} double" for n in names)
    rows = table.mapInArrow(run, schema).groupBy("what", "key").agg(*[F.sum(n).alias(n) for n in names]).collect()
    return {(r["what"], r["key"]): np.array([r[n] for n in names]) for r in rows}


def _summary(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32()] + [pa.float64()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["what", "key", *names])


def fit(types: DataFrame, frequent: np.ndarray) -> Model:
    """Discounts, probabilities and backoff weights from the counts table: three scans, results by class or count.

    The weights of rare contexts are worked out where their pairs meet (``after_table``).
    """

    def counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, kind), parts in _parts(batches):
            for a, b, _ in parts:
                n = np.frombuffer(b, np.int64)
                n = n[:len(n) // 2] if kind == BOTH_TYPES else n
                level = np.bincount(np.minimum(n, CUTOFF + 2), minlength=CUTOFF + 3)
                yield _summary([np.full(CUTOFF + 3, kind if kind in (PAIR_TYPES, RARE_TYPES) else LED_TYPES), np.arange(CUTOFF + 3), level.astype(float)], ["n"])
                if kind == PAIR_TYPES:
                    event = np.frombuffer(a, np.uint32) & np.uint32(0xFFFF)
                    total = np.bincount(event, n, CLASSES)
                    some = np.flatnonzero(total)
                    yield _summary([np.full(len(some), 100), some, total[some]], ["n"])

    first = _sums(types, counts_of, ["n"])
    counts = np.zeros(CLASSES)
    for (what, key), v in first.items():
        if what == 100:
            counts[key] = v[0]
    level = {kind: np.array([first.get((kind, r), np.zeros(1))[0] for r in range(CUTOFF + 3)]) for kind in (PAIR_TYPES, RARE_TYPES, LED_TYPES)}
    tokens = int(counts.sum())
    events = 1 + len(frequent) + RARE
    uni = np.full(CLASSES, -np.inf)
    used = np.r_[0:1 + len(frequent), 1 + VOCABULARY:1 + VOCABULARY + RARE]
    uni[used] = np.log10((counts[used] + 0.5) / (tokens + 0.5 * events))
    distinct = int((counts[:1 + len(frequent)] > 0).sum() + level[RARE_TYPES].sum())
    model = Model(frequent, tokens, distinct, counts, uni, *(good_turing(level[kind]) for kind in (PAIR_TYPES, RARE_TYPES, LED_TYPES)))
    shared = types.sparkSession.sparkContext.broadcast(model)
    names = ["total", "kept", "lower"]

    def by_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for (_, kind), parts in _parts(batches):
            for a, b, c in parts if kind in (PAIR_TYPES, RARE_TYPES, LED_TYPES) else ():
                n = np.frombuffer(b, np.int64)
                if kind == PAIR_TYPES:
                    pair = np.frombuffer(a, np.uint32)
                    into = pair & np.uint32(0xFFFF) == RARE_CLASS
                    yield _summary([np.full(into.sum(), 100), pair[into] >> np.uint32(16), n[into].astype(float), *np.zeros((2, into.sum()))], names)
                    key, kept = pair >> np.uint32(16), m.pair_discount[np.minimum(n, CUTOFF + 1)] * n
                    lower = 10 ** m.uni[pair & np.uint32(0xFFFF)]
                elif kind == LED_TYPES:
                    at, count = np.frombuffer(a, np.uint64), np.frombuffer(c, np.int64)
                    key, kept = (at & np.uint64(0xFFFF)).astype(np.int64), m.link_discount[np.minimum(n, CUTOFF + 1)] * n
                    lower = 10 ** m.known(count, count)[(at >> np.uint64(16)).astype(np.int64)]  # the scale comes with this scan
                else:
                    key = np.full(len(n), RARE_CLASS)
                    kept, lower = m.word_discount[np.minimum(n, CUTOFF + 1)] * n, np.zeros(len(n))
                sums = [np.bincount(key, x, CLASSES) for x in (n, kept, lower)]
                some = np.flatnonzero(sums[0])
                yield _summary([np.full(len(some), kind), some, *(x[some] for x in sums)], names)

    found = _sums(types, by_context, names)
    for (what, key), (total, kept, lower) in found.items():
        if total - kept < 1e-9 * total:  # nothing was discounted: keep one count's worth for what is unseen
            factor = total / (total + 1)
        else:
            factor = 1.0
        if what == PAIR_TYPES:
            model.total[key] = total
            rest = 1.0 - lower
            if rest < 1e-9:  # the context has seen every class
                model.gamma[key], model.alpha[key] = total / kept, -np.inf
            else:
                model.gamma[key], model.alpha[key] = factor, np.log10((1 - factor * kept / total) / rest)
        elif what == RARE_TYPES:
            model.scale[key], model.unknown[key] = factor, np.log10(1 - factor * kept / total)
    contexts = np.arange(CLASSES, dtype=np.uint32)
    model.into = model.backed_off((contexts << np.uint32(16)) | np.uint32(RARE_CLASS))
    for (what, key), sums in found.items():
        if what == LED_TYPES:
            total, kept, lower = sums * [1.0, 1.0, model.scale[RARE_CLASS]]
            model.rare_total[key] = total
            model.rare_gamma[key], model.rare_alpha[key] = backoff(total, kept, lower, 10 ** model.unknown[RARE_CLASS])
        elif what == 100:
            model.into[key] = model.seen((contexts[key:key + 1] << np.uint32(16)) | np.uint32(RARE_CLASS), sums[:1].astype(np.int64))[0]
    least = max(2.0, FREQUENT * tokens)
    again = types.sparkSession.sparkContext.broadcast(model)

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, kind), parts in _parts(batches):
            for a, b, _ in parts if kind == PAIR_TYPES else ():
                n = np.frombuffer(b, np.int64)
                pair = np.frombuffer(a, np.uint32)[n >= least]
                logs = again.value.seen(pair, n[n >= least])
                yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(logs)], names=["pair", "log"])

    if tokens * FREQUENT >= 2.0:  # else every pair would be frequent; a small table needs no short cut
        rows = sorted((r["pair"], r["log"]) for r in types.mapInArrow(top, "pair long, log double").collect())
        model.pairs = np.array([r[0] for r in rows], dtype=np.uint32)
        model.pair_logs = np.array([r[1] for r in rows], dtype=np.float64)
    return model


def _lookup(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, place) of keys in a sorted table."""
    if not len(table):
        return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys, at


SUMS = "place int, nodes binary, small binary, logs binary"
PARTS = "node long, sent long, n_tokens long, n_known long, base double, score double"


def _link_keys(place: np.ndarray, event: np.ndarray) -> np.ndarray:
    """One key for a rare context (its place in its partition) and the id of the next word."""
    return mixed(event + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def met_by(tables: dict, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(found, place, count) of keys in a table of a partition."""
    table, n = tables.get(kind, (keys[:0], np.zeros(0, np.int64)))
    found, at = _lookup(keys, table)
    return found, at, np.where(found, n[at] if len(n) else 0, 0)


def after_table(m: Model, pieces: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What is known after the rare contexts of a partition: contexts and log10 of their weights, and sorted pairs with their logs.

    The log of a pair of rare words is relative to P(word | RARE_CLASS), which is added where the word's count lies.
    """
    context, event = (np.concatenate([np.frombuffer(p[k], np.uint64) for p in pieces]) for k in (0, 2))
    n, count = np.concatenate([np.frombuffer(p[1], np.int64).reshape(2, -1) for p in pieces], axis=1)
    contexts, at = np.unique(context, return_inverse=True)
    rare = event >= CLASSES
    word = np.zeros(len(n))
    word[rare] = m.known(event[rare], count[rare])
    lower = m.uni[np.where(rare, RARE_CLASS, event).astype(np.int64)] + word
    kept = m.link_discount[np.minimum(n, CUTOFF + 1)] * n
    total = np.bincount(at, n, len(contexts))
    gamma, alpha = backoff(total, np.bincount(at, kept, len(contexts)), np.bincount(at, 10 ** lower, len(contexts)),
                           10 ** (m.uni[RARE_CLASS] + m.unknown[RARE_CLASS]))
    keys = _link_keys(at, event)
    order = np.argsort(keys)
    return contexts, alpha, keys[order], (np.log10(gamma[at] * kept / total[at]) - word)[order]


def score_texts(docs: DataFrame, text_col: str, types: DataFrame, model: Model, buckets: int) -> DataFrame:
    """PARTS rows, one per text; ``sent`` counts how often it was sent (once per task that holds copies).

    What a partition of the table finds out about its documents travels on
    packed by the partition of the document, where it is added up.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen, held, size = shared.value, set(), [], 0

        def flush() -> list[tuple]:
            node, tokens, known, base, score = (np.concatenate([h[0][k] for h in held]) for k in range(5))
            place = _bucket(node.view(np.uint64), buckets)
            order = np.argsort(place, kind="stable")
            rows = [_blob(b, DOC_SUMS, node[order][s:e], np.stack([base[order][s:e], score[order][s:e]]), np.stack([tokens[order][s:e], known[order][s:e]]))
                    for b, s, e in _pieces(place[order])]
            for kind, k in ((DOC_PAIRS, 1), (DOC_RARE, 2), (DOC_AFTER, 3)):
                own, count, key, *other = (np.concatenate(c) for c in zip(*(h[k] for h in held), strict=True))
                bucket = _bucket(key, buckets)
                order = np.argsort(bucket, kind="stable")
                key, own, count, bucket = key[order], own[order], count[order], bucket[order]
                other = [x[order] for x in other]
                for b, s, e in _pieces(bucket):
                    turn = np.flatnonzero(np.concatenate([[True], own[s + 1:e] != own[s:e - 1], [True]]))
                    row = _blob(b, kind, np.stack([own[s:e][turn[:-1]], np.diff(turn)]), key[s:e], count[s:e].astype(np.uint32))
                    rows.append((*row[:3], row[3] + b"".join(x[s:e].tobytes() for x in other), row[4]))
            return rows

        for batch in batches:
            keys = batch.column(0).to_pylist()
            fresh = [k for k, key in enumerate(keys) if key not in seen and not seen.add(key)]  # copies within a task travel once
            for start, group in _groups(batch.column(1).take(pa.array(fresh, pa.int64()))):
                node = np.array([keys[k] for k in fresh[start:start + len(group)]], dtype=np.int64)
                pair, own, event, context, tokens = token_classes(group, m.frequent)
                rare, led = _rare(pair)
                n = m.counts[pair[~rare] & np.uint32(0xFFFF)]  # base terms of frequent words and ends
                base = np.bincount(own[~rare], m.base(n), len(group))
                known = np.bincount(own[~rare], n > 0, len(group)).astype(np.int64)
                plain, plain_own = pair[~(rare | led)], own[~(rare | led)]
                found, at = _lookup(plain, m.pairs)
                score = np.bincount(plain_own[found], m.pair_logs[at[found]], len(group)) if len(m.pairs) else np.zeros(len(group))
                entries = []
                for keys_of in ((plain_own[~found], plain[~found]), (own[rare], event[rare], (pair[rare] >> np.uint32(16)).astype(np.uint16)),
                                (own[led], context[led], event[led])):
                    (one, *key), order, starts = _distinct(*keys_of)
                    entries.append((node[one], np.diff(np.append(starts, len(order))), *key))
                held.append(((node, tokens, known, base, score), *entries))
                size += len(pair)
                if size >= FLUSH:
                    yield from _batches(flush())
                    held, size, seen = [], 0, set()
        if held:
            yield from _batches(flush())
        held, seen = [], set()
        give_back()

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, kind), parts in _parts(batches):
            for a, b, c in parts:
                if kind in (AFTER_TYPES, BOTH_TYPES):
                    near, other = (a, c) if kind == AFTER_TYPES else (c, a)
                    context, event, n = np.frombuffer(near, np.uint64), np.frombuffer(other, np.uint64), np.frombuffer(b, np.int64)
                    n = np.stack([n, np.zeros_like(n)]) if kind == AFTER_TYPES else n.reshape(2, -1)
                    place = _bucket(context, buckets)
                    order = np.argsort(place, kind="stable")
                    yield from _batches([_blob(p, AFTER_TABLE, context[order[s:e]], n[:, order[s:e]], event[order[s:e]]) for p, s, e in _pieces(place[order])])
                else:
                    yield _blobs([(bucket, {PAIR_TYPES: PAIR_TABLE, RARE_TYPES: RARE_TABLE, LED_TYPES: LED_TABLE}[kind], a, b, b"")])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, tables, here = shared.value, {}, None
        nodes, values, held, least = [], [], 0, FOLD

        def folded() -> tuple[np.ndarray, np.ndarray]:
            ids, group = np.unique(np.concatenate(nodes), return_inverse=True)
            return ids, np.stack([np.bincount(group, np.concatenate([v[k] for v in values]), len(ids)) for k in range(5)])

        def sums() -> Iterator[pa.RecordBatch]:
            ids, total = folded()
            place = _bucket(ids.view(np.uint64), buckets)
            order = np.argsort(place, kind="stable")
            small, logs = np.rint(total[:3]).astype(np.uint64)[:, order], total[3:][:, order]
            for b, s, e in _pieces(place[order]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (ids[order][s:e], small[:, s:e], logs[:, s:e]))],
                    names=["place", "nodes", "small", "logs"])

        for (bucket, kind), parts in _each(batches):
            if bucket != here:
                if nodes:
                    yield from sums()
                tables, here, nodes, values, held, least = {}, bucket, [], [], 0, FOLD
            if kind in (PAIR_TABLE, RARE_TABLE, LED_TABLE):
                width = np.uint32 if kind == PAIR_TABLE else np.uint64
                tables[kind] = (np.frombuffer(parts[0][0], width), np.frombuffer(parts[0][1], np.int64))
                continue
            if kind == AFTER_TABLE:
                tables.setdefault(kind, []).extend(parts)
                continue
            if kind == DOC_AFTER and isinstance(tables.get(AFTER_TABLE), list):
                tables[AFTER_TABLE] = after_table(m, tables[AFTER_TABLE])
            for a, b, c in parts:
                if kind == DOC_SUMS:
                    node = np.frombuffer(a, np.int64)
                    base, score = np.frombuffer(b, np.float64).reshape(2, -1)
                    tokens, known = np.frombuffer(c, np.int64).reshape(2, -1)
                    value = np.stack([np.ones(len(node)), tokens, known, base, score])
                else:
                    runs = np.frombuffer(a, np.int64).reshape(2, -1)
                    count = np.frombuffer(c, np.uint32).astype(np.float64)
                    key = np.frombuffer(b, np.uint32 if kind == DOC_PAIRS else np.uint64, len(count))
                    log, value = np.zeros(len(key)), np.zeros((5, len(key)))
                    if kind == DOC_PAIRS:
                        found, at, n = met_by(tables, PAIR_TABLE, key)
                        log[found] = m.seen(key[found], n[found])
                        log[~found] = m.backed_off(key[~found])
                    elif kind == DOC_RARE:
                        context = np.frombuffer(b, np.uint16, len(count), 8 * len(count))
                        found, at, n = met_by(tables, RARE_TABLE, key)
                        log[found] = m.known(key[found], n[found])
                        log[~found] = m.unseen(key[~found])
                        after, _, pairs = met_by(tables, LED_TABLE, (at.astype(np.uint64) << np.uint64(16)) | context)
                        after &= found
                        log[after] = m.led(context[after], pairs[after])
                        log[~after] += np.where(context[~after] == RARE_CLASS, 0.0, m.rare_alpha[context[~after]])
                        log += np.where(context == RARE_CLASS, 0.0, m.into[context])
                        value[2] = found * count
                        value[3] = count * m.base(n)
                    else:
                        event = np.frombuffer(b, np.uint64, len(count), 8 * len(count))
                        contexts, alpha, pairs, logs = tables.get(AFTER_TABLE, (key[:0], log[:0], key[:0], log[:0]))
                        found, at = _lookup(key, contexts)
                        log = m.uni[np.where(event < CLASSES, event, RARE_CLASS).astype(np.int64)]
                        log[found] += alpha[at[found]]
                        after, pair = _lookup(_link_keys(at, event), pairs)
                        after &= found
                        log[after] = logs[pair[after]]
                    value[4] = count * log
                    starts = np.cumsum(runs[1]) - runs[1]
                    value = np.add.reduceat(value, starts, axis=1)
                    node = runs[0]
                nodes.append(node)
                values.append(value)
                held += len(node)
            if held >= least:  # one entry per document stays
                ids, total = folded()
                nodes, values, held = [ids], [total], len(ids)
                least = max(FOLD, 2 * held)
            if len(nodes) == 1 and held >= HELD_DOCS:
                yield from sums()
                nodes, values, held, least = [], [], 0, FOLD
        if nodes:
            yield from sums()
        tables, nodes, values = {}, [], []
        give_back()

    texts = docs.select(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("node"), text_col)
    blobs = texts.mapInArrow(sent, BLOBS).union(types.mapInArrow(tables, BLOBS))
    found = blobs.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(met, SUMS)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(parts: list[list[bytes]]) -> pa.RecordBatch:
            ids, group = np.unique(np.concatenate([np.frombuffer(n, np.int64) for n, _, _ in parts]), return_inverse=True)
            small = np.concatenate([np.frombuffer(s, np.uint64).reshape(3, -1) for _, s, _ in parts], axis=1)
            logs = np.concatenate([np.frombuffer(x, np.float64).reshape(2, -1) for _, _, x in parts], axis=1)
            whole = [np.rint(np.bincount(group, v, len(ids))).astype(np.int64) for v in small]
            return pa.RecordBatch.from_arrays([pa.array(ids), *map(pa.array, whole), *(pa.array(np.bincount(group, v, len(ids))) for v in logs)],
                                              names=["node", "sent", "n_tokens", "n_known", "base", "score"])

        current, parts = None, []
        for batch in batches:
            for place, *part in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if place != current and parts:
                    yield rows(parts)
                    parts = []
                current = place
                parts.append(part)
        if parts:
            yield rows(parts)
        parts = []
        give_back()

    return found.repartition(buckets, "place").sortWithinPartitions("place").mapInArrow(added, PARTS)


def held_out(id_col: str) -> Column:
    """Rows that learning never sees: crc32 of the id as text, mod 5, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def score_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows that are not held out; one row per input row with counts and scores."""
    spark = docs.sparkSession
    buckets = partitions(spark)
    training = docs.where(~held_out(id_col))
    with batches_of(spark, ARROW_BYTES):
        frequent = frequent_words(training, text_col)
        types = count_all(training, text_col, frequent, buckets)
        model = fit(types, frequent)
        sums = score_texts(docs, text_col, types, model, buckets)
        known = stored(sums.select("node", *[(F.col(c) / F.col("sent")).alias(c) for c in ("n_tokens", "n_known", "base", "score")]), "katz-scores")
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("node"))
    return rows.join(known, "node").select(
        id_col, "held_out", F.col("n_tokens").cast("long").alias("n_tokens"), F.col("n_known").cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
