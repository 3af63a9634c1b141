"""Packing by lexical retrieval (operator 6).

Documents are tokenised and packed into fixed windows together with documents
that share their rare terms. The corpus is sharded: a task reads its input in
shards of bounded size, builds a BM25 inverted index (token id -> postings) of
the shard, and fills one window after another: a seed document (the longest
unused one) goes in first, the index returns its best unused neighbours, those
that fit are added greedily, and the best one left is cut to fill the window
to the last token. What is cut off stays an unused document. When the best
neighbours are used up, the next ones follow, and when the rarest terms have
no more, further terms of the seed are looked up; only when no unused document
shares a term with it do the next documents in line fill the window. So only
the last window of a shard can need padding; its content is cut at powers of
two.

Nothing is shuffled: a shard is a run of consecutive rows of an input split,
and memory is bounded by the shard and the longest document in it. With
``forget`` a worker keeps a smaller part of the token ids that it knows between tasks.

Rules for odd rows: a null or empty text is the end token alone; a document
longer than the window fills whole windows of its own first; repeated rows are
separate documents; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from parcelwise.llm.common import give_back

WINDOW = 2048
END_ID = 1
#: A shard is closed at so many tokens or documents.
SHARD_TOKENS = 1_500_000
SHARD_DOCS = 4096
#: Rarest terms of a seed that are looked up first, and neighbours that are handed out at once.
QUERY_TERMS = 24
NEIGHBOURS = 32
K1, B = 1.2, 0.75
#: White-space runs and words whose token ids a Python worker remembers.
CACHE_RUNS = 1_800_000
CACHE_WORDS = 1_000_000
#: What it still remembers when a task has ended: an idle worker's memory is missing elsewhere.
KEPT_RUNS = 600_000
KEPT_WORDS = 500_000

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


class WordTokenizer:
    """Token ids of UTF-8 texts for a vocabulary whose words never reach across ASCII white space.

    Ids of a text are the ids of its white-space runs in order, and ids of a
    run are those of its words (the pieces that the vocabulary's pre-tokeniser
    cuts; a word's last id is marked as a word end). Both levels are
    remembered. Runs outside plain Latin letters, and runs that may hold a
    special token, go to the tokenizer whole. Ids are below 65,536 and kept
    as 16-bit numbers.
    """

    _PLAIN = re.compile(r"[\n!-~\u00a1-\u012f\u0131-\u024f]+")
    #: The pre-tokeniser's pattern (a fixed value of the vocabulary), and line ends between runs.
    _WORDS = regex.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        vocabulary = self.encoder.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.runs: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u2").tobytes() for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, words: list[str]) -> None:
        """Ids of many words from one call: cut behind every word end."""
        for s in range(0, len(words), 2000):
            part = words[s:s + 2000]
            ids = np.frombuffer(self._ids([" ".join(part)])[0], dtype="<u2")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and (not len(cuts) or cuts[-1] == len(ids)):
                data, edges = ids.tobytes(), [0, *(cuts * 2).tolist()]
                self.words.update(zip(part, (data[a:b] for a, b in zip(edges, edges[1:], strict=False)), strict=True))
            else:
                self.words.update(zip(part, self._ids(part), strict=True))

    def _learn_runs(self, runs: list[bytes]) -> None:
        text = b"\n".join(runs).decode()
        if "<|" in text or not self._PLAIN.fullmatch(text):  # sort out the odd ones
            odd = {r for r in runs if b"<|" in r or not self._PLAIN.fullmatch(r.decode())}
            self.runs.update(zip(odd, self._ids([r.decode() for r in odd]), strict=True))
            runs = [r for r in runs if r not in odd]
            text = b"\n".join(runs).decode()
        if not runs:
            return
        pieces, known = self._WORDS.findall(text.lower()), self.words
        self._learn_words(list({w for w in pieces if w not in known and w != "\n"}))
        known["\n"] = b"\xff\xff"  # no id: marks the end of a run
        ids = b"".join([known[w] for w in pieces])
        cuts = (np.flatnonzero(np.frombuffer(ids, dtype="<u2") == 0xFFFF) * 2).tolist()
        self.runs.update(zip(runs, (ids[a:b] for a, b in zip([0, *(c + 2 for c in cuts)], [*cuts, len(ids)], strict=True)), strict=True))

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        split = [(t or b"").split() for t in texts]
        for store, most in ((self.runs, CACHE_RUNS), (self.words, CACHE_WORDS)):
            if len(store) > most:
                store.clear()
        runs = self.runs
        new = [w for w in set().union(*split) if w not in runs]
        if new:
            self._learn_runs(new)
        return [np.frombuffer(b"".join(map(runs.__getitem__, ws)), dtype="<u2") for ws in split]

    def forget(self) -> None:
        """Keep the runs and words that were met first: the frequent ones are among them."""
        if len(self.runs) > KEPT_RUNS:
            self.runs = dict(islice(self.runs.items(), KEPT_RUNS))
        if len(self.words) > KEPT_WORDS:
            self.words = dict(islice(self.words.items(), KEPT_WORDS))


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Index:
    """BM25 inverted index of one shard: postings by term, with their weights."""

    def __init__(self, docs: list[np.ndarray]):
        n = self.n = len(docs)
        lengths = np.array([len(d) for d in docs], dtype=np.float64)
        keys, tf = np.unique(
            np.concatenate([d.astype(np.uint32) * np.uint32(SHARD_DOCS) + np.uint32(k) for k, d in enumerate(docs)]) if n else np.zeros(0, np.uint32),
            return_counts=True)
        terms, self.docs = keys // np.uint32(SHARD_DOCS), (keys % np.uint32(SHARD_DOCS)).astype(np.uint16)
        self.terms, self.first, df = np.unique(terms, return_index=True, return_counts=True)
        self.last = self.first + df
        self.idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        per_term = np.repeat(self.idf, df)
        norm = K1 * (1 - B + B * lengths / max(1.0, lengths.mean() if n else 1.0))
        self.weight = per_term * tf * (K1 + 1) / (tf + norm[self.docs])
        self.shared = (df > 1) & (self.terms != END_ID)  # every document has the end token: it relates none
        self.of_doc = np.argsort(self.docs, kind="stable")  # entries by document
        self.doc_at = np.searchsorted(self.docs[self.of_doc], np.arange(n + 1))
        self.term_of = np.repeat(np.arange(len(self.terms)), df)

    def neighbours(self, seed: int, left: np.ndarray) -> Iterator[np.ndarray]:
        """Documents with tokens left by falling score for the seed's shared terms, NEIGHBOURS at a time.

        First those that share one of the rarest terms; when they run out,
        twice as many further terms are looked up, until no term is left.
        """
        mine = self.term_of[self.of_doc[self.doc_at[seed]:self.doc_at[seed + 1]]]
        mine = mine[self.shared[mine]]
        mine, at, step = mine[np.argsort(-self.idf[mine], kind="stable")], 0, QUERY_TERMS
        while at < len(mine):
            entries = np.concatenate([np.arange(self.first[t], self.last[t]) for t in mine[at:at + step]])
            score = np.bincount(self.docs[entries], self.weight[entries], minlength=self.n)
            score[left == 0] = 0
            rest = np.flatnonzero(score)
            while len(rest):
                if len(rest) > NEIGHBOURS:
                    order = np.argpartition(-score[rest], NEIGHBOURS)
                    best, rest = rest[order[:NEIGHBOURS]], rest[order[NEIGHBOURS:]]
                else:
                    best, rest = rest, rest[:0]
                yield best[np.lexsort((best, -score[best]))]
            at, step = at + step, 2 * step


def pack_shard(docs: list[np.ndarray], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length); every token of every document lies in exactly one."""
    windows, begin = [], np.zeros(len(docs), dtype=np.int64)
    for k, d in enumerate(docs):
        while len(d) - begin[k] >= window:
            windows.append([(k, int(begin[k]), window)])
            begin[k] += window
    left = np.array([len(d) for d in docs], dtype=np.int64) - begin
    index = Index([d[b:] for d, b in zip(docs, begin, strict=True)])
    order, at = np.argsort(-left, kind="stable"), 0

    def take(k: int, most: int) -> int:
        n = int(min(left[k], most))
        current.append((k, int(begin[k]), n))
        begin[k] += n
        left[k] -= n
        return n

    while True:
        while at < len(order) and left[order[at]] == 0:
            at += 1
        if at == len(order):
            return windows
        current: list[tuple[int, int, int]] = []
        seed = order[at]
        room = window - take(seed, window)
        if room:
            for near in index.neighbours(seed, left):
                for k in near:
                    if 0 < left[k] <= room:
                        room -= take(k, room)
                for k in near:  # the best one left is cut to fill the window
                    if room and left[k]:
                        room -= take(k, room)
                if not room:
                    break
            ahead = at
            while room and ahead < len(order):  # no more neighbours: the next documents in line
                if left[order[ahead]]:
                    room -= take(order[ahead], room)
                ahead += 1
        windows.append(current)


def _powers(pieces: list[tuple[int, int, int]], window: int) -> list[list[tuple[int, int, int]]]:
    """The last, partly filled window of a shard as windows of power-of-two sizes."""
    total = sum(n for _, _, n in pieces)
    sizes = [1 << b for b in range(window.bit_length(), -1, -1) if total >> b & 1]
    out, queue = [], list(reversed(pieces))
    for size in sizes:
        current = []
        while size:
            k, start, n = queue.pop()
            used = min(n, size)
            current.append((k, start, used))
            size -= used
            if used < n:
                queue.append((k, start + used, n - used))
        out.append(current)
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, vocabulary: str | None = None,
         with_ids: bool = False, shard_tokens: int = SHARD_TOKENS, forget: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds its token ids (array of int).

    ``forget`` gives memory back after every task, for jobs that go on with
    other work; tokens are then looked up again, which takes more CPU time.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, made = tokenizer(path), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def packed() -> pa.RecordBatch:
            nonlocal made
            windows = pack_shard(tokens, window)
            if windows and sum(n for _, _, n in windows[-1]) < window:
                windows[-1:] = _powers(windows[-1], window)
            rows = []
            for pieces in windows:
                offset = 0
                for k, start, n in pieces:
                    part = tokens[k][start:start + n].astype("<u4")
                    rows.append((ids[k], start, n, zlib.crc32(part), len(tokens[k]), (task << 32) | made, offset, *([part] if with_ids else [])))
                    offset += n
                made += 1
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(c, pa.list_(pa.int32())) for c in columns[7:]]
            return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids)

        for batch in batches:
            texts, keys = batch.column(1).cast(pa.binary()), batch.column(0).to_pylist()
            for s in range(0, len(texts), 256):
                for key, part in zip(keys[s:s + 256], encode(texts.slice(s, 256).to_pylist()), strict=True):
                    ids.append(key)
                    tokens.append(np.append(part, np.uint16(END_ID)))
                    held += len(tokens[-1])
                    if held >= shard_tokens or len(ids) >= SHARD_DOCS:
                        yield packed()
                        ids, tokens, held = [], [], 0
        if ids:
            yield packed()
        ids, tokens = [], []
        if forget:
            encode.forget()
            give_back()

    return docs.select(id_col, text_col).mapInArrow(run, PIECES + ", ids array<int>" * with_ids)
