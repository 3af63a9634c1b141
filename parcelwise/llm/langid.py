"""Language identification (operator 1).

A document's features are the hashed byte n-grams (1 to 4 bytes) of its
lower-cased words, word ends included; its representation is the average of
their embeddings, and a linear softmax gives a probability per language.
Embeddings and softmax are trained together by stochastic gradient descent in
numpy on a bounded sample of labelled rows. A part of the sample that training
does not see sets the softmax temperature (smallest log loss) and the
rejection threshold (the probability below which the documents of that part
are wrong more often than ``MAX_ERROR``).

As the model is linear, embeddings and softmax fold into one table of a few
numbers per bucket for prediction: a document costs one lookup per n-gram,
over its whole text, whatever its length.

Rules for odd rows: a text that is null or has no letter is ``und`` with score
0 and is never accepted; labels that are null or empty are not learnt;
without labelled rows every document is ``und``; duplicates count as often as
they occur; other columns are kept, the added ones (lang_pred, score,
accepted) replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that training may see, shared among the languages, and bytes of their texts.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 16 << 20
#: Hash buckets per n-gram order; n-gram orders in bytes; embedding size.
BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
DIM = 16
EPOCHS = 4
MAX_STEPS = 50_000
MIN_STEPS = 4_000
RATE = 0.5
MAX_ERROR = 0.05
#: Bytes of text per training document segment: whole texts are cut into segments of this size, all of them used.
SEGMENT = 400

_LETTER = regex.compile(r"\p{L}")
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], dtype=np.uint32)


@dataclass(frozen=True)
class Model:
    """Folded table (bucket x language), bias, temperature, rejection threshold."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float


def prepared(text: str) -> bytes:
    """Lower-cased words joined by single spaces, with one before the first and after the last."""
    return b" " + " ".join(text.lower().split()).encode("utf-8", "replace") + b" "


def ngram_buckets(data: np.ndarray) -> list[np.ndarray]:
    """For every n-gram order the bucket of the n-gram that starts at each byte."""
    b = data.astype(np.uint32) + np.uint32(1)
    out, acc = [], np.zeros(len(b), dtype=np.uint32)
    for k, order in enumerate(ORDERS):
        n = len(b) - order + 1
        if n <= 0:
            break
        acc = acc[:n] * np.uint32(0x01000193) + b[order - 1: order - 1 + n] * _MULTIPLIERS[k]
        mixed = acc ^ (acc >> np.uint32(15))
        mixed = mixed * np.uint32(0x2C1B3C6D)
        out.append((mixed >> np.uint32(32 - 15)).astype(np.int64) + k * BUCKETS)
    return out


def _logits(texts: list[bytes], model: Model) -> np.ndarray:
    """Average of the folded table over all n-grams of each text, plus bias."""
    total = np.zeros((len(texts), len(model.languages)))
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    counts = np.zeros(len(texts))
    for order, ids in zip(ORDERS, ngram_buckets(data), strict=False):
        # the last order - 1 starts of a text would run into the next one
        inside = np.maximum(lengths - order + 1, 0)
        for c in range(len(model.languages)):
            running = np.concatenate([[0.0], np.cumsum(model.table[:, c][ids], dtype=np.float64)])
            starts = np.minimum(ends - lengths, len(running) - 1)
            total[:, c] += running[np.minimum(starts + inside, len(running) - 1)] - running[starts]
        counts += inside
    return total / np.maximum(counts, 1)[:, None] + model.bias


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, calibrated probability and acceptance of each text."""
    known = [k for k, t in enumerate(texts) if t is not None and model.languages and _LETTER.search(t)]
    langs, scores, accepted = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
    at = 0
    while at < len(known):  # about 4 MB of text at once, whatever the batch holds
        group, size = [], 0
        while at < len(known) and (not group or size < (4 << 20)):
            group.append((known[at], prepared(texts[known[at]])))
            size += len(group[-1][1])
            at += 1
        p = _softmax(_logits([t for _, t in group], model) / model.temperature)
        best = p.argmax(axis=1)
        for row, (k, _) in enumerate(group):
            langs[k], scores[k] = model.languages[best[row]], min(1.0, float(p[row, best[row]]))
            accepted[k] = scores[k] >= model.reject_below
    return langs, scores, accepted


def train(rows: list[tuple[str, str]], seed: int = 5) -> Model:
    """Fit on (text, language) rows; every fifth row only calibrates."""
    rows = [(prepared(t), y) for t, y in rows if t and y and _LETTER.search(t)]
    languages = tuple(sorted({y for _, y in rows}))
    index = {y: k for k, y in enumerate(languages)}
    buckets, rng = BUCKETS * len(ORDERS), np.random.default_rng(seed)
    if not languages:
        return Model((), np.zeros((buckets, 0)), np.zeros(0), 1.0, 0.0)
    fit, held = [r for k, r in enumerate(rows) if k % 5] or rows, [r for k, r in enumerate(rows) if not k % 5]
    emb = rng.uniform(-1 / DIM, 1 / DIM, (buckets, DIM)).astype(np.float32)
    soft = np.zeros((DIM, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    pieces = [(np.concatenate(ngram_buckets(np.frombuffer(t[s:s + SEGMENT], np.uint8))), index[y])
              for t, y in fit for s in range(0, len(t), SEGMENT) if len(t) - s >= min(len(t), 20)]
    # a language weighs the same however many segments it has
    per = np.bincount([y for _, y in pieces], minlength=len(languages))
    weight = len(pieces) / np.maximum(per, 1) / max(1, len(languages))
    steps, done = min(MAX_STEPS, max(MIN_STEPS, EPOCHS * len(pieces))), 0
    while pieces and done < steps:
        for k in rng.permutation(len(pieces)):
            ids, y = pieces[k]
            hidden = emb[ids].mean(axis=0)
            z = hidden @ soft + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            rate = RATE * (1 - done / steps) * min(3.0, weight[y])
            back = soft @ p
            soft -= rate * np.outer(hidden, p)
            bias -= rate * p
            np.subtract.at(emb, ids, (rate / len(ids)) * back) if len(ids) < 64 else _subtract(emb, ids, (rate / len(ids)) * back)
            done += 1
            if done >= steps:
                break
    model = Model(languages, (emb @ soft).astype(np.float64), bias.astype(np.float64), 1.0, 0.0)
    return _calibrated(model, held or fit, index)


def _subtract(emb: np.ndarray, ids: np.ndarray, step: np.ndarray) -> None:
    unique, times = np.unique(ids, return_counts=True)
    emb[unique] -= times[:, None].astype(np.float32) * step.astype(np.float32)


def _calibrated(model: Model, held: list[tuple[bytes, str]], index: dict[str, int]) -> Model:
    # short and long texts alike: whole texts and their first segments
    texts = [t for t, _ in held] + [t[:40] for t, _ in held]
    y = np.array([index[lang] for _, lang in held] * 2)
    logits = _logits(texts, model)

    def loss(temperature: float) -> float:
        return float(-np.log(_softmax(logits / temperature)[np.arange(len(y)), y] + 1e-12).mean())

    temperature = min(np.geomspace(0.02, 20, 61), key=loss)
    p = _softmax(logits / temperature)
    right, top = p.argmax(axis=1) == y, p.max(axis=1)
    reject = 0.0
    for cut in np.linspace(0.0, 0.99, 100):
        below = top < cut
        if below.any() and (~right[below]).mean() > MAX_ERROR:
            reject = float(cut)
    return Model(model.languages, model.table, model.bias, float(temperature), reject)


def labelled_sample(rows: DataFrame, id_col: str, text_col: str, lang_col: str, bound: int = SAMPLE_ROWS,
                    max_bytes: int = SAMPLE_BYTES) -> list[tuple[str, str]]:
    """At most about ``bound`` rows, shared evenly among the languages, chosen by a hash of the id."""
    usable = rows.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & (F.col(lang_col) != ""))
    sizes = {r[lang_col]: r["count"] for r in usable.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(bound).collect()}
    if not sizes:
        return []
    share = max(1, bound // len(sizes))
    spread = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 40))
    keep = F.lit(False)
    for lang, n in sizes.items():
        keep = keep | ((F.col(lang_col) == lang) & (spread < int(min(1.0, share / n) * (1 << 40))))
    drawn = usable.where(keep).select(spread.alias("s"), F.octet_length(text_col).alias("n")).orderBy("s", "n").limit(2 * bound).collect()
    chosen, total = [], 0
    for r in drawn:
        if total + r["n"] <= max_bytes:
            chosen.append(r["s"])
            total += r["n"]
    rows = usable.where(keep & spread.isin(chosen)).select(text_col, lang_col, spread.alias("s")).orderBy("s", text_col).limit(len(chosen)).collect()
    return [(r[0], r[1]) for r in rows]


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add lang_pred, score and accepted to every row, from its text alone."""
    added = ("lang_pred", "score", "accepted")
    docs = docs.drop(*[c for c in added if c in docs.columns])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: buckets x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, accepted = predict(batch.column(text_col).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(langs), pa.array(scores), pa.array(accepted)], names=[*kept, *added])

    kept = docs.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["lang_pred string", "score double", "accepted boolean"])
    return docs.mapInArrow(run, schema)


def held_out(id_col: str) -> Column:
    """Rows that learning never sees: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict all rows."""
    model = train(labelled_sample(docs.where(~held_out(id_col)), id_col, text_col, lang_col))
    return identify(docs.select(id_col, text_col), model, text_col).select(
        id_col, held_out(id_col).alias("held_out"), "lang_pred", "score", "accepted")
