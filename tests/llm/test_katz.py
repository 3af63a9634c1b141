"""Katz scores against brute force where words lie outside the numbered ones: they keep bigram counts of their own."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcelwise.llm import katz

END, START, RARE = "</s>", "<s>", "<rare>"


class BruteForce:
    """The model of katz.py over words as text, with dictionaries."""

    def __init__(self, texts: list[str], frequent: set[str]):
        self.frequent = frequent | {END, START}
        grams = Counter()
        for t in texts:
            words = [START, *t.split(), END]
            grams.update(zip(words[:-1], words[1:], strict=True))
        self.pairs, self.rare = Counter(), Counter()
        led, after = Counter(), Counter()
        for (v, w), n in grams.items():
            self.pairs[self.number(v), self.number(w)] += n
            if self.number(w) == RARE:
                self.rare[w] += n
            if self.number(v) == RARE:
                after[v, w] += n
            elif self.number(w) == RARE:
                led[v, w] += n
        self.counts = Counter()
        for (_, w), n in self.pairs.items():
            self.counts[w] += n
        self.n_numbers = 1 + len(frequent) + 1
        self.total = sum(self.counts.values())
        self.d = {k: self.discounts(c) for k, c in (("pairs", self.pairs.values()), ("rare", self.rare.values()), ("links", [*led.values(), *after.values()]))}
        self.words = self.contexts(self.rare_as_pairs(), "rare", lambda w: 0.0)[RARE] if self.rare else None
        self.by_number = self.contexts(self.pairs, "pairs", self.uni)
        self.led = self.contexts(led, "links", self.of_rare)
        self.after = self.contexts(after, "links", self.alone)

    def number(self, w):
        return w if w in self.frequent else RARE

    def rare_as_pairs(self):
        return {(RARE, w): n for w, n in self.rare.items()}

    @staticmethod
    def discounts(counts):
        level = np.zeros(katz.CUTOFF + 3)
        for n in counts:
            level[min(n, katz.CUTOFF + 2)] += 1
        return katz.good_turing(level)

    def contexts(self, pairs, kind, lower):
        """Per context: probabilities of what it has seen, and the weight of the lower order."""
        groups = defaultdict(dict)
        for (v, w), n in pairs.items():
            groups[v][w] = n
        out = {}
        for v, seen in groups.items():
            total = sum(seen.values())
            kept = {w: self.d[kind][min(n, katz.CUTOFF + 1)] * n / total for w, n in seen.items()}
            factor = total / (total + 1) if sum(kept.values()) > 1 - 1e-9 else 1.0
            rest = 1 - math.fsum(lower(w) for w in seen)
            if rest < 1e-9 and kind == "pairs":
                out[v] = {w: p / sum(kept.values()) for w, p in kept.items()}, 0.0
            else:
                out[v] = {w: factor * p for w, p in kept.items()}, (1 - factor * sum(kept.values())) / rest
        return out

    def uni(self, number):
        return (self.counts[number] + 0.5) / (self.total + 0.5 * self.n_numbers)

    def of_rare(self, w):
        """P(w | RARE); a word that training lacks has what is left for all of them."""
        return 1.0 if self.words is None else self.words[0].get(w, self.words[1])

    def alone(self, w):
        return self.uni(self.number(w)) * (self.of_rare(w) if self.number(w) == RARE else 1.0)

    def katz(self, table, v, w, lower):
        seen, weight = table.get(v, ({}, 1.0))
        return seen[w] if w in seen else weight * lower(w)

    def probability(self, v, w):
        if self.number(v) == RARE:
            return self.katz(self.after, v, w, self.alone)
        p = self.katz(self.by_number, v, self.number(w), self.uni)
        return p * self.katz(self.led, v, w, self.of_rare) if self.number(w) == RARE else p

    def score(self, text):
        words = [START, *text.split(), END]
        return sum(math.log10(self.probability(v, w)) for v, w in zip(words[:-1], words[1:], strict=True))


def _texts(rng, n):
    vocabulary = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(12))) for _ in range(n)]
    return texts + ["w50 w51 w52 w50 w51 w52"] * 3 + ["w0 w55 w56"] * 9 + ["", "once", "w1 once"]


def _scores(spark, texts, scored, frequent, buckets, parts):
    frame = lambda ts: spark.createDataFrame(list(enumerate(ts)), "doc_id long, text string").repartition(parts)
    hashes = np.sort(np.array([katz.word_hashes(w.encode())[1][0] for w in frequent], dtype=np.uint64))
    types = katz.count_all(frame(texts), "text", hashes, buckets)
    model = katz.fit(types, hashes)
    rows = katz.score_texts(frame(scored), "text", types, model, buckets).collect()
    return sorted(r.score / r.sent for r in rows)


@pytest.mark.parametrize(("numbered", "buckets", "parts"), [(8, 4, 3), (0, 1, 1), (25, 7, 2), (60, 3, 4)])
def test_scores_are_those_of_brute_force(spark, numbered, buckets, parts):
    rng = random.Random(numbered)
    texts = _texts(rng, 300)
    frequent = {w for w, _ in Counter(" ".join(texts).split()).most_common(numbered)}
    scored = sorted({*texts[:100], *_texts(rng, 40), "new w0 new newer", "w50 w51", "w50 w52", "w0 w55", "w0 w57", "w55 new", "new w55"})
    want = BruteForce(texts, frequent)
    for v in [START, "w0", "w1", "w50", "w55", "once", "never seen"]:  # all words, what is unknown, and the end
        words = {w for t in texts for w in t.split()} | frequent | {END, "an unknown word"}
        if want.words is not None:
            assert abs(math.fsum(want.probability(v, w) for w in words) - 1) < 1e-9
    got = _scores(spark, texts, scored, frequent, buckets, parts)
    assert got == pytest.approx(sorted(want.score(t) for t in scored), abs=1e-6)


def test_rare_words_keep_bigrams_of_their_own(spark):
    texts = ["the red fox", "the blue owl"] * 20
    fox, owl, odd = (_scores(spark, texts, [t], {"the"}, 2, 2)[0] for t in ("the red fox", "the blue owl", "the red owl"))
    assert abs(fox - owl) < 1e-9 and odd < fox - 1
