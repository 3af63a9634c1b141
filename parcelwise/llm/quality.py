r"""Quality rules: text statistics and learned decision lists (operator 3); DataFrame functions only.

Statistics come from higher-order functions inside one row, so no document's
words are shuffled. A decision list is learnt by sequential covering: on the
grow part of the labelled rows a conjunction of thresholds is grown condition
by condition (largest information gain for the "reject" class), then pruned
from the end on the other part; the rows it covers go, and the next rule is
grown, until a rule no longer pays on the prune part. The list is emitted as
one ordered Spark ``CASE WHEN`` expression.

All labelled rows are used. The learner sees them as a contingency table
(features cut at a few thresholds x label x part) that Spark aggregates; it
has at most ``(number of quantiles) ** len(FEATURES) * 4`` rows whatever the
corpus size, in practice a few thousand.

Rules for odd rows: a null text has no words (all statistics 0); labels that
are null are ignored; a document with several labels counts once per label;
without labelled rows of both kinds the list is empty and only the base
rule rejects. Input columns are kept; statistics replace input columns of
the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import WORD, let, stored, words

SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: What the rules may test: ratios of the statistics.
FEATURES = {
    "symbols_per_word": lambda: F.col("n_symbols") / F.greatest(F.col("n_words"), F.lit(1)),
    "chars_per_word": lambda: F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
    "dup_line_share": lambda: F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    "repeat_share": lambda: F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
    "upper_share": lambda: F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
    "marks_per_word": lambda: F.col("n_marks") / F.greatest(F.col("n_words"), F.lit(1)),
}
#: Cuts per feature lie half-way between neighbours among these quantiles of the kept class and of the rejected class.
QUANTILES = {1: (0.01, 0.5, 0.99, 0.998), 0: (0.1, 0.3, 0.5)}
MIN_PRECISION = 0.9
MAX_RULES = 24


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeat_words(ws: Column) -> Column:
    """Words inside 3-word windows that occur at least twice: windows sorted by hash, equal neighbours, lengths of the union."""
    n = F.size(ws)
    starts = F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda i: F.struct(
        F.xxhash64(F.get(ws, i - 1), F.get(ws, i), F.get(ws, i + 1)).alias("h"), i.alias("i")))

    def repeated(s: Column) -> Column:
        def beside(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))

        return F.filter(s, beside)

    twice = let(F.sort_array(windows), repeated)
    at = F.array_sort(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + F.when(i >= acc["end"], 3).otherwise(i + 3 - acc["end"])).alias("n"), (i + 3).alias("end")),
        lambda acc: acc["n"])
    return covered.cast("long")


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the statistics columns ``STATS`` (long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    by_words = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("repeated")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(F.transform(x, F.md5))).alias("distinct")))
    out = docs.drop(*[c for c in docs.columns if c in STATS]).withColumns({"_w": by_words, "_l": by_lines})
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return out.withColumns({
        "n_words": F.col("_w")["n"],
        "word_chars": F.length(F.translate(text, _SPACE, "")).cast("long"),
        "n_symbols": _removed(text, SYMBOLS).cast("long"),
        "n_dup_lines": (F.col("_l")["n"] - F.col("_l")["distinct"]).cast("long"),
        "n_repeat_words": F.col("_w")["repeated"],
        "n_upper": _removed(text, upper).cast("long"),
        "n_marks": _removed(text, "!?").cast("long"),
        "n_lines": F.col("_l")["n"].cast("long"),
    }).drop("_w", "_l")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """``feature`` above (or not above) ``cut``."""

    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = FEATURES[self.feature]()
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass(frozen=True)
class Rule:
    """Reject where all conditions hold."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions)) + " -> reject"


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds per feature, half-way between neighbouring quantiles of the classes; one aggregation."""
    wanted = [F.percentile_approx(F.when(F.col("quality") == q, f()), list(ps), 2000).alias(f"{name}_{q}")
              for name, f in FEATURES.items() for q, ps in QUANTILES.items()]
    found = rows.agg(*wanted).first()
    levels = {name: sorted({float(x) for q in QUANTILES for x in (found[f"{name}_{q}"] or ())}) for name in FEATURES}
    return {name: [(a + b) / 2 for a, b in zip(xs, xs[1:], strict=False)] for name, xs in levels.items()}


def _cells(rows: DataFrame, cuts: dict[str, list[float]]) -> list[tuple[dict[str, int], int, bool, int]]:
    """The contingency table: (level of each feature, label, is in the grow part, rows)."""
    levels = {name: sum((F.when(FEATURES[name]() > F.lit(c), 1).otherwise(0) for c in cs), F.lit(0)).alias(name) for name, cs in cuts.items()}
    part = (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) != 0).alias("grow")
    table = rows.select(*levels.values(), "quality", part).groupBy(*levels, "quality", "grow").count()
    return [({f: r[f] for f in levels}, r["quality"], r["grow"], r["count"]) for r in table.collect()]


def _holds(c: Condition, levels: dict[str, int], cuts: dict[str, list[float]]) -> bool:
    return (levels[c.feature] > cuts[c.feature].index(c.cut)) == c.above


def _score(conditions, cells, cuts) -> tuple[int, int]:
    """Rejected-class rows and kept-class rows that the conjunction covers."""
    covered = [(q, n) for levels, q, _, n in cells if all(_holds(c, levels, cuts) for c in conditions)]
    return sum(n for q, n in covered if q == 0), sum(n for q, n in covered if q == 1)


def _grow(cells, cuts) -> list[Condition]:
    rule: list[Condition] = []
    bad, good = _score(rule, cells, cuts)
    tests = [Condition(f, above, c) for f, cs in cuts.items() for c in cs for above in (True, False)]
    while good and bad:
        best, gain = None, 1e-9
        inside = [x for x in cells if all(_holds(c, x[0], cuts) for c in rule)]
        for t in tests:
            b, g = _score([t], inside, cuts)
            if b:
                value = b * (math.log2(b / (b + g)) - math.log2(bad / (bad + good)))
                if value > gain:
                    best, gain = t, value
        if best is None:
            break
        rule.append(best)
        bad, good = _score(rule, cells, cuts)
    return rule


def _prune(rule: list[Condition], cells, cuts) -> list[Condition]:
    def worth(conditions) -> float:
        b, g = _score(conditions, cells, cuts)
        return (b - g) / (b + g) if b + g else -1.0

    best = max(range(1, len(rule) + 1), key=lambda k: (worth(rule[:k]), -k)) if rule else 0
    return rule[:best]


def learn_rules(labelled: DataFrame) -> list[Rule]:
    """Learn the list from rows with doc_id, the statistics and ``quality`` (0 reject, 1 keep)."""
    rows = labelled.where(F.col("quality").isin(0, 1) & ~base_failed())
    cuts = _cuts(rows)
    cells = _cells(rows, cuts)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        grow, prune = [x for x in cells if x[2]], [x for x in cells if not x[2]]
        rule = _prune(_grow(grow, cuts), prune, cuts)
        if not rule:
            break
        b, g = _score(rule, cells, cuts)
        pb, pg = _score(rule, prune, cuts)
        if not b or b < MIN_PRECISION * (b + g) or pb < MIN_PRECISION * (pb + pg):
            break
        rules.append(Rule(tuple(rule)))
        cells = [x for x in cells if not all(_holds(c, x[0], cuts) for c in rule)]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional expression: true keeps the document."""
    out = None
    for rule in rules:
        out = F.when(rule.column(), False) if out is None else out.when(rule.column(), False)
    return F.lit(True) if out is None else out.otherwise(True)


def learn_from(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> list[Rule]:
    """Learn from the labelled documents among ``stats`` (all of them)."""
    wanted = labels.select(F.col("doc_id").alias(id_col), "quality").where("quality in (0, 1)")
    return learn_rules(stats.select(F.col(id_col), *STATS).join(wanted, id_col).withColumnRenamed(id_col, "doc_id"))


def apply_rules(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add base_failed and kept."""
    return stats.drop("base_failed", "kept").withColumn("base_failed", base_failed()).withColumn(
        "kept", F.when(F.col("base_failed"), False).otherwise(verdict(rules)))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the base rule and the learned list keep, with their columns as they are."""
    # learned from the statistics of all rows: no text is shuffled to find the labelled ones
    stats = with_stats(docs.select(id_col, text_col), text_col).drop(text_col)
    rules = learn_from(stored(stats, "quality-stats"), labels, id_col)
    rows = with_stats(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_col).alias("_text")), "_text")
    return apply_rules(rows, rules).where("kept").select("_row.*")
