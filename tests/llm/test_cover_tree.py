"""Operator 13 against all inner products."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from parcelwise.llm import cover_tree

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    points = set()
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        points.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a, label, q in points:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, other) for i, other, v in points if i != a and len(v) == len(q))
        for p, pid, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(a, pid, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(fits)]
    return Counter(out)


def some_rows():
    r = random.Random(3)
    rows = []
    for i in range(900):
        base = [math.cos(0.7 * (i % 9) + k) for k in range(6)]
        rows.append((i, [0.4 * b + 0.1 * r.gauss(0, 1) for b in base], i % 9 % 4))
    rows += [(5000 + i, [0.25] * 6, i % 3) for i in range(400)]                              # one vector on a third of the rows
    rows += [(9000, [0.0] * 6, 1), (9100, [-0.3] * 6, 2), (9200, [1.0, 2.0], 1), (9201, [1.0, 1.9], 1), (9202, [1.0, 1.8], 3), (9300, [3.0], 0)]
    rows += [(100, None, 1), (200, [0.1, None, 0.2, 0.1, 0.1, 0.1], 1), (300, [float("nan")] * 6, 1), (400, [float("inf")] * 6, 2),
             (None, [0.3] * 6, 1), (9400, [0.3] * 6, None), (9500, [], 1), rows[0], rows[0]]
    return rows


def test_equals_brute_force(spark):
    rows = some_rows()
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = Counter(tuple(r) for r in cover_tree.hard_negatives(table, sample=40, cells=6, block=50).collect())
    assert got == brute(rows) and len(got) > 100


def test_empty_table(spark):
    assert cover_tree.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_components_stay_exact(spark):
    big = 2.0 ** 21
    rows = [(100, [big, 1.0], 1), (101, [big, 2.0], 1), (102, [big, 1.5], 2), (103, [big, 0.25], 2), (104, [big, 2.0], 4)]
    got = Counter(tuple(r) for r in cover_tree.hard_negatives(spark.createDataFrame(rows, SCHEMA), cells=2).collect())
    assert got == brute(rows) and len(got) == 3
    with pytest.raises(OverflowError):
        cover_tree.hard_negatives(spark.createDataFrame([(0, [2.0 ** 40], 1)], SCHEMA))


def test_nodes_cover_their_points_and_skip_work(monkeypatch):
    rng = np.random.default_rng(2)
    rows = np.floor(256 * (rng.normal(size=(2000, 8)) * 0.02 + rng.normal(size=(20, 8))[rng.integers(0, 20, 2000)] * 0.3))
    square = float((rows * rows).sum(axis=1).max())
    points = cover_tree.augmented(rows, square)
    assert np.allclose((points * points).sum(axis=1), square)
    tree = cover_tree.cover_tree(points, 32)
    ordered = points[tree["order"]]
    for c, r, lo, hi, children in zip(tree["centre"], tree["radius"], tree["start"], tree["end"], tree["children"], strict=True):
        assert np.linalg.norm(ordered[lo:hi] - c, axis=1).max() <= r + 1e-6
        if children:
            assert sum(tree["end"][k] - tree["start"][k] for k in children) == hi - lo and max(tree["radius"][k] for k in children) <= r + 1e-6
    compared = 0
    plain = cover_tree.exact_scores

    def counting(q, x):
        nonlocal compared
        compared += len(x)
        return plain(q, x)

    monkeypatch.setattr(cover_tree, "exact_scores", counting)
    import pandas as pd
    order = tree["order"]
    block = {"tree": tree, "rows": rows[order], "ids": np.arange(2000)[order], "labels": np.zeros(2000, dtype=int)[order], "norm": square ** 0.5}
    low = -2 ** 62
    ask = pd.DataFrame([(0, -1, 0, True, low, 2 ** 62, low, list(rows[17]))], columns=["qid", "self", "label", "same", "lo", "hi", "bar", "vec"])
    hits = sorted((-r.score, r.vec_id) for r in cover_tree.search(block, ask, 5).itertuples())
    want = sorted((-int(s), i) for i, s in enumerate(rows @ rows[17]))[:5]
    assert hits == want and compared < 1000


def test_internal_names_as_extra_columns(spark):
    names = ["vec", "place", "cell", "block", "distance", "qid", "self", "score", "rank", "same", "bar"]
    rows = some_rows()[:200]
    table = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], SCHEMA + ", " + ", ".join(f"`{n}` string" for n in names))
    assert Counter(tuple(r) for r in cover_tree.hard_negatives(table, cells=4).collect()) == brute(rows)


def test_windows_of_an_anchor_share_its_comparisons(monkeypatch):
    """Vectors that no bound can part: every pair is compared about once, in a few large products."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(1500, 32))
    rows = np.floor(256 * points / np.linalg.norm(points, axis=1)[:, None])
    square = float((rows * rows).sum(axis=1).max())
    tree = cover_tree.cover_tree(cover_tree.augmented(rows, square))
    order = tree.pop("order")
    ids, labels = np.arange(1500), rng.integers(0, 4, 1500)
    block = {"tree": tree, "rows": rows[order], "ids": ids[order], "labels": labels[order], "norm": square ** 0.5}
    pairs = calls = 0
    plain = cover_tree.exact_scores

    def counting(q, x):
        nonlocal pairs, calls
        pairs, calls = pairs + len(q) * len(x), calls + 1
        return plain(q, x)

    monkeypatch.setattr(cover_tree, "exact_scores", counting)
    import pandas as pd
    scores = (rows @ rows.T).astype(np.int64)
    asks, want = [], {}
    for a in range(100):
        tops = np.sort(scores[a][np.arange(1500) != a])[::-1][[0, 7, 30, 120, 400]]
        for k, hi in enumerate(tops):
            lo = min(int(hi * 0.8), int(hi))
            asks.append((5 * a + k, a, a, int(labels[a]), False, lo, int(hi), lo, list(rows[a])))
            fits = [(-int(s), i) for i, s in enumerate(scores[a]) if i != a and labels[i] != labels[a] and lo <= s <= hi]
            want[5 * a + k] = sorted(fits)[:5]
    ask = pd.DataFrame(asks, columns=["qid", "vid", "self", "label", "same", "lo", "hi", "bar", "vec"]).sample(frac=1, random_state=1)
    got = {q: [] for q in want}
    for r in cover_tree.search(block, ask, 5).itertuples():
        got[r.qid].append((-r.score, r.vec_id))
    assert {q: sorted(v) for q, v in got.items()} == want and sum(map(len, want.values())) > 1000
    assert pairs <= 1.5 * 100 * 1500 and calls < 200


def test_scores_are_exact_in_every_width():
    rng = np.random.default_rng(6)
    for size in (2 ** 7, 2 ** 11, 2 ** 14, 2 ** 25, 2 ** 28):
        q, x = (rng.integers(-size, size + 1, (7, 6)) for _ in range(2))
        want = [[sum(int(a) * int(b) for a, b in zip(v, w, strict=True)) for w in x] for v in q]
        got = cover_tree.exact_scores(cover_tree.narrow(q.astype(float)), cover_tree.narrow(x.astype(float)))
        assert [[int(s) for s in row] for row in got] == want
