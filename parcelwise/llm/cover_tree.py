"""Hard-negative mining with cover trees over norm-augmented candidates (operator 13).

With M the largest candidate norm, a candidate x becomes (x, sqrt(M^2 - x.x))
and a query q becomes (q, 0): their inner product stays q.x, and a tree node
with centre c whose points lie within R of it bounds every one of them by
q.c - |q| R <= q.x <= q.c + |q| R.

A top tree is fitted on a bounded sample of candidates: nets whose radius is
halved from level to level. Every candidate descends it to a cell, the nearest
centre at every level. Cells are cut into blocks of bounded size, and a cover
tree of each block is built on the executors, level by level, with the radius
that its points really need. A query skips the cells and nodes whose interval
lies outside its window, or below its worst hit so far; inside a block it
opens the leaves with the best bounds first and compares them exactly. Each
search has two rounds: the most promising cell gives every query a first bar,
then all cells that may still beat it are visited. Results are exact; only the
work depends on the trees. Vectors that no bound can part (in many dimensions
all lie about equally far from each other) make it the product of queries and
candidates, done as matrix products.

An anchor's vector is sent and compared once for all its windows. Queries meet
cells in blocks of both, packed as arrays, so a cell that holds a third of all
candidates or draws a third of all queries is split. Equal vectors of one
label are held down to the few smallest ids that any result can name.

Rules for odd rows: rows with a null label, a null or empty vector, any null or
non-finite component or a null id take no part; vectors of different lengths
are not compared; rows equal in id, label and vector are one row, and a row
is no positive or negative of its own id; an empty table gives an empty
result; other columns are ignored. Scores are exact integers; a squared norm
beyond 64 bits stops the job.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import stored

#: Candidates that the top tree is fitted on, and its cells.
SAMPLE = 4096
CELLS = 64
#: Candidates of a block and query vectors (with all their windows) that meet it at once, about.
BLOCK = 4096
QUERIES = 1024
#: A vector whose bounds leave one row in so many of a block is compared with the whole block; scores held at once.
WHOLE = 4
CHUNK = 1 << 21
#: One that comes without a bar does so after its first leaves: from the step that opens so many.
UNLED = 8
#: A tree node with no more points is a leaf.
LEAF = 128
POSITIVES = 5
NEGATIVES = 5
ANCHOR_EVERY = 100
FLIP_EVERY = 7
LABELS = 10
#: A negative scores from LOW to HIGH percent of its positive.
LOW, HIGH = 80, 100
#: Bounds are widened by this share of |q| (M + R), far above the rounding error of doubles.
SLACK = 1e-9
#: The bar of a query that has none yet.
LEAST = -2 ** 63 + 1

QUERY = "qid long, vid long, self long, label int, same boolean, lo long, hi long, bar long, vec array<double>"
HIT = "qid long, vec_id long, score long"


def usable(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, vec): rows that take part, labels changed and components floored by the contract."""
    scaled = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double") * 256)
    # a double of 2^53 and more is whole
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col(f"`{label_col}`").cast("int")
    vec_id = F.col(f"`{id_col}`").cast("long")
    label = F.when(vec_id % FLIP_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    out = rows.select(vec_id.alias("vec_id"), label.alias("label"), whole.alias("vec"))
    return out.where("vec_id is not null and label is not null and vec is not null and size(vec) > 0").where(~F.coalesce(bad, F.lit(True)))


def candidates(points: DataFrame, keep: int) -> DataFrame:
    """Of every (vector, label) the ``keep`` smallest ids: no result names another one."""
    smallest = Window.partitionBy("label", "vec").orderBy("vec_id")
    return points.distinct().withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= keep).drop("place")


# ------------------------------------------------------------------ trees

def augmented(rows: np.ndarray, square: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(square - (rows * rows).sum(axis=1), 0.0))
    return np.concatenate([rows, rest[:, None]], axis=1)


def net(points: np.ndarray, radius: float, most: int | None = None) -> np.ndarray:
    """Indexes of centres no closer than ``radius`` to each other that cover all points within it (or the first ``most``).

    The farthest point so far becomes the next centre.
    """
    picked = [0]
    far = np.linalg.norm(points - points[0], axis=1)
    while far.max() > radius and len(picked) < (most or len(points)):
        picked.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(points - points[picked[-1]], axis=1))
    return np.array(picked)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every point the nearest centre and its distance."""
    best, distance = np.zeros(len(points), dtype=np.int64), np.full(len(points), np.inf)
    for k, c in enumerate(centres):
        d = np.linalg.norm(points - c, axis=1)
        closer = d < distance
        best[closer], distance[closer] = k, d[closer]
    return best, distance


def top_tree(sample: np.ndarray, square: float, cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of (centres, index of each one's parent in the level above); the first has one centre.

    Each level's centres are a net of half the radius, among the points of their parent.
    """
    points = augmented(sample, square)
    levels = [(points[:1], np.zeros(1, dtype=np.int64))]
    belongs = np.zeros(len(points), dtype=np.int64)
    radius = float(np.linalg.norm(points - points[0], axis=1).max())
    while radius > 0 and len(levels[-1][0]) < cells:
        radius /= 2
        centres, parents, deeper = [], [], np.zeros(len(points), dtype=np.int64)
        for parent in range(len(levels[-1][0])):
            mine = np.flatnonzero(belongs == parent)
            if not len(mine):
                continue
            picked = points[mine[net(points[mine], radius, cells)]]
            deeper[mine] = len(centres) + nearest(points[mine], picked)[0]
            centres += list(picked)
            parents += [parent] * len(picked)
        if len(centres) > 4 * cells:
            break
        levels.append((np.array(centres), np.array(parents)))
        belongs = deeper
    return levels


def descend(points: np.ndarray, levels: list) -> tuple[np.ndarray, np.ndarray]:
    """The cell (centre of the last level) of every point, and the distance to it."""
    at = np.zeros(len(points), dtype=np.int64)
    distance = np.linalg.norm(points - levels[0][0][0], axis=1)
    for centres, parents in levels[1:]:
        below = np.zeros(len(points), dtype=np.int64)
        for parent in np.unique(at):
            mine, children = np.flatnonzero(at == parent), np.flatnonzero(parents == parent)
            k, distance[mine] = nearest(points[mine], centres[children])
            below[mine] = children[k]
        at = below
    return at, distance


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> dict:
    """A cover tree of augmented points as arrays: order of the points, and per node centre, radius, start, end, children."""
    order = np.arange(len(points))
    centre, radius, start, end, children = [], [], [], [], []

    def add(lo: int, hi: int, at: np.ndarray) -> int:
        distance = np.linalg.norm(points[order[lo:hi]] - at, axis=1)
        centre.append(at)
        radius.append(float(distance.max()))
        start.append(lo)
        end.append(hi)
        children.append([])
        return len(centre) - 1

    todo = [add(0, len(points), points[0])] if len(points) else []
    while todo:
        node = todo.pop()
        lo, hi = start[node], end[node]
        if hi - lo <= leaf or radius[node] == 0:
            continue
        mine = order[lo:hi].copy()
        picked = points[mine[net(points[mine], radius[node] / 2, 16)]]  # 16 at a time: a wide level takes several
        if len(picked) < 2:
            continue
        which = nearest(points[mine], picked)[0]
        order[lo:hi] = mine[np.argsort(which, kind="stable")]
        at = lo
        for k, size in enumerate(np.bincount(which, minlength=len(picked))):
            if size:
                children[node].append(add(at, at + size, picked[k]))
                at += size
        todo += children[node]
    return {"order": order, "centre": np.array(centre), "radius": np.array(radius), "start": start, "end": end, "children": children}


def narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest of int16, int32 and float64 that holds them."""
    most = float(np.abs(a).max()) if a.size else 0.0
    return a.astype(np.int16 if most < 2 ** 15 else np.int32 if most < 2 ** 31 else np.float64)


def exact_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered vectors, exact, in the fastest of float32, float64 and int64 that holds every partial sum."""
    if not len(queries) or not len(rows):
        return np.zeros((len(queries), len(rows)), dtype=np.int64)
    queries, rows = queries.astype(np.float64), rows.astype(np.float64)
    # the absolute terms of a product add up to |q| |x| at most
    most = 1.001 * np.sqrt((queries * queries).sum(axis=1).max() * (rows * rows).sum(axis=1).max())
    if most < 2.0 ** 53:
        kind = np.float32 if most < 2.0 ** 24 else np.float64
        return queries.astype(kind) @ rows.astype(kind).T
    exact = np.array([[sum(int(a) * int(b) for a, b in zip(q, x, strict=True)) for x in rows] for q in queries], dtype=object)
    if (np.abs(exact) >= 2 ** 63).any():
        raise OverflowError("an inner product does not fit into 64 bits")
    return exact.astype(np.int64)


def as_scores(limits: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """64-bit limits in the type of ``scores``; one beyond all scores becomes the type's own."""
    most = {np.dtype(np.float32): 2 ** 24, np.dtype(np.float64): 2 ** 53}.get(scores.dtype)
    return limits if most is None else np.clip(limits, -most, most).astype(scores.dtype)


def packed(queries: pd.DataFrame) -> dict:
    """Rows of ``QUERY`` as arrays in the order of their vectors; a vector is held once, however many windows it is asked with."""
    order = np.argsort(queries["vid"].to_numpy(), kind="stable")
    queries = queries.iloc[order]
    _, first, which = np.unique(queries["vid"].to_numpy(), return_index=True, return_inverse=True)
    return {"vec": narrow(np.array(list(queries["vec"].iloc[first]), dtype=np.float64)), "which": which, "first": first,
            **{c: queries[c].to_numpy() for c in ("qid", "self", "label", "same", "lo", "hi", "bar")}}


def node_bounds(tree: dict, vectors: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """For every vector and node the lowest and the highest score that a point of it can have; a child lies within its parent's."""
    middle = vectors @ tree["centre"][:, :-1].T
    length = np.linalg.norm(vectors, axis=1)[:, None]
    reach = length * (tree["radius"] + SLACK * (norm + tree["radius"]))
    low, high = middle - reach, middle + reach
    for node, children in enumerate(tree["children"]):  # a parent stands before its children
        if children:
            low[:, children] = np.maximum(low[:, children], low[:, [node]])
            high[:, children] = np.minimum(high[:, children], high[:, [node]])
    return low, high


def search(block: dict, queries: pd.DataFrame | dict, top: int) -> pd.DataFrame:
    """(qid, vec_id, score): of each query the ``top`` best of the block in its window, or fewer.

    Every vector opens the leaves with its own best bounds first, twice as many
    at each step; vectors that open the same leaf are served together, and one
    whose bounds leave a large share of the block meets all of the block at
    once. ``block`` holds tree, rows, ids and labels, in the tree's order;
    ``queries`` are rows of ``QUERY``, or what ``packed`` made of them.
    """
    tree, rows, ids, labels = block["tree"], block["rows"], block["ids"], block["labels"]
    asks = queries if isinstance(queries, dict) else packed(queries if "vid" in queries else queries.assign(vid=queries["qid"]))
    vectors, which, first = asks["vec"].astype(np.float64), asks["which"], asks["first"]
    own, label, same, lo, hi = (asks[c] for c in ("self", "label", "same", "lo", "hi"))
    bar = np.maximum(lo, asks["bar"])
    count = np.diff(first, append=len(which))
    most = np.maximum.reduceat(hi, first)
    leaves = np.array([k for k, children in enumerate(tree["children"]) if not children])
    start, end = np.array(tree["start"])[leaves], np.array(tree["end"])[leaves]
    low, high = (b[:, leaves] for b in node_bounds(tree, vectors, block["norm"]))
    leaf_of = np.zeros(len(rows), dtype=np.int64)
    for k, (a, b) in enumerate(zip(start, end, strict=True)):
        leaf_of[a:b] = k
    closed = np.zeros(high.shape, dtype=bool)
    found = [np.zeros(0, dtype=np.int64)] * 3  # query, score, id

    def compare(mine: np.ndarray, part: slice, least: np.ndarray) -> Iterator[tuple]:
        """Hits of the vectors ``mine`` among rows of leaves that they have not opened yet."""
        scores = exact_scores(vectors[mine], rows[part])
        i, x = np.nonzero((scores >= as_scores(least[mine], scores)[:, None]) & (scores <= as_scores(most[mine], scores)[:, None]))
        score, v, x = scores[i, x].astype(np.int64), mine[i], x + part.start
        new = ~closed[v, leaf_of[x]]
        score, v, x = score[new], v[new], x[new]
        for k in range(int(count[mine].max())):  # a vector's windows, one after another
            has = count[v] > k
            q = first[v[has]] + k
            s, at = score[has], x[has]
            fits = (s >= bar[q]) & (s <= hi[q]) & (ids[at] != own[q]) & ((labels[at] == label[q]) == same[q])
            yield q[fits], s[fits], ids[at][fits]

    def keep(fresh: list) -> None:
        nonlocal found
        query, score, vec_id = (np.concatenate(c) for c in zip(found, *fresh, strict=True))
        order = np.lexsort((vec_id, -score, query))
        query, score, vec_id = query[order], score[order], vec_id[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        last = place == top - 1
        bar[query[last]] = np.maximum(bar[query[last]], score[last])
        found = [c[place < top] for c in (query, score, vec_id)]

    step, size = 1, end - start
    led = np.minimum.reduceat(bar, first) > low.min(axis=1)  # comes with a bar that says something
    while True:
        least = np.minimum.reduceat(bar, first)
        open_ = ~closed & (high >= least[:, None]) & (low <= most[:, None])
        left = open_ @ size
        if not left.any():
            break
        whole = (left * WHOLE >= len(rows)) & (led | (step >= UNLED))
        at_once = max(1, CHUNK // len(rows))
        many = np.flatnonzero(whole)
        for k in range(0, len(many), at_once):
            mine = many[k:k + at_once]
            keep(list(compare(mine, slice(0, len(rows)), least)))
            closed[mine] = True
        few = np.flatnonzero((left > 0) & ~whole)
        if len(few):
            best = np.where(open_[few], high[few], -np.inf)
            picked = np.argsort(-best, axis=1, kind="stable")[:, :step]
            asking = np.zeros(best.shape, dtype=bool)
            np.put_along_axis(asking, picked, True, axis=1)
            asking &= open_[few]
            fresh = []
            for leaf in np.flatnonzero(asking.any(axis=0)):
                mine = few[asking[:, leaf]]
                for k in range(0, len(mine), max(1, CHUNK // int(size[leaf]))):
                    fresh += compare(mine[k:k + max(1, CHUNK // int(size[leaf]))], slice(int(start[leaf]), int(end[leaf])), least)
            closed[few] |= asking
            keep(fresh)
        step *= 2
    return pd.DataFrame({"qid": asks["qid"][found[0]], "vec_id": found[2], "score": found[1]})


# ------------------------------------------------------------------ index

def fit_top(points: DataFrame, sample: int = SAMPLE, cells: int = CELLS) -> dict[int, tuple[float, list]]:
    """By vector length the squared largest norm and a top tree, fitted on the ``sample`` candidates with the smallest hashes."""
    square = {r["size"]: r["square"] for r in points.groupBy(F.size("vec").alias("size")).agg(
        F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("square")).collect()}  # one row per vector length
    if any(s >= 2.0 ** 63 for s in square.values()):  # it bounds every inner product
        raise OverflowError("an inner product may not fit into 64 bits")
    picked = [r["vec"] for r in points.orderBy(F.xxhash64("vec_id"), "vec_id").select("vec").limit(sample).collect()]
    out = {}
    for size, s in square.items():
        rows = np.array([v for v in picked if len(v) == size] or [[0.0] * size], dtype=np.float64)
        out[size] = (s, top_tree(rows, s, cells))
    return out


def build_index(points: DataFrame, top: dict, block: int = BLOCK) -> DataFrame:
    """(cell, block, blocks, radius, index): a pickled cover tree for every block of every cell."""
    shared = points.sparkSession.sparkContext.broadcast(top)  # bounded: cells times vector lengths

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["vec"].map(len)):
                square, levels = shared.value[int(size)]
                cell, distance = descend(augmented(np.array(list(part["vec"])), square), levels)
                yield part.assign(cell=[f"{size}.{c}" for c in cell], distance=distance)

    placed = stored(points.mapInPandas(cells, "vec_id long, label int, vec array<double>, cell string, distance double"), "cover-cells")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"), F.max("distance").alias("radius"))
    dealt = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), F.col("blocks")).cast("int"))

    def grow(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        rows = np.array(list(part["vec"]), dtype=np.float64)
        square = shared.value[rows.shape[1]][0]
        tree = cover_tree(augmented(rows, square))
        order = tree.pop("order")
        index = {"tree": tree, "rows": narrow(rows[order]), "ids": part["vec_id"].to_numpy()[order], "labels": part["label"].to_numpy()[order], "norm": square ** 0.5}
        return pd.DataFrame({"cell": [key[0]], "block": [key[1]], "blocks": [key[2]], "radius": [key[3]], "index": [pickle.dumps(index)]})

    return stored(dealt.groupBy("cell", "block", "blocks", "radius").applyInPandas(
        grow, "cell string, block int, blocks int, radius double, index binary"), "cover-index")


def _cells(part: pd.DataFrame, size: int, top: dict, radii: dict[str, float]) -> tuple[np.ndarray, ...]:
    """Names of the cells of one vector length, whether there is a point in each, and the middle, lowest and highest score of every query there."""
    square, levels = top[size]
    names = np.array([f"{size}.{c}" for c in range(len(levels[-1][0]))])
    radius = np.array([radii.get(n, -1.0) for n in names])
    vectors = np.array(list(part["vec"]), dtype=np.float64)
    length = np.linalg.norm(vectors, axis=1)[:, None]
    middle = vectors @ levels[-1][0][:, :-1].T
    reach = length * radius + SLACK * length * (square ** 0.5 + np.maximum(radius, 0.0))
    return names, radius >= 0, middle, middle - reach, middle + reach


def _seated(queries: DataFrame, top: dict, radii: dict[str, float]) -> DataFrame:
    """Queries with the most promising cell, the one that is visited first (``seat``); without a cell of their vectors' length they go."""
    shared = queries.sparkSession.sparkContext.broadcast((top, radii))  # bounded: cells times vector lengths

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top, radii = shared.value
        for batch in batches:
            for size, part in batch.groupby(batch["vec"].map(len)):
                if int(size) in top:
                    names, some, middle, _, high = _cells(part, int(size), top, radii)
                    # promise: how near the window's upper end the cell's middle lies, as seen from the query
                    end = np.minimum(part["hi"].to_numpy().astype(np.float64), high.max(axis=1))[:, None]
                    yield part.assign(seat=names[np.where(some, -np.abs(end - middle), -np.inf).argmax(axis=1)])

    return queries.mapInPandas(run, f"{QUERY}, seat string")


def _route(seated: DataFrame, top: dict, radii: dict[str, float], first: bool, crowds: int) -> DataFrame:
    """(cell, asks): the queries that visit a cell, packed by crowds: in their seat (``first``), or in all others that may hold a hit."""
    shared = seated.sparkSession.sparkContext.broadcast((top, radii))  # bounded: cells times vector lengths

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top, radii = shared.value
        for batch in batches:
            for size, part in batch.groupby(batch["vec"].map(len)):
                names, some, _, low, high = _cells(part, int(size), top, radii)
                open_ = some & (high >= np.maximum(part["lo"], part["bar"]).to_numpy()[:, None]) & (low <= part["hi"].to_numpy()[:, None])
                open_ &= (part["seat"].to_numpy()[:, None] == names) == first
                for c in np.flatnonzero(open_.any(axis=0)):
                    yield pd.DataFrame({"cell": [names[c]], "asks": [pickle.dumps(packed(part[open_[:, c]]))]})

    return seated.repartition(crowds, "vid").mapInPandas(run, "cell string, asks binary")


def _visit(probes: DataFrame, index: DataFrame, top: int) -> DataFrame:
    """Hits of the queries in the cells they visit; crowds of queries meet blocks of candidates."""
    probes = stored(probes.withColumn("crowd", F.monotonically_increasing_id()), "cover-probes")
    by = ("cell", "block", "crowd")
    # columns of their own on either side, or the cogroup cannot tell them apart
    asked = probes.join(index.select("cell", "block"), "cell").select(*[F.col(c).alias(c) for c in (*by, "asks")])
    trees = index.select("cell", "block", "index").join(probes.select("cell", "crowd"), "cell").select(*[F.col(c).alias(c) for c in (*by, "index")])

    def meet(tree: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(tree) or not len(queries):
            return pd.DataFrame({"qid": [], "vec_id": [], "score": []}, dtype="int64")
        return search(pickle.loads(tree["index"].iloc[0]), pickle.loads(queries["asks"].iloc[0]), top)  # written by this job

    return trees.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(meet, HIT)


def best_hits(queries: DataFrame, index: DataFrame, tops: dict, top: int, crowd: int = QUERIES) -> DataFrame:
    """(qid, vec_id, score, rank): of each query (rows of ``QUERY``) its ``top`` best, ties by id."""
    radii = {r["cell"]: r["radius"] for r in index.select("cell", "radius").distinct().collect()}  # one row per cell
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    ranked = lambda hits: hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    seated = stored(_seated(queries, tops, radii), "cover-seats")
    crowds = max(1, -(-seated.select("vid").distinct().count() // crowd))
    seen = stored(ranked(_visit(_route(seated, tops, radii, True, crowds), index, top)), "cover-first")
    bars = seen.where(F.col("rank") == top).select("qid", F.col("score").alias("reached"))
    raised = seated.join(bars, "qid", "left").withColumn("bar", F.greatest("bar", "reached")).select(*seated.columns)
    rest = _visit(_route(raised, tops, radii, False, crowds), index, top)
    return stored(ranked(seen.drop("rank").unionByName(rest)), "cover-hits")


def hard_negatives(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = ANCHOR_EVERY,
                   low: int = LOW, high: int = HIGH, sample: int = SAMPLE, cells: int = CELLS, block: int = BLOCK, **columns) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and positive."""
    points = stored(usable(rows, **columns), "cover-points")
    pool = stored(candidates(points, max(positives, negatives) + 1), "cover-candidates")
    tops = fit_top(pool, sample, cells)
    index = build_index(pool, tops, block)
    least, most = F.lit(LEAST).cast("long"), F.lit(2 ** 63 - 1).cast("long")
    anchors = points.where(F.col("vec_id") % every == 0).distinct()
    anchors = stored(anchors.select(F.monotonically_increasing_id().alias("qid"), F.col("vec_id").alias("self"), "label", "vec"), "cover-anchors")
    ask = anchors.select("qid", F.col("qid").alias("vid"), "self", "label", F.lit(True).alias("same"), least.alias("lo"), most.alias("hi"), least.alias("bar"), "vec")
    good = best_hits(ask, index, tops, positives).select(
        "qid", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place"))
    # 100 n >= low p and 100 n <= high p in whole numbers; decimals, as low p may pass 64 bits
    share = lambda p, up: F.expr(f"cast({'floor' if up else 'ceil'}(cast(positive_score as decimal(20,0)) * {p} / 100) as long)")
    pairs = stored(good.join(anchors, "qid").select(
        F.monotonically_increasing_id().alias("pair"), "qid", "self", "label", "vec", "positive_id", "positive_score",
        share(low, False).alias("lo"), share(high, True).alias("hi")), "cover-pairs")
    ask = pairs.where("lo <= hi").select(F.col("pair").alias("qid"), F.col("qid").alias("vid"), "self", "label", F.lit(False).alias("same"), "lo", "hi", least.alias("bar"), "vec")
    bad = best_hits(ask, index, tops, negatives).withColumnRenamed("qid", "pair")
    return bad.join(pairs.select("pair", "self", "positive_id", "positive_score"), "pair").select(
        F.col("self").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


ORACLE_SQL = """
with rows_ as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as vec
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, list_inner_product(a.vec, r.vec)::bigint as score
  from rows_ a join rows_ r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id and len(a.vec) = len(r.vec)),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id,
  (row_number() over (partition by p.anchor_id, positive_id order by n.score desc, n.vec_id))::integer as rank,
  n.vec_id as negative_id, positive_score, n.score as negative_score
from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
  and 80 * positive_score <= 100 * n.score and 100 * n.score <= 100 * positive_score
qualify rank <= 5
"""
