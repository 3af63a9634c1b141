"""Embedding near-dedup with a random-projection tree forest (operator 9).

Equal vectors are collapsed first, so a vector that a third of the rows share
is one node. A forest is fitted on a bounded sample: every inner tree node has
a random direction and splits at the median of its sample rows; rows within a
margin of the split go down both sides (spill). Every distinct vector is then
routed through every tree. Leaves that hold too many vectors are split again
by subtrees fitted, leaf by leaf on the executors, on a bounded hash sample of
each leaf; what random splits cannot thin out (a dense cluster) is compared in
blocks. Candidates compare within leaves in double precision, pairs found in
several trees count once, and links are united to components.

The forest is approximate by nature: a pair at the threshold can be parted in
every tree. Recall against brute force is measured in the tests.

Rules for odd rows: a null or empty vector, a zero vector and one with null or
non-finite components link with nothing and are their own component; vectors
of different lengths never link; repeated ids with equal vectors are linked
rows; rows with a null id get the component of their links; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import connected_components, partitions, stored

TREES = 6
#: Vectors that the first forest is fitted on, and per leaf of the further splits.
SAMPLE = 8192
LEAF_SAMPLE = 2048
#: Sample rows that a tree node needs to be split.
MIN_NODE = 64
#: Spill margin on either side of a split, in units of the projected distance that two
#: vectors at the threshold have on average: r / sqrt(length), r = sqrt(2 - 2 * threshold).
SPILL = 0.5
#: A split must leave either side less than this share of the node's sample.
THINNING = 0.9
#: Vectors that are compared in one block; leaves with more are split again.
BLOCK = 1500
MAX_SPLITS = 6

ROUTED = "leaf string, node long, vec array<float>"


def margin(length: int, threshold: float) -> float:
    return SPILL * float(np.sqrt(max(0.0, 2 - 2 * threshold) / length))


def build_tree(sample: np.ndarray, rng: np.random.Generator, spill: float, min_node: int = MIN_NODE) -> list:
    """A tree as a list of nodes (direction, low, high, left, right); a leaf is None."""
    nodes: list = []

    def grow(rows: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(None)
        if len(rows) < min_node:
            return at
        direction = rng.standard_normal(rows.shape[1])
        direction /= np.linalg.norm(direction)
        along = rows @ direction
        split = float(np.median(along))
        low, high = split - spill, split + spill
        left, right = along <= high, along >= low
        if max(left.sum(), right.sum()) > THINNING * len(rows):  # a dense cluster: compared whole, in blocks
            return at
        nodes[at] = (direction, low, high, grow(rows[left]), grow(rows[right]))
        return at

    grow(sample)
    return nodes


def route(nodes: list, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, indexes of the rows that reach it); a row can reach several leaves."""
    todo = [(0, np.arange(len(rows)))]
    while todo:
        at, index = todo.pop()
        if not len(index):
            continue
        if nodes[at] is None:
            yield at, index
            continue
        direction, low, high, left, right = nodes[at]
        along = rows[index] @ direction
        todo += [(left, index[along <= high]), (right, index[along >= low])]


def _unit(vectors) -> np.ndarray:
    m = np.array(list(vectors), dtype=np.float64)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _routed(leaf: str, keys: np.ndarray, vecs: list, trees: dict[int, list]) -> Iterator[pd.DataFrame]:
    rows = _unit(vecs)
    for t, nodes in trees.items():
        for at, index in route(nodes, rows):
            yield pd.DataFrame({"leaf": f"{leaf}{t}.{at}", "node": keys[index], "vec": [vecs[i] for i in index]})


def distinct_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Valid distinct vectors: (node, vec, low_id, copies)."""
    v = F.col(vec_col).cast("array<float>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = rows.select(F.col(id_col).alias("id"), v.alias("vec")).where(
        F.col("vec").isNotNull() & (F.size("vec") > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda x: x != 0))
    groups = valid.groupBy("vec").agg(F.min("id").alias("low_id"), F.count("*").alias("copies"))
    return groups.withColumn("node", node_key(F.col("vec")))


def one_vector_per_key(nodes: DataFrame) -> DataFrame:
    """Fail loudly, rather than unite two vectors, should a key ever stand for both."""
    twice = nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise RuntimeError("two different vectors have the same 64-bit key")
    return nodes


def node_key(vec):
    """A 64-bit key of a vector (zeros of either sign are equal)."""
    return F.xxhash64(F.transform(vec, lambda x: x + F.lit(0.0).cast("float")))


def fit_forest(nodes: DataFrame, threshold: float, trees: int = TREES, sample: int = SAMPLE, seed: int = 7) -> dict[int, dict[int, list]]:
    """Trees by vector length, fitted on the ``sample`` distinct vectors with the smallest keys."""
    picked = [r["vec"] for r in nodes.orderBy("node").select("vec").limit(sample).collect()]
    out: dict[int, dict[int, list]] = {}
    for size in sorted({len(v) for v in picked}):
        rows = _unit([v for v in picked if len(v) == size])
        out[size] = {t: build_tree(rows, np.random.default_rng([seed, size, t]), margin(size, threshold)) for t in range(trees)}
    return out


def assign_leaves(nodes: DataFrame, forest: dict[int, dict[int, list]]) -> DataFrame:
    """Rows (leaf, node, vec), one for every leaf that a vector reaches."""
    shared = nodes.sparkSession.sparkContext.broadcast(forest)  # bounded: trees x SAMPLE / MIN_NODE directions

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["vec"].map(len)
            for size, part in batch.groupby(sizes):
                trees = shared.value.get(int(size), {0: [None]})
                yield from _routed(f"{size}|", part["node"].to_numpy(), list(part["vec"]), trees)

    return nodes.select("node", "vec").mapInPandas(run, ROUTED)


def split_large(leaves: DataFrame, threshold: float, block: int = BLOCK, seed: int = 11) -> DataFrame:
    """Split leaves of more than ``block`` vectors again by subtrees fitted on a bounded sample of each."""
    for level in range(MAX_SPLITS):
        sizes = leaves.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > block)
        if level:  # a leaf that its last split left as large as before is a dense cluster
            sizes = sizes.where(~F.col("leaf").endswith("/0.0"))
        sizes = stored(sizes, "forest-large")
        if sizes.isEmpty():
            break
        picked = (leaves.join(sizes, "leaf").where(F.pmod(F.xxhash64("node", F.lit(level)), F.col("n")) < LEAF_SAMPLE)
                  .select("leaf", "vec"))

        def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rng = np.random.default_rng([seed, zlib.crc32(key[0].encode())])
            ordered = _unit(sorted(map(tuple, rows["vec"])))
            return pd.DataFrame({"leaf": [key[0]], "tree": [pickle.dumps(build_tree(ordered, rng, margin(ordered.shape[1], threshold)))]})

        trees = picked.groupBy("leaf").applyInPandas(fit, "leaf string, tree binary")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                plain = batch[batch["tree"].isna()]
                if len(plain):
                    yield plain[["leaf", "node", "vec"]]
                for leaf, part in batch[batch["tree"].notna()].groupby("leaf"):
                    tree = pickle.loads(part["tree"].iloc[0])  # written by this job
                    yield from _routed(f"{leaf}/", part["node"].to_numpy(), list(part["vec"]), {0: tree})

        leaves = stored(leaves.join(trees, "leaf", "left").mapInPandas(run, ROUTED), "forest-leaves")
    return leaves


def leaf_pairs(leaves: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (a, b, a < b) with cosine >= threshold within a leaf.

    A leaf is cut into blocks of about ``block`` vectors by hash and every
    pair of its blocks is one group; small leaves are one block.
    """
    sizes = leaves.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    placed = leaves.join(sizes, "leaf").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = placed.withColumn("other", other).select(
        "leaf", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "node", "vec")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, lo, hi = key
        one = rows if lo == hi else rows[rows["mine"] == lo]
        two = rows if lo == hi else rows[rows["mine"] == hi]
        found = []
        if len(one) and len(two):
            x, y = (np.array(list(r["vec"]), dtype=np.float64) for r in (one, two))
            ix, iy = one["node"].to_numpy(), two["node"].to_numpy()
            nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
            for s in range(0, len(x), 512):
                cosine = (x[s:s + 512] @ y.T) / (nx[s:s + 512, None] * ny[None, :])
                i, j = np.nonzero(cosine >= threshold)
                a, b = ix[i + s], iy[j]
                keep = a < b if lo == hi else a != b
                found.append(pd.DataFrame({"a": np.where(a < b, a, b)[keep], "b": np.where(a < b, b, a)[keep]}))
        return pd.concat(found) if found else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    return dealt.groupBy("leaf", "lo", "hi").applyInPandas(compare, "a long, b long").distinct()


def near_duplicates(rows: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
                    trees: int = TREES, block: int = BLOCK) -> DataFrame:
    """One row per input row: the id, n_links, component_id, kept."""
    nodes = one_vector_per_key(stored(distinct_vectors(rows, id_col, vec_col), "forest-nodes"))
    leaves = stored(assign_leaves(nodes.repartition(partitions(rows.sparkSession), "node"), fit_forest(nodes, threshold, trees)), "forest-leaves")
    pairs = stored(leaf_pairs(split_large(leaves, threshold, block), threshold, block), "forest-pairs")
    both = pairs.union(pairs.select("b", "a")).toDF("node", "other")
    links = (both.join(nodes.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(F.sum("copies").alias("others")))
    comps = connected_components(pairs)
    known = nodes.select("node", "low_id", "copies").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = known.groupBy("component").agg(F.min("low_id").alias("component_id"))
    known = stored(known.join(lowest, "component").join(links, "node", "left").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "forest-known")
    keyed = rows.select(F.col(id_col).alias("vec_id"), node_key(F.col(vec_col).cast("array<float>")).alias("node"))
    return keyed.join(known, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
