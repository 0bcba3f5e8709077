"""Scoring rows with whole forests by leaf bit masks.

A tree's leaves are numbered from left to right, a bit each.  A node whose test
``x <= thr`` fails rules out the leaves of its left side; what all failed tests leave
has the reached leaf as its lowest bit.  The tests of one feature fail from the smallest
threshold up to the row's value, so the masks of each (tree, feature) are kept as running
ANDs in threshold order: a row needs one place and one AND per feature, whatever the depth.

A value's place among all thresholds of a feature is searched once per row and shared by
all trees.  Forests (a size of the configuration) are broadcast, rows stay where they are:
scoring is one Arrow function over the feature array, without join, shuffle or grouping.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: Thresholds of a feature up to which every tree keeps a table of its places; above, each tree searches its own.
TABLE_THRESHOLDS = 4096
#: Rows that are scored together.
CHUNK_ROWS = 4096


class PackedTree:
    """Leaf numbers and votes from left to right, and per feature the thresholds and their running masks."""

    def __init__(self, nodes: list[dict], vote: str):
        at = {n["node"]: n for n in nodes}
        self.leaves: list[int] = []
        tests: dict[int, list[tuple[float, int, int]]] = {}

        stack: list = [1]
        while stack:  # left side first; a tuple closes the left side of a test
            node = stack.pop()
            if isinstance(node, tuple):
                n, first = node
                tests.setdefault(n["f"], []).append((n["thr"], first, len(self.leaves)))
                continue
            n = at[node]
            if n["f"] is None:
                self.leaves.append(node)
            else:
                stack += [2 * node + 1, (n, len(self.leaves)), 2 * node]
        self.votes = np.array([at[n][vote] for n in self.leaves], dtype=np.int64)
        self.words = -(-len(self.leaves) // 64)
        self.thresholds: dict[int, np.ndarray] = {}
        self.masks: dict[int, np.ndarray] = {}
        for f, of_f in sorted(tests.items()):
            of_f.sort()
            keep = np.full((len(of_f) + 1, self.words * 64), 1, dtype=np.uint8)
            for i, (_, first, end) in enumerate(of_f):
                keep[i + 1:, first:end] = 0
            self.thresholds[f] = np.array([t for t, _, _ in of_f])
            self.masks[f] = np.packbits(keep, axis=1, bitorder="little").view(np.uint64)

    def leaf(self, places: dict[int, np.ndarray], n_rows: int) -> np.ndarray:
        """Leaf of each row, given how many of this tree's thresholds of each feature it exceeds."""
        if not places:
            return np.zeros(n_rows, dtype=np.int64)
        left = None
        for f, place in places.items():
            masks = self.masks[f][place]
            left = masks if left is None else left & masks
        word = np.argmax(left != 0, axis=1) if self.words > 1 else np.zeros(n_rows, dtype=np.int64)
        bits = left[np.arange(n_rows), word]
        lowest = bits & (~bits + np.uint64(1))
        return word * 64 + np.log2(lowest.astype(np.float64)).astype(np.int64)  # powers of two are exact


class PackedForest:
    """All trees of all keys; keys and trees in order."""

    def __init__(self, nodes: list[dict], vote: str):
        by_tree: dict[tuple, list[dict]] = {}
        for n in nodes:
            by_tree.setdefault((n["k"], n["tree"]), []).append(n)
        self.names = sorted(by_tree)
        self.keys = sorted({k for k, _ in self.names})
        self.trees = [PackedTree(by_tree[name], vote) for name in self.names]
        of = [[t.thresholds[f] for t in self.trees if f in t.thresholds] for f in range(1 + max((f for t in self.trees for f in t.thresholds), default=-1))]
        self.thresholds = [np.unique(np.concatenate(each)) if each else np.zeros(0) for each in of]
        #: Per tree and feature: the tree's own place for each place among all thresholds of the feature.
        self.places = [{f: np.searchsorted(own, self.thresholds[f], side="right") for f, own in t.thresholds.items()
                        if len(self.thresholds[f]) <= TABLE_THRESHOLDS} for t in self.trees]
        self.places = [{f: np.concatenate([[0], p]) for f, p in of_t.items()} for of_t in self.places]

    def leaves(self, x: np.ndarray):
        """For each tree the leaves of the rows of ``x``."""
        # How many thresholds a value exceeds: ``x > thr`` fails the test ``x <= thr``.
        ranks = [np.searchsorted(t, x[:, f], side="left") for f, t in enumerate(self.thresholds)]
        for tree, table in zip(self.trees, self.places):
            places = {f: table[f][ranks[f]] if f in table else np.searchsorted(own, x[:, f], side="left")
                      for f, own in tree.thresholds.items()}
            yield tree, tree.leaf(places, len(x))


def _chunks(x: pa.Array):
    """``(rows, features)`` of the rows that have features, a chunk at a time."""
    known = np.flatnonzero(x.is_valid().to_numpy(zero_copy_only=False))
    for at in range(0, len(known), CHUNK_ROWS):
        rows = known[at: at + CHUNK_ROWS]
        yield rows, x.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def _lists(values: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Rows of ``values`` as lists, null where not ``valid``."""
    offsets = np.concatenate([[0], np.cumsum(np.where(valid, values.shape[1], 0))]).astype(np.int32)
    flat = pa.array(values[valid].ravel())
    return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array(~valid))


def packed(nodes: DataFrame) -> PackedForest:
    """The forest of a node table, on the driver: its size is the configuration's."""
    vote = "votes" if "votes" in nodes.columns else "vote"
    return PackedForest(nodes.select("k", "tree", "node", "f", "thr", vote).toArrow().to_pylist(), vote)


def vote_sums(forest: PackedForest, spark, x: Column) -> Column:
    """Array over keys (and classes, key by key) of the summed leaf votes; null where ``x`` is null."""
    known = spark.sparkContext.broadcast(forest)

    @F.arrow_udf("array<long>")
    def sums(x: pa.Array) -> pa.Array:
        f = known.value
        wide = f.trees[0].votes[:1].size if f.trees else 1
        out = np.zeros((len(x), len(f.keys) * wide), dtype=np.int64)
        at = {k: i * wide for i, k in enumerate(f.keys)}
        for rows, values in _chunks(x):
            for (k, _), (tree, leaf) in zip(f.names, f.leaves(values)):
                out[rows, at[k]: at[k] + wide] += tree.votes[leaf].reshape(len(rows), wide)
        return _lists(out, x.is_valid().to_numpy(zero_copy_only=False))

    return sums(x)


def leaf_numbers(forest: PackedForest, spark, x: Column) -> Column:
    """Array over all trees of the node number of the reached leaf; null where ``x`` is null."""
    known = spark.sparkContext.broadcast(forest)

    @F.arrow_udf("array<long>")
    def numbers(x: pa.Array) -> pa.Array:
        f = known.value
        out = np.zeros((len(x), len(f.trees)), dtype=np.int64)
        nodes = [np.array(t.leaves) for t in f.trees]
        for rows, values in _chunks(x):
            for i, (_, leaf) in enumerate(f.leaves(values)):
                out[rows, i] = nodes[i][leaf]
        return _lists(out, x.is_valid().to_numpy(zero_copy_only=False))

    return numbers(x)
