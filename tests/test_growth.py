"""Growing and scoring forests against brute force: several trees, depths, classes, and the siblings' subtraction."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylvan.operators import forest as fo
from sylvan.operators import growth, quickscore
from sylvan.operators import sampling as sa
from sylvan.functions import params as P


def data(seed, n, n_features, labels):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [float(rnd.randint(0, 9 + 3 * f)) for f in range(n_features)]
        rows.append((x, labels(x, rnd), sorted(rnd.sample(range(3), rnd.randint(0, 3)))))
    return rows


TREES = [growth.Tree("a", 1, 1, 5, (0, 1, 2)), growth.Tree("a", 2, 1, 5, (0, 2)), growth.Tree("b", 1, 15, 3, (1, 2))]


def brute(rows, trees, task, n_classes):
    """Node tables by plain recursion: ``(k, tree, node) -> (n, sums, f, thr)``."""
    out = {}

    def sums(part):
        return [sum(y == c for _, y in part) for c in range(n_classes)] if n_classes else [sum(y for _, y in part)]

    def grow(t, node, depth, part):
        n, s = len(part), sums(part)
        out[t.k, t.tree, node] = [n, s, None, None]
        pure = n in s if n_classes else task == "clf" and s[0] in (0, n)
        if depth >= t.max_depth or n < 2 * t.min_leaf or pure:
            return
        best = None
        for f in t.mask:
            values = sorted({x[f] for x, _ in part})
            for v, w in zip(values, values[1:]):
                left = [r for r in part if r[0][f] <= v]
                right = [r for r in part if r[0][f] > v]
                if min(len(left), len(right)) >= t.min_leaf:
                    score = sum(float(a) * a for a in sums(left)) / len(left) + sum(float(a) * a for a in sums(right)) / len(right)
                    thr = (v + w) / 2.0
                    if best is None or (-score, f, thr) < best[:3]:
                        best = (-score, f, thr, left, right)
        if best:
            out[t.k, t.tree, node][2:] = best[1:3]
            grow(t, 2 * node, depth + 1, best[3])
            grow(t, 2 * node + 1, depth + 1, best[4])

    for number, t in enumerate(trees):
        part = [(x, y) for x, y, drawn in rows if number in drawn]
        if part:
            grow(t, 1, 0, part)
    return out


CASES = {
    "clf": (0, lambda x, rnd: int(x[0] > 4 or x[2] > 11 or rnd.random() < 0.2)),
    "reg": (0, lambda x, rnd: int(100 * x[0] - 70 * x[1] + rnd.randint(-900, 900)) * 3_000_001),
    "multi": (4, lambda x, rnd: min(3, int(x[0] // 4) + (rnd.random() < 0.3))),
}


@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("task", list(CASES))
def test_nodes_equal_brute_force(spark, monkeypatch, task, dense):
    n_classes, labels = CASES[task]
    rows = data(3, 500, 3, labels)
    if not dense:
        monkeypatch.setattr(growth, "DENSE_CELLS", 0)
        monkeypatch.setattr(growth, "CHUNK_ROWS", 60)
    df = spark.createDataFrame(rows, "x array<double>, y long, drawn array<int>").repartition(4)
    nodes = growth.grow(df, TREES, 3, task, n_classes)
    want = brute(rows, TREES, task, n_classes)
    got = {(r.k, r.tree, r.node): [r.n, list(r.counts) if n_classes else [r.s], r.f, r.thr] for r in nodes.collect()}
    assert got == want
    assert max(len(f"{node:b}") - 1 for _, _, node in want) == 5
    for r in nodes.collect():
        votes = list(r.votes) if n_classes else [r.vote]
        assert votes == [int(np.floor(float(s) * fo.VOTE_SCALE[task] / r.n + 0.5)) for s in want[r.k, r.tree, r.node][1]]


def test_levels_after_the_first_count_at_most_half_of_the_rows(spark, monkeypatch):
    rows = data(3, 600, 3, CASES["clf"][1])
    counted = []
    real = growth.level_cells

    def watched(df, trees, n_features, splits, *rest):
        batches = [(np.array([x for x, _, _ in rows]), [d for _, _, d in rows])]
        for x, drawn in batches:
            row = np.array([i for i, d in enumerate(drawn) for _ in d])
            tree = np.array([t for d in drawn for t in d])
            counted.append(len(splits.walk(x, row, tree)[0]))
        return real(df, trees, n_features, splits, *rest)

    monkeypatch.setattr(growth, "level_cells", watched)
    df = spark.createDataFrame(rows, "x array<double>, y long, drawn array<int>")
    growth.grow(df, TREES, 3, "clf")
    pairs = sum(len(d) for _, _, d in rows)
    assert counted[0] == pairs and len(counted) == 5
    assert all(0 < c <= pairs / 2 for c in counted[1:])


def reached(nodes, x):
    """Leaf by walking the tree."""
    at = 1
    while nodes[at].f is not None:
        at = 2 * at + (x[nodes[at].f] > nodes[at].thr)
    return nodes[at]


@pytest.mark.parametrize("table", [True, False])
@pytest.mark.parametrize("task", ["clf", "multi"])
def test_masks_reach_the_leaves_of_a_walk(spark, monkeypatch, task, table):
    n_classes, labels = CASES[task]
    if not table:
        monkeypatch.setattr(quickscore, "TABLE_THRESHOLDS", 0)
    trees = [growth.Tree("a", 1, 1, 9, (0, 1, 2)), *TREES[1:]]
    rows = data(4, 3000, 3, labels if n_classes else lambda x, rnd: rnd.randint(0, 1))
    nodes = growth.grow(spark.createDataFrame(rows, "x array<double>, y long, drawn array<int>"), trees, 3, task, n_classes)
    by = {}
    for r in nodes.collect():
        by.setdefault((r.k, r.tree), {})[r.node] = r
    assert max(sum(n.is_leaf for n in t.values()) for t in by.values()) > 64  # more than one word of bits
    rnd = random.Random(1)
    points = [[rnd.choice([v, v + 0.5, -1.0, 99.0]) for v in (float(rnd.randint(0, 16)) for _ in range(3))] for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*points, None])], "rid long, x array<double>")
    sums = {}
    for r in fo.forest_votes(df, nodes).collect():
        sums[r.rid, r.k] = (list(r.scores) if r.scores is not None else None) if n_classes else r.score
        assert r.n_trees == sum(k == r.k for k, _ in by)
    for i, x in enumerate(points):
        for k in ("a", "b"):
            leaves = [reached(t, x) for (key, _), t in by.items() if key == k]
            want = [sum(c) for c in zip(*[n.votes for n in leaves])] if n_classes else sum(n.vote for n in leaves)
            assert sums[i, k] == want
    assert sums[300, "a"] is None
    if not n_classes:
        for r in fo.route_to_leaves(df.filter("rid < 50"), nodes).collect():
            leaf = reached(by[r.k, r.tree], points[r.rid])
            assert (r.node, r.vote) == (leaf.node, leaf.vote)


def test_class_ties_go_to_the_first_class(spark):
    votes = spark.createDataFrame([("k", [5, 9, 9], 2), ("k", None, 2)], "k string, scores array<long>, n_trees long")
    out = fo.class_outputs(votes).collect()
    assert [r.prediction for r in out] == [1.0, None]
    assert out[0].probability == [c / (2 * fo.VOTE_SCALE["multi"]) for c in (5, 9, 9)]


def test_trees_without_rows_and_empty_tables(spark):
    rows = spark.createDataFrame([([1.0, 2.0, 3.0], 1, [1])], "x array<double>, y long, drawn array<int>")
    nodes = growth.grow(rows, TREES, 3, "clf")
    assert [(r.k, r.tree, r.n, r.is_leaf) for r in nodes.collect()] == [("a", 2, 1, True)]
    none = growth.grow(rows.limit(0), TREES, 3, "clf")
    assert none.collect() == [] and none.columns == nodes.columns
    assert fo.forest_votes(rows, none).collect() == []
    with pytest.raises(ValueError):
        growth.grow(rows, TREES, 3, "multi")


def test_masks_and_draws_equal_their_table_forms(spark):
    grid = {"min_samples_leaf": [1, 5], "max_depth": [2]}
    trees = sa.tree_masks(P.grid_points(grid), 6, 5, 0.4, 3, "7")
    table = sa.column_mask(sa.grid_trees(sa.param_grid(spark, grid), 6), 5, 0.4, 3, "7")
    assert {(r.k, r.tree): tuple(r.mask) for r in table.collect()} == {(t.k, t.tree): t.mask for t in trees}
    rows = spark.range(400).select(F.col("id").cast("string").alias("rid"))
    for p in (0.2, 1.0):
        want = {(r.rid, r.k, r.tree) for r in sa.tree_sample(rows, table, p, "7").collect()}
        drawn = sa.drawn_trees(rows, trees, p, "7").collect()
        assert {(r.rid, trees[t].k, trees[t].tree) for r in drawn for t in r.drawn} == want
        assert all(r.drawn for r in drawn)


def test_many_real_valued_features_are_binned_and_refused_unbinned(spark):
    from sylvan.operators import binning
    from sylvan.plans import forest as pf

    features = 500
    rows = spark.range(300).select(
        F.col("id").cast("string").alias("rid"), (F.rand(1) < 0.5).cast("long").alias("y"),
        F.transform(F.sequence(F.lit(1), F.lit(features)), lambda i: F.sin(F.col("id") * i + 0.25)).alias("x")).checkpoint()
    cfg = pf.ForestConfig(grid={"max_depth": [3], "min_samples_leaf": [5]}, n_trees=2, max_rows=None, max_values=100)
    with pytest.raises(ValueError, match="max_bins"):
        pf.fit_forest(rows, cfg, features)
    edges = binning.quantile_edges(rows, features, 64)
    assert all(len(e) <= 63 and e == sorted(set(e)) for e in edges)
    nodes = pf.fit_forest(rows, pf.replace(cfg, max_bins=64), features).collect()
    assert {r.depth for r in nodes} == {0, 1, 2, 3}
    for r in nodes:
        if not r.is_leaf:
            assert r.thr in edges[r.f]


def test_rows_are_hashed_once_for_their_draws(spark):
    """The filter of undrawn rows stays above the drawing, so that each hash stands once in the plan; null ids are drawn too."""
    trees = [growth.Tree(k, t, 1, 1, (0,)) for k in ("a", "b") for t in range(1, 7)]
    rows = spark.createDataFrame([(str(i),) for i in range(300)] + [(None,)], "rid string")
    drawn = sa.drawn_trees(rows, trees, 0.1, "7")
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 4
    assert {tuple(r.drawn) for r in sa.drawn_trees(rows, trees, 1.0, "7").collect()} == {tuple(range(12))}
    got = drawn.collect()
    assert 0 < len(got) < 301 and all(r.drawn == sorted(r.drawn) and r.drawn for r in got)


def test_labels_are_summed_exactly_with_partial_masks():
    trees = [growth.Tree("a", 1, 1, 2, (0, 1)), growth.Tree("a", 2, 1, 2, (1,))]
    x, y = np.array([[0.0, 1.0], [1.0, 1.0], [1.0, 0.0]]), np.array([-5, 2 ** 45 + 1, 3], dtype=np.int64)
    row, tree = np.array([0, 0, 1, 2, 2]), np.array([0, 1, 1, 0, 1])
    cells = growth.count_cells(x, y, row, tree, growth.Splits(trees, 2), 0)
    assert sorted(map(tuple, zip(*[c.tolist() for c in cells]))) == [
        (0, 1, 0, 0.0, 1, -5), (0, 1, 0, 1.0, 1, 3), (0, 1, 1, 0.0, 1, 3), (0, 1, 1, 1.0, 1, -5),
        (1, 1, 1, 0.0, 1, 3), (1, 1, 1, 1.0, 2, 2 ** 45 - 4)]
