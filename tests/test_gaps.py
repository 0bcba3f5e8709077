"""Draws by gaps: shares, reruns, the plain definition, and blocks whose first gaps do not reach the end."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sylvan.functions.hashing import uniform_value
from sylvan.operators import gaps
from sylvan.operators.growth import Tree
from sylvan.plans import forest as pf
from tests.conftest import SF_SMALL

TREES = [Tree("a", 1, 1, 1, (0,)), Tree("a", 2, 1, 1, (0,)), Tree("b", 1, 1, 1, (0,))]


def plain(ids, trees, p, seed, block_rows):
    """The definition, row by row."""
    blocks = gaps.block_count(len(ids), block_rows)
    dealt = {}
    for rid in ids:
        dealt.setdefault(int(uniform_value("block", seed, rid) * blocks), []).append(rid)
    out = []
    for t in trees:
        for block, members in dealt.items():
            members = sorted(members)
            at, i = -1, 0
            while True:
                skipped = 0 if p >= 1 else math.floor(math.log(1.0 - uniform_value("gap", seed, t.k, t.tree, block, i)) / math.log(1.0 - p))
                at, i = at + 1 + skipped, i + 1
                if at >= len(members):
                    break
                out.append((t.k, t.tree, members[at]))
    return sorted(out)


def sampled(rows, p, block_rows=gaps.BLOCK_ROWS):
    return sorted((r.k, r.tree, r.rid) for r in gaps.gap_sample(rows, TREES, p, "7", block_rows).collect())


@pytest.mark.parametrize("p", [0.01, 0.4, 1.0])
def test_draws_equal_the_definition_and_rerun_alike(spark, p):
    ids = [f"r{i}" for i in range(900)]
    rows = spark.createDataFrame([(i,) for i in ids], "rid string")
    got = sampled(rows, p, 250)
    assert got == plain(ids, TREES, p, "7", 250)
    assert got == sampled(rows.repartition(5), p, 250)


def test_blocks_that_end_early_go_on(spark, monkeypatch):
    monkeypatch.setattr(gaps, "SPARE_DEVIATIONS", -3)
    monkeypatch.setattr(gaps, "SPARE_GAPS", 1)
    ids = [f"r{i}" for i in range(700)]
    rows = spark.createDataFrame([(i,) for i in ids], "rid string")
    assert sampled(rows, 0.3, 100) == plain(ids, TREES, 0.3, "7", 100)


def test_share_is_near_p_for_every_tree(spark):
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("rid"))
    got = Counter((r.k, r.tree) for r in gaps.gap_sample(rows, TREES, 0.05, "s").collect())
    sd = (40_000 * 0.05 * 0.95) ** 0.5
    assert set(got) == {(t.k, t.tree) for t in TREES}
    assert all(abs(n - 2000) < 3 * sd for n in got.values())


def test_arrays_hold_the_same_draws_and_edges(spark):
    ids = [f"r{i}" for i in range(300)]
    rows = spark.createDataFrame([(i, "x") for i in ids], "rid string, size string")
    drawn = gaps.gap_drawn_trees(rows, TREES, 0.2, "7", 100).collect()
    assert sorted((TREES[t].k, TREES[t].tree, r.rid) for r in drawn for t in r.drawn) == plain(ids, TREES, 0.2, "7", 100)
    assert all(r.drawn == sorted(set(r.drawn)) and r["size"] == "x" for r in drawn)
    assert sampled(rows.limit(0), 0.2) == []
    with pytest.raises(ValueError):
        gaps.gap_sample(rows, TREES, 0.0, "7")


def test_a_forest_grows_from_gaps(spark):
    cfg = pf.ForestConfig(n_trees=2, draws="gaps", max_p=0.2)
    scores = pf.run_grid(spark, SF_SMALL, cfg).scores.collect()
    assert len(scores) == 4 and all(0.0 <= r.auc <= 1.0 for r in scores)
