"""Draws by vectorised hashes and trees grown in one task, against their plan and level forms."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sylvan.functions import md5
from sylvan.operators import growth
from sylvan.operators import sampling as sa
from sylvan.plans import forest as pf


@pytest.mark.parametrize("length", [0, 1, 4, 53, 55, 56, 58, 62, 63, 64, 65, 119, 120, 130])
def test_digests_are_those_of_md5(length):
    begins = np.random.default_rng(length).integers(0, 256, (4, length), dtype=np.uint8)
    for ends in ([b"7"], [b"10", b"11", b"24"], [b""]):
        words = md5.digests(begins, ends)
        for e, end in enumerate(ends):
            for i, begin in enumerate(begins):
                got = b"".join(int(w[e, i]).to_bytes(4, "little") for w in words)
                assert got == hashlib.md5(begin.tobytes() + end).digest()


@pytest.mark.parametrize("p", [0.0, 0.1, 1.0])
def test_row_draws_are_those_of_the_plan(spark, p):
    """Ids of many lengths, beyond ASCII, empty and null; trees over several hashes, some slices without a tree."""
    trees = [growth.Tree(k, t, 1, 1, (0,)) for k in ("a", "min_samples_leaf=200,max_depth=10") for t in [1, 2, 3, 5, 6, *range(38, 47)]]
    ids = [str(7 ** i) for i in range(70)] + ["", "é-ü", None] * 3
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(ids)], "i int, rid string")
    want = {(r.i, t) for r in sa.drawn_trees(rows, trees, p, "7").collect() for t in r.drawn}
    row, tree = sa.row_draws(trees, p, "7")(pa.array(["left out", *ids], pa.string())[1:])
    assert sorted(zip(row.tolist(), tree.tolist())) == sorted(want)
    assert p == 0 or want


@pytest.mark.parametrize("task, n_classes, edges", [
    ("clf", 0, None), ("clf", 0, [[1.0, 4.0, 7.0], [0.5, 3.0], []]), ("reg", 0, None), ("reg", 0, [[2.0], [0.0, 5.0, 6.0], [9.0]]), ("multi", 3, None)])
def test_a_tree_grown_in_one_task_is_the_one_grown_by_levels(spark, task, n_classes, edges):
    rnd = random.Random(5)
    trees = [growth.Tree("a", 1, 1, 6, (0, 1, 2)), growth.Tree("a", 2, 3, 2, (0, 2)), growth.Tree("b", 1, 15, 3, (1,)), growth.Tree("b", 2, 1, 4, (2,))]
    rows = []
    for i in range(300):
        x = [float(rnd.randint(0, 9 + 3 * f)) / 2 for f in range(3)]
        y = {"clf": int(x[0] + x[1] > 5) ^ (rnd.random() < 0.2), "reg": int(100 * x[1]) - 300 + rnd.randint(0, 2 ** 40 if i == 7 else 50), "multi": rnd.randint(0, 2)}[task]
        rows.append((str(i), x, int(y), sorted(rnd.sample(range(3), rnd.randint(0, 3)))))  # the last tree draws no row
    df = spark.createDataFrame(rows, "rid string, x array<double>, y long, drawn array<int>").repartition(3)

    def draws(ids: pa.Array):
        pairs = [(i, t) for i, rid in enumerate(ids.to_pylist()) for t in rows[int(rid)][3]]
        return tuple(np.array(c, np.int64) for c in (zip(*pairs) if pairs else ((), ())))

    want = growth.grow(df, trees, 3, task, n_classes, edges).collect()
    assert growth.grow_whole(df, draws, trees, 3, task, n_classes, edges).collect() == want
    assert max(r.depth for r in want) > 2


def test_trees_of_bounded_rows_are_grown_without_a_scan_a_level(spark, monkeypatch):
    """Nor are their draws worked out in the plan, a column a hash."""
    def none(*_, **__):
        raise AssertionError("bounded trees are grown whole")

    rows = spark.range(400).select(F.col("id").cast("string").alias("rid"), F.array((F.col("id") % 7).cast("double"), (F.col("id") % 5).cast("double")).alias("x"),
                                   (F.col("id") % 3 == 0).cast("long").alias("y"))
    cfg = pf.ForestConfig(grid={"max_depth": [4], "min_samples_leaf": [2]}, n_trees=6, max_rows=100)
    monkeypatch.setattr(growth, "WHOLE_ROWS", 0)
    want = pf.fit_forest(rows, cfg, 2).collect()
    monkeypatch.undo()
    monkeypatch.setattr(growth, "level_cells", none)
    monkeypatch.setitem(pf.DRAWS, "test", none)
    assert pf.fit_forest(rows, cfg, 2).collect() == want
    assert len({r.tree for r in want}) == 6 and {r.depth for r in want} > {0, 1, 2}
