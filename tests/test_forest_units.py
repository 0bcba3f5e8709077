"""Forest, sampling and metric operators on literal rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sylvan.functions import params as P
from sylvan.functions.hashing import uniform
from sylvan.operators import growth
from sylvan.operators import metrics as me
from sylvan.operators import sampling as sa

def _rows(spark, rows, drawn=(0,)):
    return spark.createDataFrame([([float(v) for v in x], int(y), list(drawn)) for x, y in rows],
                                 "x array<double>, y long, drawn array<int>")


def _grow(spark, rows, task="clf", min_leaf=1, max_depth=1, mask=(0, 1), n_classes=0, **kw):
    trees = [growth.Tree("k", 1, min_leaf, max_depth, tuple(mask))]
    nodes = growth.grow(_rows(spark, rows), trees, 2, task, n_classes, **kw)
    return {r["node"]: r for r in nodes.collect()}


def test_stump_finds_the_separating_threshold(spark):
    rows = [([1, 0], 0), ([2, 0], 0), ([3, 0], 1), ([4, 0], 1)]
    nodes = _grow(spark, rows)
    root = nodes[1]
    assert (root["f"], root["thr"], root["n"], root["s"]) == (0, 2.5, 4, 2)
    assert nodes[2]["is_leaf"] and nodes[2]["vote"] == 0
    assert nodes[3]["is_leaf"] and nodes[3]["vote"] == 1_000_000_000


def test_equal_scores_pick_the_smaller_feature(spark):
    rows = [([1, 1], 0), ([2, 2], 0), ([3, 3], 1), ([4, 4], 1)]
    assert _grow(spark, rows)[1]["f"] == 0
    assert _grow(spark, rows, mask=(1,))[1]["f"] == 1


def test_no_valid_split_makes_a_leaf(spark):
    rows = [([1, 0], 0), ([2, 0], 1), ([3, 0], 0)]
    nodes = _grow(spark, rows, min_leaf=2)
    assert list(nodes) == [1]
    assert nodes[1]["is_leaf"] and nodes[1]["n"] == 3 and nodes[1]["s"] == 1


def test_pure_node_is_not_split(spark):
    rows = [([1, 0], 1), ([2, 0], 1), ([3, 0], 1)]
    nodes = _grow(spark, rows)
    assert list(nodes) == [1] and nodes[1]["is_leaf"]


def test_depth_two_routes_rows_to_children(spark):
    rows = [([1, 5], 0), ([2, 6], 1), ([3, 1], 1), ([4, 2], 0), ([5, 9], 1), ([6, 9], 1)]
    nodes = _grow(spark, rows, max_depth=2)
    assert sum(r["n"] for r in nodes.values() if r["is_leaf"]) == 6
    assert all(r["depth"] <= 2 for r in nodes.values())


def test_regression_split_is_variance_reduction(spark):
    rows = [([1, 0], 100), ([2, 0], 110), ([3, 0], 1000), ([4, 0], 1010)]
    nodes = _grow(spark, rows, task="reg")
    assert nodes[1]["thr"] == 2.5
    assert nodes[2]["vote"] == 105_000 and nodes[3]["vote"] == 1_005_000


def test_stump_equals_mllib_depth_one_tree(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import DecisionTreeRegressor

    rnd = random.Random(3)
    rows = []
    for _ in range(400):
        a, b = rnd.randint(0, 9), rnd.randint(0, 9)
        rows.append(([a, b], int(a >= 6 or rnd.random() < 0.1)))
    nodes = _grow(spark, rows)
    df = spark.createDataFrame([([float(v) for v in x], float(y)) for x, y in rows], "x array<double>, label double")
    model = DecisionTreeRegressor(maxDepth=1, maxBins=32, featuresCol="features").fit(
        df.select(array_to_vector("x").alias("features"), "label"))
    split = model._call_java("rootNode").split()
    assert nodes[1]["f"] == split.featureIndex()
    assert nodes[1]["thr"] == pytest.approx(split.threshold())


def test_sampling_rate_has_no_floor(spark):
    assert P.sampling_rate(100, 0.5, 1000) == 0.5
    assert P.sampling_rate(5_000_000, 0.5, 20_000) == 0.004
    assert P.sampling_rate(10 ** 13, 0.5, 20_000) > 0
    assert P.sampling_rate(5_000_000, 0.5, None) == 0.5
    with pytest.raises(ValueError):
        P.sampling_rate(0, 0.5, 100)
    sizes = [3, 40_000, 5_000_000, 10 ** 12]
    rows = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", P.sampling_rate_col(F.col("n"), 0.5, 20_000).alias("p"))
    assert all(r["p"] == P.sampling_rate(r["n"], 0.5, 20_000) for r in rows.collect())


def test_grid_takes_whichever_parameters_are_given():
    with pytest.raises(ValueError):
        P.grid_points({"min_samples_leaf": [1], "max_depth": [2], "criterion": ["gini"]})
    with pytest.raises(ValueError):
        P.grid_points({})
    assert [k for k, _ in P.grid_points({"min_samples_leaf": [1, 2], "max_depth": [3]})] == [
        "min_samples_leaf=1,max_depth=3", "min_samples_leaf=2,max_depth=3"]
    assert P.grid_points({"max_depth": [3]}) == [("max_depth=3", {"min_samples_leaf": 1, "max_depth": 3})]


def test_param_key_parse_ignores_order(spark):
    df = spark.createDataFrame([("tree_id=3,max_depth=2,min_samples_leaf=20",)], "key string")
    parsed = P.parse_key(F.col("key"))
    row = df.select(*parsed.values()).first()
    assert (row["k"], row["min_samples_leaf"], row["max_depth"], row["tree"]) == (
        "min_samples_leaf=20,max_depth=2", 20, 2, 3)


def test_hex_threshold_equals_numeric_uniform(spark):
    for p in [0.0, 0.01, 0.29, 0.5, 0.999, 1.0]:
        th = sa.below_threshold_hex(p)
        df = spark.range(2000).select(F.substring(F.md5(F.col("id").cast("string")), 1, 8).alias("h"))
        u = F.conv("h", 16, 10).cast("double") / F.lit(4294967296.0)
        by_hex = F.lit(True) if th is None else F.col("h") < F.lit(th)
        bad = df.filter((u < F.lit(p)) != by_hex).count()
        assert bad == 0, p


def test_column_mask_fills_up_to_minimum(spark):
    grid = sa.param_grid(spark, {"min_samples_leaf": [1], "max_depth": [1]})
    trees = sa.grid_trees(grid, 20)
    none = sa.column_mask(trees, 5, 0.0, 3, "s").collect()
    assert all(len(r["mask"]) == 3 for r in none)
    everything = sa.column_mask(trees, 5, 1.0, 3, "s").collect()
    assert all(r["mask"] == [0, 1, 2, 3, 4] for r in everything)
    clipped = sa.column_mask(trees, 2, 0.0, 5, "s").collect()
    assert all(r["mask"] == [0, 1] for r in clipped)


def test_tree_sample_share_is_near_p(spark):
    grid = sa.param_grid(spark, {"min_samples_leaf": [1], "max_depth": [1, 2]})
    trees = sa.grid_trees(grid, 6)
    rows = spark.range(5000).select(F.col("id").cast("string").alias("rid"))
    n = sa.tree_sample(rows, trees, 0.3, "seed").count()
    expected, sd = 5000 * 12 * 0.3, (5000 * 12 * 0.3 * 0.7) ** 0.5
    assert abs(n - expected) < 3 * sd


def test_auc_matches_mllib_evaluator_with_ties(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rnd = random.Random(11)
    rows = [("k", rnd.randint(0, 20) / 20.0, rnd.randint(0, 1)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, score double, y long")
    ours = me.auc_by_key(df, n_buckets=7).first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    theirs = ev.evaluate(df.select("score", F.col("y").cast("double").alias("label")))
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_auc_swapped_is_null_for_one_predicted_class(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 1.0, 0), ("b", 1.0, 1), ("b", 0.0, 0)],
                               "k string, prediction double, y long")
    got = {r["k"]: r["auc_swapped"] for r in me.auc_swapped_by_key(df).collect()}
    assert got["a"] is None and got["b"] == 1.0


def test_select_best_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 0.7), ("a", 0.7), ("c", 0.6)], "k string, auc double")
    assert me.select_best(df, "auc", True).first()["k"] == "a"
    assert me.select_best(df, "auc", False).first()["k"] == "c"


def test_uniform_is_in_unit_interval(spark):
    df = spark.range(1000).select(uniform("t", "1", F.col("id")).alias("u"))
    row = df.agg(F.min("u").alias("lo"), F.max("u").alias("hi"), F.avg("u").alias("m")).first()
    assert 0.0 <= row["lo"] and row["hi"] < 1.0 and abs(row["m"] - 0.5) < 0.05


def test_binned_forest_matches_exact_when_bins_separate_all_values(spark):
    from sylvan.operators import binning

    rows = [([i % 10, (i * 7) % 13], int((i * 31) % 17 < 6 or i % 10 > 6)) for i in range(1300)]
    exact = _grow(spark, rows, min_leaf=20, max_depth=3)
    edges = binning.quantile_edges(_rows(spark, rows), 2, 64)
    assert edges == [[float(v) for v in range(10)], [float(v) for v in range(13)]]
    binned = _grow(spark, rows, min_leaf=20, max_depth=3, edges=edges)
    assert set(binned) == set(exact)
    for node, r in exact.items():
        b = binned[node]
        assert (b["n"], b["s"], b["f"], b["is_leaf"], b["vote"]) == (r["n"], r["s"], r["f"], r["is_leaf"], r["vote"])
        if not r["is_leaf"]:
            assert b["thr"] == r["thr"] - 0.5  # edge value vs midpoint to the next integer


def test_bin_index_is_count_of_edges_below(spark):
    from sylvan.operators import binning

    edges = [0.5, 1.5, 2.5, 10.0]
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.5, 0.6, 2.5, 3.0, 10.0, 11.0]], "v double")
    got = [r["b"] for r in df.select(binning.bin_index(F.col("v"), edges).alias("b")).collect()]
    assert got == [0, 0, 1, 2, 3, 3, 4]
