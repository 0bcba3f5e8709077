"""Failure paths, and plans that do not depend on the size of the data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sylvan.functions.params import grid_points
from sylvan.operators import features as feat
from sylvan.plans import forest as pf
from sylvan.sources.tables import MIN_PARTITIONS, spread
from tests.conftest import SF_SMALL


def test_binned_grid_runs_end_to_end(spark):
    cfg = pf.ForestConfig(max_bins=8, n_trees=2)
    res = pf.run_grid(spark, SF_SMALL, cfg)
    scores = {r["k"]: r["auc"] for r in res.scores.collect()}
    assert set(scores) == {k for k, _ in grid_points(cfg.grid)}
    assert all(0.0 <= v <= 1.0 for v in scores.values())
    preds = pf.best_predictions(res, "clf")
    assert preds.count() * len(scores) == res.votes.count()


def test_unseen_label_is_an_error_and_a_null_one_is_not(spark):
    labels = feat.string_index_table(spark.createDataFrame([("a",), ("b",), ("b",)], "s string"), "s")
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "s string, v double")
    assert sorted(r["s_idx"] is None for r in feat.index_labels(df, labels, "s").collect()) == [False, True]
    with pytest.raises(Exception, match="unseen label"):
        feat.index_labels(df.filter("s is null").select(F.lit("zz").alias("s")), labels, "s").collect()


def test_label_order_is_frequency_then_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s string")
    got = {r["value"]: r["idx"] for r in feat.string_index_table(df, "s").collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_spread_is_off_unless_asked_for(spark):
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one) is one
    assert spread(one, keys=["id"], partitions=7).rdd.getNumPartitions() == 7
    spark.conf.set(MIN_PARTITIONS, "3")
    try:
        assert spread(one, keys=["id"]).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(MIN_PARTITIONS)


def test_a_scan_of_few_splits_is_dealt_out_over_the_cores(spark):
    from sylvan.sources.tables import spread_over_cores

    cores = spark.sparkContext.defaultParallelism
    one, many = spark.range(10).coalesce(1), spark.range(0, 100, 1, cores + 1)
    assert spread_over_cores(one, keys=["id"]).rdd.getNumPartitions() == cores and spread_over_cores(many) is many
    assert sorted(r.id for r in spread_over_cores(one).collect()) == list(range(10))
