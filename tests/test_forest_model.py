"""Fitting, evaluating, predicting, saving and loading on tables other than lineitem."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sylvan.operators import metrics as me
from sylvan.plans import forest as pf
from sylvan.plans import forest_queries as fq
from tests.conftest import SF_SMALL

CFG = pf.ForestConfig(grid={"max_depth": [2, 4]}, n_trees=3, max_rows=None, min_cols=3, max_p=0.9)


def _table(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        a, b, c, d = rng.random(), rng.random(), rng.choice("uvw"), rng.choice(["x", "y"])
        rows.append((f"r{i}", a, b, c, d, int(a > 0.5 or c == "u"), 10 * a + (5 if d == "x" else 0), "clash"))
    rows.append(("null", None, 0.3, "u", "x", None, None, "clash"))
    rows.append(rows[0])
    return spark.createDataFrame(rows, "name string, a double, b double, c string, d string, y int, z double, k string")


def test_classifier_on_any_table_round_trips(spark, tmp_path):
    rows = _table(spark)
    model = pf.fit(rows, ["a", "b"], "y", CFG, ["c", "d"])
    scores = {r["k"]: r["auc"] for r in model.evaluate(rows).collect()}
    assert set(scores) == {"max_depth=2", "max_depth=4"} and max(scores.values()) > 0.9
    out = model.predict(rows)
    assert out.columns == [*rows.columns, "prediction", "probability"] and out.count() == rows.count()
    by = out.collect()
    assert [r["prediction"] for r in by if r["name"] == "null"] == [None]
    assert sum(r["name"] == "r0" for r in by) == 2
    loaded = pf.ForestModel.load(spark, model.save(f"{tmp_path}/model"))
    assert loaded.nodes.count() == model.nodes.count() and loaded.cfg == model.cfg
    assert sorted(map(str, loaded.predict(rows).collect())) == sorted(map(str, by))


def test_regression_on_a_real_label(spark):
    cfg = pf.ForestConfig(grid={"max_depth": [5], "min_samples_leaf": [2]}, n_trees=4, task="reg", max_rows=None, min_cols=3, max_p=0.9)
    rows = _table(spark)
    model = pf.fit(rows, ["a", "b"], "z", cfg, ["d"])
    assert model.evaluate(rows).first()["mse"] < 0.3 * rows.agg(F.var_pop("z")).first()[0]
    assert model.predict(rows).filter("prediction is null").count() == 1


def test_prediction_needs_an_evaluated_key(spark):
    with pytest.raises(ValueError):
        pf.fit(_table(spark), ["a", "b"], "y", CFG).predict(_table(spark))


@pytest.mark.parametrize("cfg,query,metric", [(fq.CLF, fq.forest_fit_clf, "auc"), (fq.REG, fq.forest_fit_reg, "mse")])
def test_mllib_forest_scores_like_the_histogram_forest(spark, cfg, query, metric):
    res = pf.run_grid(spark, SF_SMALL, cfg)
    own = {r["k"]: r[metric] for r in res.scores.collect()}
    labels = pf.feature_rows(spark, SF_SMALL, cfg)[1].select("rid", "y")
    joined = query(spark, SF_SMALL).join(labels, "rid")
    if metric == "auc":
        other = {r["k"]: r["auc"] for r in me.auc_by_key(joined, score="prediction").collect()}
        assert all(abs(own[k] - other[k]) < 0.12 for k in own)
    else:
        other = {r["k"]: r["mse"] for r in joined.groupBy("k").agg(F.avg((F.col("prediction") / 100 - F.col("y") / 100) ** 2).alias("mse")).collect()}
        assert all(0.7 < own[k] / other[k] < 1.4 for k in own)


def test_mllib_predictions_read_the_written_test_rows(spark):
    """Every key's predictions read the few test rows, not the whole table that they are picked from."""
    out = fq.forest_fit_reg(spark, SF_SMALL)
    assert out.inputFiles() and all("/mllib-test-" in f for f in out.inputFiles())
