"""The metric as an argument, and a model of three classes from fit to a loaded copy."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sylvan.operators import metrics as me
from sylvan.plans import forest as pf


def test_metrics_on_literal_rows(spark):
    rows = spark.createDataFrame([("k", 1.0, 1, 0.8), ("k", 0.0, 1, 0.4), ("k", 0.0, 0, 0.0), ("j", 1.0, 0, 1.0)],
                                 "k string, prediction double, y long, p double")
    assert {r.k: r.accuracy for r in me.accuracy_by_key(rows).collect()} == {"k": 2 / 3, "j": 0.0}
    loss = {r.k: r.log_loss for r in me.log_loss_by_key(rows, F.col("p")).collect()}
    assert loss["k"] == pytest.approx(-(math.log(0.8) + math.log(0.4) + math.log(me.LEAST_PROBABILITY)) / 3, abs=1e-6)
    votes = spark.createDataFrame([("k", 2 * 1000 * 150, 2, 100), ("k", 2 * 1000 * 70, 2, 100)], "k string, score long, n_trees long, y long")
    assert me.mae_by_key(votes, 1000.0).first()["mae"] == pytest.approx((0.5 + 0.3) / 2)


def test_the_metric_decides_the_best_key_and_unknown_ones_are_refused(spark):
    scores = spark.createDataFrame([("a", 0.9), ("b", 0.4)], "k string, v double")
    best = {m: pf.best_key(scores.withColumnRenamed("v", m), pf.ForestConfig(task=t, metric=m)).first()["k"]
            for t, m in (("clf", "auc"), ("clf", "accuracy"), ("clf", "log_loss"), ("reg", "mse"), ("reg", "mae"), ("multi", "accuracy"))}
    assert best == {"auc": "a", "accuracy": "a", "log_loss": "b", "mse": "b", "mae": "b"}
    with pytest.raises(ValueError, match="metric"):
        pf.metric_of(pf.ForestConfig(task="reg", metric="auc"))


@pytest.mark.parametrize("metric", [None, "log_loss"])
def test_three_classes_from_fit_to_a_loaded_copy(spark, tmp_path, metric):
    rnd = random.Random(2)
    rows = []
    for i in range(400):
        a = rnd.random()
        rows.append((f"r{i}", a, rnd.choice("uv"), "low" if a < 0.3 else "mid" if a < 0.6 else "high"))
    rows += [("null", None, "u", "mid"), ("other", 0.5, "u", None)]
    df = spark.createDataFrame(rows, "name string, a double, c string, kind string")
    cfg = pf.ForestConfig(grid={"max_depth": [1, 3]}, n_trees=3, max_rows=None, max_p=0.9, min_cols=2, task="multi", metric=metric)
    model = pf.fit(df, ["a"], "kind", cfg, ["c"])
    counts = Counter(kind for *_, kind in rows if kind)
    assert model.classes == sorted(counts, key=lambda c: (-counts[c], c)) and model.cfg.n_classes == 3
    scores = {r[0]: r[1] for r in model.evaluate(df).collect()}
    assert model.best == "max_depth=3" and (metric or scores["max_depth=3"] > 0.95)
    out = {r.name: r for r in model.predict(df).collect()}
    right = sum(out[n].prediction == kind for n, _, _, kind in rows if n not in ("null", "other"))
    assert right > 380 and out["null"].prediction is None and out["other"].prediction == "mid"
    assert all(abs(sum(r.probability) - 1) < 1e-6 for r in out.values() if r.probability)
    loaded = pf.ForestModel.load(spark, model.save(f"file://{tmp_path}/m"))
    assert {r.name: r for r in loaded.predict(df).collect()} == out
