"""Scaled forest fitting with MLlib, one distributed fit per grid key.

``RandomForestRegressor`` is used for both tasks: on a 0/1 label its
variance split orders candidates as Gini does and its leaf mean is P(1),
while MLlib's classifier merges sibling leaves of the same class and so
loses soft votes.  Rows per tree are drawn without replacement
(``bootstrap=False``, ``subsamplingRate=p``).  Feature sampling differs from
the histogram forest: MLlib draws a feature subset per node
(``featureSubsetStrategy``), not one mask per tree; this path is the
approximation for very large grids, the histogram forest is the definition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.functions import params as P
from sylvan.session import materialize

MAX_BINS = 64


def fit_and_predict(train: DataFrame, test: DataFrame, cfg) -> DataFrame:
    """``(rid, k, prediction)`` on the test rows for every grid key."""
    # Written once: every grid key's fit reads the training rows.
    train = materialize(train.select("x", "y"), "mllib-rows")
    p = P.sampling_rate(train.count(), cfg.max_p, cfg.max_rows)
    tr = train.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"))
    # The test rows too: every key's predictions read them, and they are few of the rows that they are picked from.
    test = materialize(test.select("rid", "x"), "mllib-test")
    te = test.select("rid", array_to_vector("x").alias("features"))
    outs = []
    for key, params in P.grid_points(cfg.grid):
        rf = RandomForestRegressor(
            featuresCol="features", labelCol="label", numTrees=cfg.n_trees,
            maxDepth=params["max_depth"], minInstancesPerNode=params["min_samples_leaf"],
            subsamplingRate=p, bootstrap=False, featureSubsetStrategy=str(cfg.col_p),
            maxBins=MAX_BINS, seed=int(cfg.seed))
        model = rf.fit(tr)
        pred = model.transform(te).select("rid", F.lit(key).alias("k"), "prediction")
        outs.append(pred)
    return reduce(DataFrame.unionByName, outs)
