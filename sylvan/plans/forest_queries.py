"""Registered forest queries and their oracle SQL; every query fits its own forest."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sylvan.functions import params as P
from sylvan.operators import features as feat
from sylvan.operators import forest as fo
from sylvan.operators import gaps
from sylvan.operators import metrics as me
from sylvan.operators import mllib_forest
from sylvan.plans import forest as pf
from sylvan.plans.basic import lineitem_rid
from sylvan.plans.oracle_forest import forest_sql
from sylvan.session import scratch_path
from sylvan.sources import read_table

CLF = pf.ForestConfig()
REG = pf.ForestConfig(task="reg", max_rows=None)
FEW = pf.ForestConfig(max_p=0.1, max_rows=2_000, draws="gaps")
MULTI = pf.ForestConfig(task="multi", n_classes=3)
# The grid of the workload: 4 points x 100 trees, depth 5 and 10, up to 500,000 rows a tree.
DEEP = pf.ForestConfig(grid={"min_samples_leaf": [20, 200], "max_depth": [5, 10]}, n_trees=100, max_rows=500_000, max_bins=64)

def _fit(spark: SparkSession, sf_dir: str, cfg: pf.ForestConfig) -> pf.GridResult:
    return pf.run_grid(spark, sf_dir, cfg)


def _nodes(spark: SparkSession, sf_dir: str, cfg: pf.ForestConfig):
    return pf.fit_forest(pf.feature_rows(spark, sf_dir, cfg)[0], cfg)


def string_index(spark, sf_dir):
    rows = pf.labelled_rows(spark, sf_dir, CLF).filter("is_train")
    return feat.string_index_table(rows, "l_linestatus")


def assemble_features(spark, sf_dir):
    rows = pf.labelled_rows(spark, sf_dir, CLF).dropna(subset=pf.NUMERIC)
    return feat.assemble(rows, pf.NUMERIC).select("rid", "features")


def feature_pipeline(spark, sf_dir):
    rows = pf.mllib_feature_rows(spark, sf_dir, CLF)
    return rows.select("rid", F.col("x").alias("features"), "y", "is_train")


def sampling_rate(spark, sf_dir):
    train = pf.labelled_rows(spark, sf_dir, CLF).filter("is_train")
    n = F.count(F.lit(1))
    return train.agg(n.alias("n_train"), P.sampling_rate_col(n, CLF.max_p, CLF.max_rows).alias("p"))


def _sampled(spark, sf_dir):
    return pf.sample_for_trees(pf.feature_rows(spark, sf_dir, CLF)[0], CLF)


def tree_sample(spark, sf_dir):
    return _sampled(spark, sf_dir).select("k", "tree", "rid")


def tree_sample_gaps(spark, sf_dir):
    """The rows that each tree draws when it jumps from drawn row to drawn row; shares are small for a large table."""
    train = pf.usable(pf.feature_rows(spark, sf_dir, FEW)[0]).select("rid")
    p = P.sampling_rate(train.count(), FEW.max_p, FEW.max_rows)
    return gaps.gap_sample(train, pf.grid_trees(FEW), p, FEW.seed).select("k", "tree", "rid")


def param_key_parse(spark, sf_dir):
    s = _sampled(spark, sf_dir)
    full = F.concat(F.col("k"), F.lit(f",{P.TREE_PARAM}="), F.col("tree").cast("string"))
    parsed = P.parse_key(full)
    rows = s.select(parsed["k"], parsed["min_samples_leaf"], parsed["max_depth"], parsed["tree"])
    return rows.groupBy("k", "min_samples_leaf", "max_depth", "tree").agg(F.count(F.lit(1)).alias("n_rows"))


def split_histogram(spark, sf_dir):
    s = _sampled(spark, sf_dir).withColumn("node", F.lit(1))
    return fo.histogram(s).select("k", "tree", "f", "v", "n", "s")


STUMP_COLS = ["k", "tree", "node", "f", "thr", "n", "s"]


def best_split(spark, sf_dir):
    nodes = _nodes(spark, sf_dir, CLF)
    return nodes.filter((F.col("depth") == 0) & ~F.col("is_leaf")).select(*STUMP_COLS)


def grow_tree(spark, sf_dir):
    return _nodes(spark, sf_dir, CLF)


def forest_by_key(spark, sf_dir):
    nodes = _nodes(spark, sf_dir, CLF)
    roots = nodes.filter(F.col("node") == 1)
    per_k = nodes.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.sum(F.col("is_leaf").cast("int")).alias("n_leaves"))
    trees = roots.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_trees"),
        F.concat_ws(",", F.sort_array(F.collect_list("tree")).cast("array<string>")).alias("trees"))
    return trees.join(per_k, "k")


def score_all_models(spark, sf_dir):
    train, test = pf.feature_rows(spark, sf_dir, CLF)
    nodes = pf.fit_forest(train, CLF)
    return fo.route_to_leaves(test, nodes).select("rid", "k", "tree", "node", "vote")


def forest_vote(spark, sf_dir):
    return _fit(spark, sf_dir, CLF).votes.select("rid", "k", "score", "n_trees", "prob", "prediction")


def auc_by_key(spark, sf_dir):
    return _fit(spark, sf_dir, CLF).scores


def auc_swapped_by_key(spark, sf_dir):
    return me.auc_swapped_by_key(_fit(spark, sf_dir, CLF).votes)


def select_best(spark, sf_dir):
    return _fit(spark, sf_dir, CLF).best


def grid_select_clf(spark, sf_dir):
    preds = pf.best_predictions(_fit(spark, sf_dir, CLF), "clf")
    return preds.select("rid", "k", F.col("x").alias("features"), "y", "prediction", "probability")


def grid_select_deep(spark, sf_dir):
    """Predictions of the best forest of the workload's whole grid."""
    preds = pf.best_predictions(_fit(spark, sf_dir, DEEP), "clf")
    return preds.select("rid", "k", "y", "prediction", "probability")


def _fitted_model(spark, sf_dir, cfg=CLF, label="y"):
    """Forest model of the lineitem training rows, evaluated on the test rows; and these rows."""
    rows = pf.lineitem_rows(read_table(spark, sf_dir, "lineitem"), cfg)
    model = pf.fit(rows.filter("is_train"), pf.NUMERIC, label, cfg, pf.TO_INDEX, row_id="rid")
    test = rows.filter("not is_train")
    model.evaluate(test)
    return model, test


def forest_vote_multi(spark, sf_dir):
    """Class vectors of every grid key's forest for the three values of ``l_returnflag``, and the likeliest."""
    model, test = _fitted_model(spark, sf_dir, MULTI, "l_returnflag")
    votes = pf.scored(model._x(test).select("rid", "x"), model.nodes, model.cfg)
    value = F.get(F.array(*[F.lit(c) for c in model.classes]), F.col("prediction").cast("int"))
    return votes.filter("scores is not null").select("rid", "k", "n_trees", "probability", value.alias("prediction"))


def accuracy_multi(spark, sf_dir):
    """Accuracy of every grid key's forest over three classes."""
    model, test = _fitted_model(spark, sf_dir, MULTI, "l_returnflag")
    return model.evaluate(test)


def append_prediction(spark, sf_dir):
    """All lineitem columns of the test rows, plus prediction and probability of the best forest."""
    model, _ = _fitted_model(spark, sf_dir)
    li = lineitem_rid(read_table(spark, sf_dir, "lineitem"))
    return model.predict(li.filter(~pf.is_train_col(F.col("rid"), CLF)))


def mse_by_key(spark, sf_dir):
    return _fit(spark, sf_dir, REG).scores


def grid_select_reg(spark, sf_dir):
    res = _fit(spark, sf_dir, REG)
    preds = pf.best_predictions(res, "reg")
    return preds.select("rid", "k", (F.col("y") / F.lit(100.0)).alias("y"), "prediction")


def model_roundtrip(spark, sf_dir):
    """Predictions of a model that was saved and loaded again."""
    model, test = _fitted_model(spark, sf_dir)
    loaded = pf.ForestModel.load(spark, model.save(scratch_path(spark, "forest-model")))
    return loaded.predict(test.select("rid", *pf.NUMERIC, *pf.TO_INDEX)).select("rid", "prediction", "probability")


def forest_fit_clf(spark, sf_dir):
    train, test = pf.feature_rows(spark, sf_dir, CLF)
    return mllib_forest.fit_and_predict(pf.usable(train), pf.usable(test), CLF)


def forest_fit_reg(spark, sf_dir):
    train, test = pf.feature_rows(spark, sf_dir, REG)
    return mllib_forest.fit_and_predict(pf.usable(train), pf.usable(test), REG)


def forest_queries() -> dict:
    return {
        "string_index": string_index,
        "assemble_features": assemble_features,
        "feature_pipeline": feature_pipeline,
        "sampling_rate": sampling_rate,
        "tree_sample": tree_sample,
        "tree_sample_gaps": tree_sample_gaps,
        "param_key_parse": param_key_parse,
        "split_histogram": split_histogram,
        "best_split": best_split,
        "grow_tree": grow_tree,
        "forest_by_key": forest_by_key,
        "score_all_models": score_all_models,
        "forest_vote": forest_vote,
        "auc_by_key": auc_by_key,
        "auc_swapped_by_key": auc_swapped_by_key,
        "select_best": select_best,
        "grid_select_clf": grid_select_clf,
        "grid_select_deep": grid_select_deep,
        "forest_vote_multi": forest_vote_multi,
        "accuracy_multi": accuracy_multi,
        "append_prediction": append_prediction,
        "mse_by_key": mse_by_key,
        "grid_select_reg": grid_select_reg,
        "model_roundtrip": model_roundtrip,
        "forest_fit_clf": forest_fit_clf,
        "forest_fit_reg": forest_fit_reg,
    }


def forest_oracles() -> dict:
    stump = "SELECT k, tree, node, f, thr, n, s FROM nodes WHERE depth = 0 AND NOT is_leaf"
    prob_arr = "[1.0::DOUBLE - prob, prob] AS probability"
    return {
        "string_index": forest_sql(CLF, "SELECT s4 AS value, x4 AS idx FROM sidx", scoring=False),
        "assemble_features": forest_sql(CLF, "SELECT rid, [x0, x1, x2, x3] AS features FROM base", scoring=False),
        "feature_pipeline": forest_sql(CLF, "SELECT rid, [x0, x1, x2, x3, x4] AS features, y, is_train FROM feat",
                                       scoring=False),
        "sampling_rate": forest_sql(CLF, "SELECT n_train, p FROM prate", scoring=False),
        "tree_sample": forest_sql(CLF, "SELECT k, tree, rid FROM sampled", scoring=False),
        "tree_sample_gaps": forest_sql(FEW, "SELECT k, tree, rid FROM gap_sampled", scoring=False, growth=False,
                                       more=gaps.gap_sql("train", "gt", "(SELECT p FROM prate)", FEW.seed)),
        "param_key_parse": forest_sql(
            CLF, "SELECT k, min_leaf AS min_samples_leaf, max_depth, tree, count(*) AS n_rows "
                 "FROM sampled GROUP BY k, min_leaf, max_depth, tree", scoring=False),
        "split_histogram": forest_sql(CLF, "SELECT k, tree, f, v, n, s FROM h0", scoring=False),
        "best_split": forest_sql(CLF, stump, scoring=False),
        "model_roundtrip": forest_sql(CLF, f"SELECT s.rid, s.prediction, {prob_arr} FROM scored s JOIN best USING (k)"),
        "grow_tree": forest_sql(CLF, "SELECT * FROM nodes", scoring=False),
        "forest_by_key": forest_sql(CLF, """SELECT r.k, r.n_trees, r.trees, a.n_nodes, a.n_leaves FROM
  (SELECT k, count(*) AS n_trees, string_agg(CAST(tree AS VARCHAR), ',' ORDER BY tree) AS trees
   FROM nodes WHERE node = 1 GROUP BY k) r
  JOIN (SELECT k, count(*) AS n_nodes, CAST(sum(CAST(is_leaf AS INTEGER)) AS BIGINT) AS n_leaves
        FROM nodes GROUP BY k) a ON a.k = r.k""", scoring=False),
        "score_all_models": forest_sql(CLF, "SELECT rid, k, tree, node, vote FROM leafs"),
        "forest_vote": forest_sql(CLF, "SELECT rid, k, score, n_trees, prob, prediction FROM scored"),
        "auc_by_key": forest_sql(CLF, "SELECT k, auc FROM auc"),
        "auc_swapped_by_key": forest_sql(CLF, """SELECT k,
  CASE WHEN a + b > 0 AND c + d > 0 THEN (2.0::DOUBLE * a * d + a * c + b * d) / (2.0::DOUBLE * (a + b) * (c + d)) END
    AS auc_swapped
FROM (SELECT k,
  CAST(sum(prediction * y) AS DOUBLE) AS a, CAST(sum(prediction * (1 - y)) AS DOUBLE) AS b,
  CAST(sum((1 - prediction) * y) AS DOUBLE) AS c, CAST(sum((1 - prediction) * (1 - y)) AS DOUBLE) AS d
  FROM scored GROUP BY k)"""),
        "select_best": forest_sql(CLF, "SELECT k, auc FROM best"),
        "grid_select_clf": forest_sql(
            CLF, f"SELECT s.rid, s.k, [t.x0, t.x1, t.x2, t.x3, t.x4] AS features, s.y, s.prediction, {prob_arr} "
                 "FROM scored s JOIN best USING (k) JOIN test t ON t.rid = s.rid"),
        "append_prediction": forest_sql(
            CLF, f"""SELECT l.*, {RID_EXPR} AS rid, s.prediction, {prob_arr}
FROM lineitem l JOIN (SELECT scored.* FROM scored JOIN best USING (k)) s ON s.rid = {RID_EXPR}"""),
        "forest_vote_multi": forest_sql(
            MULTI, "SELECT s.rid, s.k, s.n_trees, s.probability, c.flag AS prediction "
                   "FROM scored s JOIN cls c ON c.number = s.number"),
        "accuracy_multi": forest_sql(MULTI, "SELECT k, accuracy FROM accuracy"),
        "mse_by_key": forest_sql(REG, "SELECT k, mse FROM mse"),
        "grid_select_reg": forest_sql(
            REG, f"SELECT v.rid, v.k, v.y / 100.0::DOUBLE AS y, "
                 f"CAST(v.score AS DOUBLE) / (CAST(v.n_trees AS DOUBLE) * 1000.0::DOUBLE * 100.0::DOUBLE) AS prediction "
                 "FROM votes v JOIN best USING (k)"),
    }


RID_EXPR = "concat_ws('-', l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber)"
