"""Decision forests: histograms, splits, votes.

Training (:mod:`sylvan.operators.growth`) counts, level by level and for all trees of
all grid keys at once, a histogram ``(tree, node, f, v) -> n, sums``.  Running sums over
it give every candidate split; the best split per node is kept.

Split score: maximise ``sl^2/nl + sr^2/nr`` (s = label sum).  For a 0/1
label this orders splits exactly as Gini impurity does; for a numeric label
it is variance reduction; with more than two classes the squares of all class counts
are added, which is Gini again.  Ties: larger score, then smaller feature index,
then smaller threshold.  Threshold = midpoint of adjacent distinct values;
``x <= thr`` goes left.

A node is open (searched for a split) when its depth is below max_depth, it
holds at least ``2 * min_samples_leaf`` rows and, for classification, more than one
class.  Leaf values are stored as integer ``vote = floor(s * scale / n + 0.5)``
so that forest sums are exact in any engine and in any order.  Scoring is
:mod:`sylvan.operators.quickscore`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from sylvan.operators import quickscore

# Task with any number of classes: sums are the counts of each class.
CLASSES = "multi"
# Leaf value scale: nano-probability for classification, milli-cents for regression.
VOTE_SCALE = {"clf": 1_000_000_000.0, "reg": 1000.0, CLASSES: 1_000_000_000.0}


def stat_columns(n_classes: int) -> list[str]:
    """Sum columns of a histogram: the label's sum, or a count for each class."""
    return [f"s{c}" for c in range(n_classes)] if n_classes else ["s"]


def _pure(task: str, n: Column, sums: list[Column]) -> Column:
    if task == "clf":
        return (sums[0] == F.lit(0)) | (sums[0] == n)
    if task == CLASSES:
        return reduce(lambda a, b: a | b, [s == n for s in sums])
    return F.lit(False)


def is_open(task: str, depth, n: Column, sums: list[Column]) -> Column:
    depth = depth if isinstance(depth, Column) else F.lit(depth)
    return (depth < F.col("max_depth")) & (n >= F.lit(2) * F.col("min_leaf")) & ~_pure(task, n, sums)


def histogram(state: DataFrame) -> DataFrame:
    """``(k, tree, node, min_leaf, max_depth, f, v, n, s)`` over masked features."""
    ex = state.select("k", "tree", "node", "min_leaf", "max_depth", "x", "y", F.explode("mask").alias("f"))
    ex = ex.withColumn("v", F.element_at("x", F.col("f") + F.lit(1)))
    return ex.groupBy("k", "tree", "node", "min_leaf", "max_depth", "f", "v").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))


def best_splits(hist: DataFrame, depth: int, task: str,
                keys: list[str] = ("k", "tree"), stats: list[str] = ("s",)) -> DataFrame:
    """One row per node of the histogram: its totals and, if it has one, its best valid split.

    ``keys`` name the tree, ``stats`` the sum columns.  Output ``(*keys, node, nt, f,
    split_v, thr, nl, nr, open_left, open_right)`` and for each sum column its total
    and both sides (``_t``, ``_l``, ``_r``); the split columns are null when the node
    is closed or no split leaves ``min_samples_leaf`` rows on both sides.
    ``split_v`` is the largest histogram value sent left (rows of the node go
    right iff their histogram value is above it); ``thr`` is the midpoint to the
    next value.  Totals
    and the best split come out of the same window pass.
    """
    node = [*keys, "node"]
    w_f = Window.partitionBy(*node, "f")
    w_run = w_f.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Dealt by node, which serves both windows.
    c = hist.repartition(*node).select(
        "*",
        F.sum("n").over(w_run).alias("nl"),
        F.sum("n").over(w_f).alias("nt"),
        *[F.sum(s).over(w).alias(f"{s}_{side}") for s in stats for w, side in ((w_run, "l"), (w_f, "t"))],
        F.lead("v").over(w_f.orderBy("v")).alias("v_next"),
    )
    c = c.withColumns({"nr": F.col("nt") - F.col("nl"), **{f"{s}_r": F.col(f"{s}_t") - F.col(f"{s}_l") for s in stats}})

    def sums(side: str) -> list[Column]:
        return [F.col(f"{s}_{side}") for s in stats]

    def squares(side: str) -> Column:
        return reduce(lambda a, b: a + b, [s.cast("double") * s.cast("double") for s in sums(side)])

    valid = (
        F.col("v_next").isNotNull()
        & (F.col("nl") >= F.col("min_leaf"))
        & (F.col("nr") >= F.col("min_leaf"))
        & is_open(task, depth, F.col("nt"), sums("t"))
    )
    cand = c.select(
        *node, "min_leaf", "max_depth", "nt", "f", "nl", "nr", *sums("l"), *sums("r"), *sums("t"),
        valid.alias("valid"), F.col("v").alias("split_v"),
        F.when(valid, (F.col("v") + F.col("v_next")) / F.lit(2.0)).alias("thr"),
        F.when(valid, squares("l") / F.col("nl") + squares("r") / F.col("nr")).alias("score"),
    )
    w_node = Window.partitionBy(*node).orderBy(
        F.col("valid").desc(), F.col("score").desc(), "f", "thr")
    best = cand.withColumn("rk", F.row_number().over(w_node)).filter(F.col("rk") == 1)

    def when_split(col: Column, name: str) -> Column:
        return F.when(F.col("valid"), col).alias(name)

    split = ["f", "split_v", "thr", "nl", "nr", *[f"{s}_{side}" for s in stats for side in "lr"]]
    return best.select(
        *node, "nt", *sums("t"), *[when_split(F.col(c), c) for c in split],
        when_split(is_open(task, depth + 1, F.col("nl"), sums("l")), "open_left"),
        when_split(is_open(task, depth + 1, F.col("nr"), sums("r")), "open_right"),
    )


def route_to_leaves(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each row with every tree: ``rows`` columns + ``k, tree, node, vote`` of the leaf reached.

    A row with a null feature reaches no leaf: its nodes and votes are null.
    """
    forest = quickscore.packed(nodes)
    if not forest.names:
        return rows.crossJoin(nodes.select("k", "tree", "node", "vote"))  # no tree, no rows
    tree = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).cast("int").alias("tree")) for k, t in forest.names])
    reached = rows.withColumn("_nodes", quickscore.leaf_numbers(forest, rows.sparkSession, F.col("x")))
    each = reached.select(*rows.columns, "_nodes", F.posexplode(tree).alias("_t", "_tree")).select(
        *rows.columns, "_tree.k", "_tree.tree", F.get("_nodes", F.col("_t")).cast("int").alias("node"))
    leaves = nodes.filter("is_leaf").select("k", "tree", "node", "vote")
    return each.join(F.broadcast(leaves), ["k", "tree", "node"], "left").select(*rows.columns, "k", "tree", "node", "vote")


def forest_votes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` columns + ``k, score, n_trees``: sum of leaf votes per row and grid key (null without features).

    For more than two classes ``scores``, an array over the classes, replaces ``score``.
    """
    forest = quickscore.packed(nodes)
    many = "votes" in nodes.columns
    trees = {k: sum(name[0] == k for name in forest.names) for k in forest.keys}
    key = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).cast("long").alias("n_trees")) for k, n in trees.items()])
    if not trees:
        kind = "array<long>" if many else "long"
        none = rows.limit(0).withColumn("k", F.lit(""))
        return none.withColumn("scores" if many else "score", F.lit(None).cast(kind)).withColumn("n_trees", F.lit(0).cast("long"))
    summed = rows.withColumn("_sums", quickscore.vote_sums(forest, rows.sparkSession, F.col("x")))
    each = summed.select(*rows.columns, "_sums", F.posexplode(key).alias("_k", "_key"))
    if many:
        wide = forest.trees[0].votes.shape[1]
        score = F.slice("_sums", F.col("_k") * wide + 1, wide).alias("scores")
    else:
        score = F.get("_sums", F.col("_k")).alias("score")
    return each.select(*rows.columns, "_key.k", score, "_key.n_trees")


def class_outputs(votes: DataFrame) -> DataFrame:
    """Mean class probabilities of the trees, and the number of the likeliest class (ties go to the first)."""
    total = F.col("n_trees").cast("double") * F.lit(VOTE_SCALE[CLASSES])
    probability = F.transform("scores", lambda s: s.cast("double") / total)
    first = (F.array_position("scores", F.array_max("scores")) - 1).cast("double")
    return votes.withColumn("probability", probability).withColumn("prediction", first)


def clf_outputs(votes: DataFrame) -> DataFrame:
    """Probability of class 1 and the predicted class (ties go to class 0)."""
    total = F.col("n_trees").cast("double") * F.lit(VOTE_SCALE["clf"])
    prob = F.col("score").cast("double") / total
    pred = F.when(F.col("score").cast("double") * F.lit(2.0) > total, F.lit(1.0)).otherwise(F.lit(0.0))
    return votes.withColumn("prob", prob).withColumn("prediction", pred)


def reg_outputs(votes: DataFrame, unit: float = 100.0) -> DataFrame:
    """Mean of tree predictions, converted from label units (cents) to ``unit`` per value."""
    total = F.col("n_trees").cast("double") * F.lit(VOTE_SCALE["reg"]) * F.lit(unit)
    return votes.withColumn("prediction", F.col("score").cast("double") / total)
