"""Model scores per grid key: ROC AUC (ties exact), the swapped-argument AUC, MSE, and the best key.

The AUC needs, for every score, the number of negatives with a smaller
score.  Instead of one running sum per key over all distinct scores (a
window that would put a whole key in one task), the distinct (key, score)
rows are cut into ``n_buckets`` buckets at approximate quantiles of the
score, so buckets hold similar numbers of rows even when scores crowd into
a narrow band.  Bucket totals get a running sum over a small table, and the
running sum inside a bucket runs per (key, bucket) in parallel.  Bucketing
only partitions the work; the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from sylvan.operators.binning import bin_index
from sylvan.session import materialize

DEFAULT_BUCKETS = 256


def auc_by_key(df: DataFrame, key: str = "k", score: str = "score", label: str = "y",
               n_buckets: int = DEFAULT_BUCKETS, accuracy: int = 10_000) -> DataFrame:
    """``(key, auc)``: P(score_pos > score_neg) + P(tie) / 2 per key, ties exact."""
    g = df.groupBy(key, score).agg(
        F.sum(F.col(label)).alias("pos"), F.sum(F.lit(1) - F.col(label)).alias("neg"))
    # Written once: read by the quantile pass and by the running sums.
    g = materialize(g, "auc-scores")
    qs = [i / n_buckets for i in range(1, n_buckets)]
    edges = g.agg(F.percentile_approx(F.col(score).cast("double"), qs, accuracy)).first()[0] or []
    g = g.withColumn("_b", bin_index(F.col(score).cast("double"), sorted(set(edges))))
    tot = g.groupBy(key, "_b").agg(F.sum("neg").alias("b_neg"))
    w_b = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(key, "_b", F.coalesce(F.sum("b_neg").over(w_b), F.lit(0)).alias("offset"))
    g = g.join(off, [key, "_b"], "inner")
    w_s = Window.partitionBy(key, "_b").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumn("below", F.col("offset") + F.coalesce(F.sum("neg").over(w_s), F.lit(0)))
    pos, neg, below = (F.col(c).cast("double") for c in ("pos", "neg", "below"))
    num = F.sum(pos * (below + neg / F.lit(2.0)))
    den = F.sum(pos) * F.sum(neg)
    return g.groupBy(key).agg(F.when(den > 0, num / den).alias("auc"))


def auc_swapped_by_key(df: DataFrame, key: str = "k", pred: str = "prediction", label: str = "y") -> DataFrame:
    """AUC with the predicted class as truth and the label as score: ``(PPV + NPV) / 2``.

    Null when a key predicts only one class (the metric is undefined there).
    """
    p = F.col(pred).cast("long")
    y = F.col(label).cast("long")
    one = F.lit(1)
    g = df.groupBy(key).agg(
        F.sum(p * y).alias("a"), F.sum(p * (one - y)).alias("b"),
        F.sum((one - p) * y).alias("c"), F.sum((one - p) * (one - y)).alias("d"))
    a, b, c, d = (F.col(x).cast("double") for x in "abcd")
    val = (F.lit(2.0) * a * d + a * c + b * d) / (F.lit(2.0) * (a + b) * (c + d))
    return g.select(key, F.when(((a + b) > 0) & ((c + d) > 0), val).alias("auc_swapped"))


def mse_by_key(votes: DataFrame, vote_scale: float, unit: float = 100.0, key: str = "k",
               score: str = "score", label: str = "y") -> DataFrame:
    """Mean squared error per key, exact: squared integer residuals summed as decimal(38, 0).

    ``score`` is a sum of ``n_trees`` integer votes of scale ``vote_scale``;
    the label is an integer in the same base unit; the result is in ``unit``
    squared (cents to dollars by default), rounded to 2 places.
    """
    resid = F.col(score) - F.lit(int(vote_scale)) * F.col("n_trees") * F.col(label)
    r = resid.cast("decimal(38,0)")
    g = votes.groupBy(key).agg(
        F.sum(r * r).alias("sse"), F.count(F.lit(1)).alias("n"), F.max("n_trees").alias("t"))
    den = F.col("t").cast("double") ** 2 * F.lit(vote_scale ** 2 * unit ** 2) * F.col("n").cast("double")
    return g.select(key, F.round(F.col("sse").cast("double") / den, 2).alias("mse"))


def mae_by_key(votes: DataFrame, vote_scale: float, unit: float = 100.0, key: str = "k",
               score: str = "score", label: str = "y") -> DataFrame:
    """Mean absolute error per key, exact as :func:`mse_by_key`; in ``unit``, rounded to 4 places."""
    resid = F.abs(F.col(score) - F.lit(int(vote_scale)) * F.col("n_trees") * F.col(label)).cast("decimal(38,0)")
    g = votes.groupBy(key).agg(F.sum(resid).alias("sae"), F.count(F.lit(1)).alias("n"), F.max("n_trees").alias("t"))
    den = F.col("t").cast("double") * F.lit(vote_scale * unit) * F.col("n").cast("double")
    return g.select(key, F.round(F.col("sae").cast("double") / den, 4).alias("mae"))


def accuracy_by_key(df: DataFrame, key: str = "k", pred: str = "prediction", label: str = "y") -> DataFrame:
    """``(key, accuracy)``: share of rows whose predicted class is the label."""
    right = F.sum((F.col(pred) == F.col(label)).cast("long")).cast("double")
    return df.groupBy(key).agg((right / F.count(F.lit(1))).alias("accuracy"))


#: A probability of 0 for the true class counts as this one.
LEAST_PROBABILITY = 1e-9


def log_loss_by_key(df: DataFrame, of_label: Column, key: str = "k") -> DataFrame:
    """``(key, log_loss)``: minus the mean logarithm of the true class's probability ``of_label``, rounded to 6 places."""
    loss = F.avg(-F.log(F.greatest(of_label, F.lit(LEAST_PROBABILITY))))
    return df.groupBy(key).agg(F.round(loss, 6).alias("log_loss"))


def select_best(scores: DataFrame, metric: str, larger_is_better: bool, key: str = "k") -> DataFrame:
    """The one row with the best metric; ties broken by the smaller key."""
    order = F.col(metric).desc_nulls_last() if larger_is_better else F.col(metric).asc_nulls_last()
    return scores.orderBy(order, F.col(key)).limit(1)
