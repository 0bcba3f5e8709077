"""Aggregations, predicates and top-k.

Top-k with ties never ranks the whole table in one partition: the k-th
largest value comes from ``TakeOrderedAndProject`` (each task keeps k rows,
the merge sees k per task), and the final filter compares every row with
that single value, computed once as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_by_key(df: DataFrame, key: str, value: str, out: str = "mean_value") -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(out))


def indicator(pred: Column) -> Column:
    """A predicate as 0/1 (null counts as 0)."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def indicator_ratio(df: DataFrame, pred: Column, scale: float = 1.0, out: str = "ratio") -> DataFrame:
    """``scale * sum(indicator) / count(*)`` in one pass."""
    return df.agg((F.lit(float(scale)) * F.sum(indicator(pred)) / F.count(F.lit(1))).alias(out))


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def topk_values(counts: DataFrame, k: int = 10, value: str = "n") -> DataFrame:
    """The k largest values, repeats kept."""
    return counts.select(value).orderBy(F.col(value).desc()).limit(k)


def kth_largest(counts: DataFrame, k: int = 10, value: str = "n", out: str = "t") -> DataFrame:
    """One row: the k-th largest value (the smallest of the top k; null on empty input)."""
    return topk_values(counts, k, value).agg(F.min(value).alias(out))


def threshold_filter(df: DataFrame, threshold: DataFrame, value: str, t: str = "t") -> DataFrame:
    """Rows with ``value >= t`` where ``threshold`` is a one-row DataFrame holding ``t``.

    ``t`` is a scalar subquery: evaluated once and shipped to every task as
    a value, with no join.  A null ``t`` (empty input) keeps no rows.
    """
    return df.filter(F.col(value) >= threshold.select(t).scalar())


def topk_with_ties(counts: DataFrame, k: int = 10, value: str = "n") -> DataFrame:
    """All rows whose value is at least the k-th largest (same as ``rank() <= k``)."""
    return threshold_filter(counts, kth_largest(counts, k, value), value)


def head_n(df: DataFrame, n: int, *order_cols: str) -> DataFrame:
    """First n rows in a stated order (top-n sort, no full collect)."""
    return df.orderBy(*order_cols).limit(n)
