"""Word-count plans: the plain count over spaces and the cleaned count (the flagship)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylvan.operators import aggregate as ag
from sylvan.operators import text as tops
from sylvan.operators import topk
from sylvan.sources import scan_lines


def plain_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tops.word_count(tops.split_words(scan_lines(spark, sf_dir)), "w")


def clean_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tops.word_count(tops.clean_tokens(scan_lines(spark, sf_dir)), "token")


def plain_topk(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Words whose count is at least the k-th largest (ties kept)."""
    return ag.topk_with_ties(plain_word_counts(spark, sf_dir), k)


def clean_topk(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Advanced word count: clean, count, keep words at or above the k-th largest count."""
    return ag.topk_with_ties(clean_word_counts(spark, sf_dir), k)


def pruned_topk(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """:func:`plain_topk` in three rounds that leave the tail of the counts unshuffled."""
    return topk.pruned_topk(tops.split_words(scan_lines(spark, sf_dir)), k)


def pruned_clean_topk(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """:func:`clean_topk` in three rounds that leave the tail of the counts unshuffled."""
    return topk.pruned_topk(tops.clean_tokens(scan_lines(spark, sf_dir)), k, "token")
