"""Registry of named queries (Spark) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sylvan.operators import aggregate as ag
from sylvan.operators import text as tops
from sylvan.plans import basic, gazetteer, wordcount
from sylvan.plans.forest_queries import forest_oracles, forest_queries
from sylvan.plans.oracle_text import text_oracles
from sylvan.sources import scan_lines

Query = Callable[[SparkSession, str], DataFrame]


def _lines(fn):
    return lambda spark, sf_dir: fn(scan_lines(spark, sf_dir))


def text_queries() -> dict[str, Query]:
    return {
        "scan_lines": lambda spark, sf_dir: scan_lines(spark, sf_dir),
        "split_words": _lines(tops.split_words),
        "lower_text": _lines(tops.lower_lines),
        "strip_dates": _lines(tops.strip_dates),
        "tokenize": _lines(tops.tokenize),
        "entity_removal": _lines(tops.remove_entities),
        "entity_set": _lines(tops.entity_set),
        "stopword_filter": _lines(tops.filtered_tokens),
        "clean_tokens": _lines(tops.clean_tokens),
        "word_count": wordcount.plain_word_counts,
        "topk_values": lambda spark, sf_dir: ag.topk_values(wordcount.plain_word_counts(spark, sf_dir)),
        "topk_words_ties": wordcount.plain_topk,
        "topk_words_pruned": wordcount.pruned_topk,
        "clean_topk_pruned": wordcount.pruned_clean_topk,
        "threshold_filter": basic.threshold_filter,
        "clean_topk": wordcount.clean_topk,
    }


def basic_queries() -> dict[str, Query]:
    return {
        "csv_scan": basic.csv_scan,
        "csv_quarantine": basic.csv_quarantine,
        "head_n": basic.head_n,
        "row_as_map": basic.row_as_map,
        "keep_columns": basic.keep_columns,
        "indicator": basic.indicator,
        "indicator_ratio": basic.indicator_ratio,
        "row_count": basic.row_count,
        "mean_by_key": basic.mean_by_key,
    }


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(text_queries())
    out.update(gazetteer.QUERIES)
    out.update(basic_queries())
    out.update(forest_queries())
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(text_oracles())
    out.update(gazetteer.ORACLES)
    out.update(basic.basic_oracles())
    out.update(forest_oracles())
    return out
