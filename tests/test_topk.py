"""Pruned top-k against plain counts: ties, few words, several tables, and what is shuffled."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from sylvan.operators import topk
from sylvan.operators import text as tops
from sylvan.sources import scan_lines
from tests.conftest import SF_SMALL


def plain(words, k):
    counts = Counter(w for w in words if w is not None)
    ranked = sorted(counts.values(), reverse=True)
    least = ranked[min(k, len(ranked)) - 1] if ranked else 0
    return {w: n for w, n in counts.items() if n >= least}


@pytest.mark.parametrize("k", [1, 3, 10])
@pytest.mark.parametrize("table_words,broadcast", [(4, 0), (500, 1000)])
def test_equal_to_counting_everything(spark, k, table_words, broadcast):
    rnd = random.Random(k)
    for size in (0, 2, 400):
        words = [rnd.choice([None, "", *[f"w{int(rnd.expovariate(0.2))}" for _ in range(3)]]) for _ in range(size)]
        df = spark.createDataFrame([(w,) for w in words], "w string").repartition(3)
        got = topk.pruned_rounds(df, k, table_words=table_words, broadcast_words=broadcast).result.collect()
        assert {r.w: r.n for r in got} == plain(words, k)


def test_words_spread_evenly_over_tables_are_found(spark):
    """No word is frequent in any one table; the most frequent overall is everywhere."""
    rows = [(p, w) for p in range(8) for w in ["everywhere"] * 5 + [f"only{p}"] * 7 + [f"rare{p}-{i}" for i in range(50)]]
    df = spark.createDataFrame(rows, "p int, w string").repartitionByRange(8, "p").select("w")
    rounds = topk.pruned_rounds(df, 1)
    assert [tuple(r) for r in rounds.result.collect()] == [("everywhere", 40)]
    ties = {r.w: r.n for r in topk.pruned_rounds(df, 2).result.collect()}
    assert ties == {"everywhere": 40, **{f"only{p}": 7 for p in range(8)}}


def test_the_tail_of_the_documents_is_not_shuffled(spark):
    words = tops.split_words(scan_lines(spark, SF_SMALL)).repartition(6)
    rounds = topk.pruned_rounds(words, 10)
    assert rounds.shuffled * 10 <= rounds.rows and rounds.candidates * 10 <= rounds.rows
    assert rounds.result.count() >= 10


def test_words_are_counted_in_chunks(spark):
    """A task adds up its chunks, and its tables hold each word once."""
    rows = [(w,) for i in range(3000) for w in (f"w{i % 7}", f"x{i % 900}", None)]
    df = spark.createDataFrame(rows, "w string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        tables = topk.local_counts(df, 7, "w", 100_000, chunk_words=1000).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.w: r.n for r in tables} == Counter(w for w, in rows if w) and len(tables) == 907
    assert sorted(r.w for r in tables if r.top) == [f"w{i}" for i in range(7)]
