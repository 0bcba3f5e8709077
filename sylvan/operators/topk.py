"""Exact top-k words, ties kept, without shuffling the tail of the counts.

Each task counts its words in tables of its own and writes them where they are (no
shuffle).  Three rounds over these then touch few rows (a uniform threshold over
``m`` tables):

1. The sums of every table's own top k give a lower bound ``t`` of the k-th count.
2. A word that reaches ``t`` has ``t / m`` in some table at least: only such rows are
   shuffled.  They bound each word's count from below, and from above by what the
   tables in which it was not seen can still hold; words whose upper bound misses the new
   k-th lower bound are out.
3. The rows of the words that are left are summed, which is exact.

The tail, nearly all rows of a word count, stays in the written tables.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.operators.aggregate import kth_largest, topk_with_ties
from sylvan.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: Different words of one table; a task with more of them writes several tables.
TABLE_WORDS = 500_000
#: Words that a task counts at once.
CHUNK_WORDS = 1_000_000
#: Candidates of the last round up to which they are sent to all tasks; more are joined by a shuffle.
BROADCAST_WORDS = 100_000


def _summed(tables: list[pa.Table]) -> pa.Table:
    """``(w, n)``: the counts of several tables, added up."""
    together = pa.concat_tables(tables).combine_chunks()
    return together.group_by("w", use_threads=False).aggregate([("n", "sum")]).rename_columns(["w", "n"])


def _counted(words: list[pa.Array]) -> pa.Table:
    counts = pa.chunked_array(words, pa.string()).combine_chunks().drop_null().value_counts()
    return pa.table({"w": counts.field("values"), "n": counts.field("counts")})


def local_counts(words: DataFrame, k: int, word_col: str, table_words: int, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``(part, w, n, top)``: words of every task's tables, and whether a word reaches its table's k-th count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 20
        held, size, counts = [], 0, _counted([])

        def table() -> pa.RecordBatch:
            n = counts["n"].combine_chunks()
            least = np.partition(n.to_numpy(), -k)[-k] if len(n) > k else 0
            columns = [pa.array(np.full(len(n), part)), counts["w"].combine_chunks(), n, pc.greater_equal(n, int(least))]
            return pa.RecordBatch.from_arrays(columns, ["part", "w", "n", "top"])

        for batch in batches:
            held.append(batch.column(0).cast(pa.string()))
            size += batch.num_rows
            # Words are counted a chunk at a time, so that frequent ones meet before they are added to the table.
            if size >= min(chunk_words, table_words):
                counts = _summed([counts, _counted(held)])
                held, size = [], 0
                if counts.num_rows >= table_words:
                    yield table()
                    part, counts = part + 1, _counted([])
        if held:
            counts = _summed([counts, _counted(held)])
        if counts.num_rows:
            yield table()

    return words.select(F.col(word_col)).mapInArrow(count, "part long, w string, n long, top boolean")


@dataclass
class Rounds:
    """Rows of the written tables, rows that the second round shuffled, words that it left, and the result."""

    rows: int
    shuffled: int
    candidates: int
    result: DataFrame


def pruned_rounds(words: DataFrame, k: int = 10, word_col: str = "w", table_words: int = TABLE_WORDS,
                  broadcast_words: int = BROADCAST_WORDS) -> Rounds:
    tables = materialize(local_counts(words, k, word_col, table_words), "local-counts")
    size = tables.agg(F.countDistinct("part").alias("parts"), F.count(F.lit(1)).alias("rows")).first()

    def summed(rows: DataFrame, *more):
        return rows.groupBy("w").agg(F.sum("n").alias("n"), *more)

    t1 = kth_largest(summed(tables.filter("top")), k).first()[0] or 0
    least = max(1, -(-t1 // size["parts"])) if size["parts"] else 1
    seen = tables.filter(F.col("n") >= least)
    bounds = materialize(summed(seen, F.count(F.lit(1)).alias("parts")), "count-bounds")
    t2 = kth_largest(bounds, k).first()[0] or 0
    upper = F.col("n") + (F.lit(size["parts"]) - F.col("parts")) * F.lit(least - 1)
    left = bounds.filter(upper >= F.lit(max(t1, t2))).select("w")
    candidates = left.count()
    if candidates <= broadcast_words:
        left = F.broadcast(left)
    exact = summed(tables.join(left, "w", "left_semi"))
    return Rounds(size["rows"], seen.count(), candidates, topk_with_ties(exact, k))


def pruned_topk(words: DataFrame, k: int = 10, word_col: str = "w") -> DataFrame:
    """``(w, n)`` of the words whose count is at least the k-th largest; all words if there are fewer than ``k``.

    Null words are not counted; an empty table gives no rows.
    """
    return pruned_rounds(words, k, word_col).result
