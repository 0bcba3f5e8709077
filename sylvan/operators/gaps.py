"""Row draws by gaps: each tree jumps from one drawn row to the next.

Rows get a stable place: a hash of the row id deals them over blocks of about
``BLOCK_ROWS``, and inside a block they stand in the order of their ids.  For each (tree,
block) the number of rows skipped before the next drawn one is geometric, from a keyed
hash of (tree, block, number of the draw), so reruns and other engines draw the same
rows.  The work is one hash per *drawn* (row, tree) and one per row for its place; the
test of every row against every tree, which :mod:`sylvan.operators.sampling` makes, is
dear when the share is small.

A (tree, block) first gets as many gaps as it almost surely needs.  Where these end
inside the block it gets as many as the block has rows, which always reach the end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from sylvan.functions.hashing import hash_key, sql_uniform, uniform, uniform_of
from sylvan.operators.growth import Tree
from sylvan.session import materialize
from sylvan.sources.tables import local_rows

#: Rows of a block, about.
BLOCK_ROWS = 10_000
#: Gaps beyond the expected number, in standard deviations and at least.
SPARE_DEVIATIONS, SPARE_GAPS = 6, 10


def block_count(n_rows: int, block_rows: int = BLOCK_ROWS) -> int:
    return max(1, -(-n_rows // block_rows))


def placed(rows: DataFrame, blocks: int, seed: str) -> DataFrame:
    """``rows`` (with ``rid``) with ``_block`` and ``_place``; equal ids stand side by side in any order."""
    block = F.floor(uniform("block", seed, F.col("rid")) * F.lit(float(blocks))).cast("int")
    at = Window.partitionBy("_block").orderBy("rid")
    return rows.withColumn("_block", block).withColumn("_place", F.row_number().over(at) - 1)


def _gap(u: Column, p: float) -> Column:
    """Rows skipped before the next drawn one: geometric with success probability ``p``."""
    if p >= 1.0:
        return F.lit(0).cast("long")
    return F.floor(F.log(F.lit(1.0) - u) / F.lit(math.log(1.0 - p))).cast("long")


def _drawn(wanted: DataFrame, steps: Column, p: float, seed: str) -> DataFrame:
    """``wanted`` (``t, k, tree, _block, size``) with ``_place`` of each of its first ``steps`` draws, and the last one's."""
    each = wanted.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), steps - 1)))
    u = uniform_of(hash_key("gap", seed, F.col("k"), F.col("tree"), F.col("_block"), F.col("i")))
    whole = Window.partitionBy("t", "_block")
    place = F.sum(_gap(u, p) + 1).over(whole.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1
    return each.withColumn("_place", place).withColumn("_last", F.max("_place").over(whole)).drop("i")


TREE_SCHEMA = T.StructType([T.StructField("t", T.IntegerType()), T.StructField("k", T.StringType()), T.StructField("tree", T.IntegerType())])


def gap_draws(sizes: DataFrame, trees: list[Tree], p: float, seed: str) -> DataFrame:
    """``(t, k, tree, _block, _place)`` of all draws in blocks of the given ``(_block, size)``."""
    if not 0.0 < p <= 1.0:
        raise ValueError("the share must be above 0 and at most 1")
    table = local_rows(sizes.sparkSession, [(i, t.k, t.tree) for i, t in enumerate(trees)], TREE_SCHEMA)
    wanted = sizes.crossJoin(F.broadcast(table))  # trees are a size of the configuration
    size = F.col("size").cast("double")
    spare = F.lit(float(SPARE_DEVIATIONS)) * F.sqrt(size * F.lit(p * (1.0 - p))) + F.lit(float(SPARE_GAPS))
    first = materialize(_drawn(wanted, F.least(F.col("size"), F.ceil(size * F.lit(p) + spare).cast("long")), p, seed), "draws")
    ended_early = F.col("_last") < F.col("size") - 1
    again = first.filter(ended_early).select(*wanted.columns).distinct()
    draws = first.filter(~ended_early).unionByName(_drawn(again, F.col("size"), p, seed))
    return draws.filter(F.col("_place") < F.col("size")).select("t", "k", "tree", "_block", "_place")


def _rows_and_draws(rows: DataFrame, trees: list[Tree], p: float, seed: str, block_rows: int) -> tuple[DataFrame, DataFrame]:
    at = placed(rows, block_count(rows.count(), block_rows), seed)
    sizes = at.groupBy("_block").agg(F.count(F.lit(1)).alias("size"))
    return at, gap_draws(sizes, trees, p, seed)


def gap_sample(rows: DataFrame, trees: list[Tree], p: float, seed: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each row (with ``rid``) with every ``k, tree`` that draws it, with probability ``p``.

    An empty table gives no rows.  Rows with one id are drawn apart; which of them is which is open.
    """
    at, draws = _rows_and_draws(rows, trees, p, seed, block_rows)
    return at.join(draws, ["_block", "_place"]).select(*rows.columns, "k", "tree")


def gap_drawn_trees(rows: DataFrame, trees: list[Tree], p: float, seed: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``drawn``, the numbers of the trees that draw the row; rows that none draws are dropped."""
    at, draws = _rows_and_draws(rows, trees, p, seed, block_rows)
    per_row = draws.groupBy("_block", "_place").agg(F.sort_array(F.collect_list("t")).alias("drawn"))  # one entry a tree at most
    return at.join(per_row, ["_block", "_place"]).select(*rows.columns, "drawn")


def gap_sql(train: str, trees: str, p: str, seed: str, block_rows: int = BLOCK_ROWS) -> list[str]:
    """DuckDB CTEs of :func:`gap_sample` over ``train(rid)`` and ``trees(k, tree)``: ``gap_sampled(k, tree, rid)``; ``p`` below 1."""
    u = sql_uniform("gap", seed, "k", "tree", "block", "i")
    return [
        f"gap_blocks AS (SELECT greatest(1, (count(*) + {block_rows - 1}) // {block_rows}) AS blocks FROM {train})",
        f"""gap_dealt AS (SELECT rid, CAST(floor({sql_uniform('block', seed, 'rid')} * CAST(blocks AS DOUBLE)) AS INTEGER) AS block
  FROM {train}, gap_blocks)""",
        "gap_rows AS (SELECT rid, block, row_number() OVER (PARTITION BY block ORDER BY rid) - 1 AS place FROM gap_dealt)",
        "gap_sizes AS (SELECT block, count(*) AS size FROM gap_rows GROUP BY block)",
        f"gap_steps AS (SELECT k, tree, block, size, unnest(range(size)) AS i FROM gap_sizes, {trees})",
        f"""gap_places AS (SELECT k, tree, block, size,
    sum(CAST(floor(ln(1.0::DOUBLE - {u}) / ln(1.0::DOUBLE - p)) AS BIGINT) + 1) OVER (PARTITION BY k, tree, block ORDER BY i) - 1 AS place
  FROM gap_steps, (SELECT {p} AS p))""",
        """gap_sampled AS (SELECT g.k, g.tree, r.rid FROM gap_places g JOIN gap_rows r ON r.block = g.block AND r.place = g.place
  WHERE g.place < g.size)""",
    ]
