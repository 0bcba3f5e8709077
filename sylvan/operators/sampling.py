"""Grid expansion, per-tree row sampling and per-tree feature masks.

Sampling never materialises row copies on the driver: each training row is
paired with the (grid key, tree) blocks of the configuration and keeps the
trees whose keyed hash uniform falls below p.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from sylvan.functions import md5
from sylvan.functions import params as P
from sylvan.functions.hashing import hash_key, uniform, uniform_value
from sylvan.operators.growth import Tree
from sylvan.sources.tables import local_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package


def param_grid(spark: SparkSession, grid: dict) -> DataFrame:
    """``(k, min_samples_leaf, max_depth)``: one row per grid point, from the configuration."""
    schema = T.StructType([T.StructField("k", T.StringType())] + [T.StructField(n, T.IntegerType()) for n in P.ALLOWED_PARAMS])
    return local_rows(spark, [(key, *(point[n] for n in P.ALLOWED_PARAMS)) for key, point in P.grid_points(grid)], schema)


def grid_trees(grid_df: DataFrame, n_trees: int) -> DataFrame:
    """Every (grid key, tree) pair, trees numbered from 1."""
    trees = grid_df.sparkSession.range(1, n_trees + 1).select(F.col("id").cast("int").alias("tree"))
    return grid_df.crossJoin(trees)


def column_mask(trees: DataFrame, n_features: int, col_p: float, min_cols: int, seed: str) -> DataFrame:
    """Add ``mask`` (sorted array of feature indices) to each (k, tree).

    Each feature is kept with probability ``col_p``; when fewer than
    ``min_cols`` are kept, ``min_cols - kept`` indices are drawn without
    replacement from all features (they may repeat kept ones, as the
    definition allows).  ``min_cols`` is clipped to the number of features.
    """
    min_cols = min(min_cols, n_features)
    f = F.explode(F.sequence(F.lit(0), F.lit(n_features - 1))).alias("f")
    per_f = trees.select("k", "tree", f)
    per_f = per_f.withColumn("chosen", uniform("col", seed, F.col("k"), F.col("tree"), F.col("f")) < F.lit(col_p))
    w_tree = Window.partitionBy("k", "tree")
    per_f = per_f.withColumn("n_chosen", F.sum(F.col("chosen").cast("int")).over(w_tree))
    per_f = per_f.withColumn(
        "pick_rank",
        F.row_number().over(w_tree.orderBy(uniform("pick", seed, F.col("k"), F.col("tree"), F.col("f")), "f")),
    )
    keep = F.col("chosen") | (F.col("pick_rank") <= F.lit(min_cols) - F.col("n_chosen"))
    masks = per_f.filter(keep).groupBy("k", "tree").agg(F.sort_array(F.collect_list("f")).alias("mask"))
    return trees.join(masks, ["k", "tree"], "inner")


# One md5 gives four 32-bit uniforms; trees are hashed in blocks of four.
SLICES_PER_HASH = 4


def below_threshold_hex(p: float) -> str | None:
    """8-digit lowercase hex t such that ``int(h, 16) / 2**32 < p`` iff ``h < t``.

    ``None`` when every value passes.  Comparing hex text skips the base
    conversion and the division per (row, tree).
    """
    c = math.ceil(p * 4294967296.0)  # exact: scaling by a power of two
    if c >= 2 ** 32:
        return None
    return format(max(c, 0), "08x")


def tree_blocks(trees: DataFrame) -> DataFrame:
    """``(k, block, members)``: trees of a key grouped four to a hash, with their slice number."""
    t0 = F.col("tree") - F.lit(1)
    blocks = trees.withColumn("block", (t0 / F.lit(SLICES_PER_HASH)).cast("int")).withColumn(
        "slice", (t0 % F.lit(SLICES_PER_HASH)).cast("int"))
    member = F.struct(*[F.col(c) for c in trees.columns if c != "k"], F.col("slice"))
    return blocks.groupBy("k", "block").agg(F.collect_list(member).alias("members"))


def tree_masks(points: list[tuple[str, dict]], n_trees: int, n_features: int, col_p: float, min_cols: int, seed: str) -> list[Tree]:
    """Every tree of the grid with its feature mask: :func:`column_mask` on the driver, for tables of configuration size."""
    min_cols = min(min_cols, n_features)
    out = []
    for k, point in points:
        for tree in range(1, n_trees + 1):
            chosen = [f for f in range(n_features) if uniform_value("col", seed, k, tree, f) < col_p]
            picked = sorted(range(n_features), key=lambda f: (uniform_value("pick", seed, k, tree, f), f))
            mask = sorted({*chosen, *picked[: max(0, min_cols - len(chosen))]})
            out.append(Tree(k, tree, point["min_samples_leaf"], point["max_depth"], tuple(mask)))
    return out


def drawn_trees(rows: DataFrame, trees: list[Tree], p: float, seed: str) -> DataFrame:
    """``rows`` with ``drawn``: the numbers of the trees that draw the row, as :func:`tree_sample` draws; others are dropped.

    One row stays one row.  The hashes are computed once per row, four trees to a hash, in columns
    of their own, and compiled comparisons pick the trees.  For few hashes a row; see :func:`row_draws`.
    """
    th = below_threshold_hex(p)
    blocks: dict[tuple, list[tuple[int, int]]] = {}
    for number, t in enumerate(trees):
        block, piece = divmod(t.tree - 1, SLICES_PER_HASH)
        blocks.setdefault((t.k, block), []).append((number, 8 * piece + 1))
    hashed = rows.withColumns({f"_h{i}": F.md5(hash_key("row", seed, F.col("rid"), F.lit(k), b)) for i, (k, b) in enumerate(blocks)})
    picked = {}
    for i, members in enumerate(blocks.values()):
        for number, at in members:
            drawn = F.lit(True) if th is None else F.substring(f"_h{i}", at, 8) < F.lit(th)
            picked[number] = F.when(drawn, F.lit(number)).otherwise(F.lit(-1))
    drawn = F.array_remove(F.array(*[picked[n] for n in sorted(picked)]), -1)
    # The partition's number, which is never negative, keeps the filter above the column; else the hashes would be worked out for it a second time.
    once = hashed.select(*rows.columns, F.when(F.spark_partition_id() >= 0, drawn).alias("drawn"))
    return once.filter(F.size("drawn") > 0)


def row_draws(trees: list[Tree], p: float, seed: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function of row ids that gives ``(row, tree number)`` of the draws of :func:`drawn_trees`.

    For many hashes a row: ids of one length are hashed together, and what the
    hashes of a row and key have in common is worked out once.
    """
    least = math.ceil(p * 4294967296.0)
    keys: dict[str, dict[int, list[int]]] = {}  # k -> block -> numbers of its trees by slice, -1 for none
    for number, t in enumerate(trees):
        block, piece = divmod(t.tree - 1, SLICES_PER_HASH)
        keys.setdefault(t.k, {}).setdefault(block, [-1] * SLICES_PER_HASH)[piece] = number
    ends: dict[str, list[tuple[list[bytes], np.ndarray]]] = {}  # blocks whose numbers have as many digits
    for k, blocks in keys.items():
        for digits in sorted({len(str(b)) for b in blocks}):
            alike = [b for b in blocks if len(str(b)) == digits]
            ends.setdefault(k, []).append(([str(b).encode() for b in alike], np.array([blocks[b] for b in alike])))
    before = np.frombuffer(f"row|{seed}|".encode(), np.uint8)
    after = {k: np.frombuffer(f"{k}|".encode(), np.uint8) for k in keys}
    together = max(1, md5.TOGETHER // max(len(names) for of_key in ends.values() for names, _ in of_key))

    def draws(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = ids.cast(pa.large_binary())
        at = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset: ids.offset + len(ids) + 1]
        data = np.frombuffer(ids.buffers()[2] or b"", np.uint8)
        # A null id has no place in the hashed text.
        size = np.where(ids.is_valid().to_numpy(zero_copy_only=False), np.diff(at), -1)
        row, tree = [], []
        for length in np.unique(size):
            alike = np.flatnonzero(size == length)
            for a in range(0, len(alike), together):
                part = alike[a: a + together]
                text = data[at[part, None] + np.arange(length)] if length > 0 else np.zeros((len(part), 0), np.uint8)
                text = np.hstack([np.broadcast_to(before, (len(part), len(before))), text, np.full((len(part), int(length >= 0)), ord("|"), np.uint8)])
                for k, of_key in ends.items():
                    begins = np.hstack([text, np.broadcast_to(after[k], (len(part), len(after[k])))])
                    for names, numbers in of_key:
                        for piece, word in enumerate(md5.digests(begins, names)):
                            # The hash's text shows a word's bytes from first to last.
                            end, i = np.nonzero(word.byteswap() < least) if least < 2 ** 32 else np.indices(word.shape).reshape(2, -1)
                            number = numbers[end, piece]
                            row.append(part[i[number >= 0]])
                            tree.append(number[number >= 0])
        return (np.concatenate(row), np.concatenate(tree)) if row else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    return draws


def tree_sample(rows: DataFrame, trees: DataFrame, p: float, seed: str) -> DataFrame:
    """Each row with every (k, tree) that draws it, with probability ``p``.

    The draw for (row, k, tree) is 32-bit slice ``(tree - 1) % 4`` of
    ``md5('row|seed|rid|k|(tree - 1) div 4')``: a keyed hash uniform, so the
    same rows are chosen on every run and in every engine.  The (k, block)
    table is broadcast: its size is that of the configuration, not of the
    data.  Trees that do not draw a row are filtered out before the explode.
    """
    th = below_threshold_hex(p)
    paired = rows.crossJoin(F.broadcast(tree_blocks(trees)))
    paired = paired.withColumn("_h", F.md5(hash_key("row", seed, F.col("rid"), F.col("k"), F.col("block"))))
    members = F.col("members")
    if th is not None:
        members = F.filter(members, lambda m: F.substr(F.col("_h"), m["slice"] * F.lit(8) + F.lit(1), F.lit(8)) < F.lit(th))
    ex = paired.select(*rows.columns, "k", F.explode(members).alias("_m"))
    member_cols = [c for c in trees.columns if c != "k"]
    return ex.select(*rows.columns, "k", *[F.col(f"_m.{c}").alias(c) for c in member_cols])
