"""Parameter keys and the per-tree sampling rate.

A grid point is named by a key string ``min_samples_leaf=20,max_depth=2``; a
tree adds ``,tree_id=3``.  Keys are parsed with ``str_to_map`` and each allowed
parameter is read by name, so map order never matters.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

ALLOWED_PARAMS = {"min_samples_leaf": int, "max_depth": int}
# Value of a parameter that a grid leaves out.
DEFAULT_PARAMS = {"min_samples_leaf": 1, "max_depth": 5}
TREE_PARAM = "tree_id"


def check_grid(grid: dict) -> None:
    unknown = sorted(set(grid) - set(ALLOWED_PARAMS))
    if unknown:
        raise ValueError(f"unknown forest parameters {unknown}; allowed: {sorted(ALLOWED_PARAMS)}")
    if not grid:
        raise ValueError("the grid names no parameter")
    for name, values in grid.items():
        if not values:
            raise ValueError(f"grid parameter {name} has no values")


def grid_points(grid: dict) -> list[tuple[str, dict]]:
    """``(key, {param: value})`` of every combination; the key names the grid's own parameters."""
    check_grid(grid)
    out = []
    for combo in itertools.product(*grid.values()):
        given = {n: ALLOWED_PARAMS[n](v) for n, v in zip(grid, combo)}
        out.append((",".join(f"{n}={v}" for n, v in given.items()), DEFAULT_PARAMS | given))
    return out


def sampling_rate(n_rows: int, max_p: float, max_rows: int | None) -> float:
    """Share of the training rows that a tree takes: ``max_p``, less where ``max_rows`` would be exceeded.

    The share is not rounded, so it stays above 0 for any number of rows (row
    draws have 32 bits).  ``max_rows`` None sets no bound.
    """
    if n_rows <= 0:
        raise ValueError("no training rows")
    return max_p if max_rows is None else min(max_p, float(max_rows) / n_rows)


def sampling_rate_col(n_rows: Column, max_p: float, max_rows: int | None) -> Column:
    """Column form of :func:`sampling_rate`."""
    if max_rows is None:
        return F.lit(float(max_p))
    return F.least(F.lit(float(max_p)), F.lit(float(max_rows)) / n_rows.cast("double"))


def parse_key(key: Column, names=tuple(ALLOWED_PARAMS)) -> dict[str, Column]:
    """Typed parameter columns, the tree id, and the key without the tree id."""
    m = F.str_to_map(key, F.lit(","), F.lit("="))
    out = {n: F.coalesce(m[F.lit(n)].cast("int"), F.lit(DEFAULT_PARAMS[n])).alias(n) for n in names}
    out["tree"] = m[F.lit(TREE_PARAM)].cast("int").alias("tree")
    out["k"] = F.concat_ws(",", *[F.concat(F.lit(f"{n}="), m[F.lit(n)]) for n in names]).alias("k")
    return out
