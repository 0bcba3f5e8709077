"""Quantile cut points of features, for forests over features with many distinct values.

Exact histograms have one cell per distinct feature value; with continuous
features at scale that grows with the data.  With ``max_bins`` set, each
feature is cut at approximate quantiles: one quantile sketch per feature, built
per task and merged, whose result is ``features x bins`` numbers.  Rows keep their raw
values; the scan of a level finds bins by binary search in the sorted edges, and a
split after bin ``b`` means ``x <= edges[b]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10_000


def quantile_edges(rows: DataFrame, n_features: int, max_bins: int, x: str = "x",
                   accuracy: int = DEFAULT_ACCURACY) -> list[list[float]]:
    """Sorted distinct cut points per feature (at most ``max_bins - 1`` each)."""
    if max_bins < 2:
        raise ValueError("max_bins must be at least 2")
    qs = [i / max_bins for i in range(1, max_bins)]
    # A row per feature: one sketch each, however many features there are.
    values = rows.select(F.posexplode(x).alias("f", "v"))
    found = values.groupBy("f").agg(F.percentile_approx("v", qs, accuracy).alias("edges")).collect()
    edges = {r["f"]: sorted(set(r["edges"] or [])) for r in found}
    return [edges.get(f, []) for f in range(n_features)]


def bin_index(x: Column, edges: list[float]) -> Column:
    """Number of edges strictly below ``x`` (so ``bin <= b`` iff ``x <= edges[b]``)."""
    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x > F.lit(float(edges[mid])), build(mid + 1, hi)).otherwise(build(lo, mid))
    return build(0, len(edges))
