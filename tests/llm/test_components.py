"""Connected components against union-find."""

from __future__ import annotations

import random

import pytest

from sylvan.llm.components import connected_components


def brute(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("edges", [
    [(5, 1), (5, 2)],
    [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7)],
    [(9, 8), (8, 9), (7, 7), (3, 9)],
    [(random.Random(s).randrange(60), random.Random(s + 1000).randrange(60)) for s in range(45)],
])
def test_labels_are_the_smallest_member(spark, edges):
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute([e for e in edges if e[0] != e[1]])
    assert got == want


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
