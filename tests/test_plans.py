"""Plan checks: no Python evaluation in any registered query; scans pruned; top-k not ranked globally."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sylvan.operators import forest as fo
from sylvan.operators import growth
from sylvan.operators import sampling as sa
from sylvan.plans import forest as pf
from sylvan.plans import registry
from sylvan.plans.forest_queries import forest_queries
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
# Forest queries return rows of tables they wrote; the plans before writing are checked below.
NAMES = sorted(set(registry.queries()) - set(forest_queries()))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_python_in_plan(spark, name):
    plan = _plan(registry.queries()[name](spark, SF_SMALL))
    for node in PYTHON_NODES:
        assert node not in plan, (name, node)


def test_flagship_reads_only_needed_columns_and_uses_top_k(spark):
    df = registry.queries()["clean_topk"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "RankLimit" not in plan and "WindowGroupLimit" not in plan
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    schemas = [line for line in formatted.splitlines() if line.startswith("ReadSchema:")]
    assert schemas and all("text:string" in r and "source" not in r and "n_chars" not in r for r in schemas)


def test_word_count_has_partial_aggregation(spark):
    plan = _plan(registry.queries()["word_count"](spark, SF_SMALL))
    assert plan.count("HashAggregate") >= 2


def test_stopword_filter_broadcasts(spark):
    plan = _plan(registry.queries()["clean_tokens"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def _single_partition_children(formatted: str) -> list[str]:
    """For each ``Exchange SinglePartition``, the operator directly below it in the tree."""
    lines = formatted.splitlines()
    ids = set()
    for i, line in enumerate(lines):
        if line.startswith("Arguments: SinglePartition"):
            j = i
            while j > 0 and not lines[j].startswith("("):
                j -= 1
            ids.add(lines[j].split(")")[0] + ")")  # e.g. "(5)"
    children = []
    for i, line in enumerate(lines):
        for node_id in ids:
            if line.rstrip().endswith(f"Exchange {node_id}"):
                children.append(lines[i + 1].strip(" :+-"))
    return children


@pytest.mark.parametrize("name", NAMES)
def test_single_partition_only_after_aggregation(spark, name):
    df = registry.queries()[name](spark, SF_SMALL)
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    for child in _single_partition_children(formatted):
        assert child.startswith(("HashAggregate", "ObjectHashAggregate", "TakeOrderedAndProject",
                                 "GlobalLimit", "LocalLimit")), (name, child)


def test_row_draws_and_split_search_run_no_python_and_aggregate_before_the_shuffle(spark):
    cfg = pf.ForestConfig(n_trees=2)
    rows = pf.labelled_rows(spark, SF_SMALL, cfg)
    train = rows.filter("is_train").withColumn("x", F.array(*[F.col(c) for c in pf.NUMERIC]))
    sampled = pf.sample_for_trees(train, cfg, len(pf.NUMERIC))
    drawn = sa.drawn_trees(train, pf.grid_trees(cfg, len(pf.NUMERIC)), 0.3, "42")
    level = fo.best_splits(fo.histogram(sampled.withColumn("node", F.lit(1))), 0, "clf")
    for df in (sampled, drawn, level):
        assert not any(node in _plan(df) for node in PYTHON_NODES)
    assert "partial_count" in _plan(level) and "ArrayContains" not in _plan(level)
    assert "Exchange" not in _plan(drawn) and "Generate" not in _plan(drawn)


def test_a_level_is_one_scan_with_one_shuffle_of_partial_cells(spark):
    trees = [growth.Tree("k", 1, 1, 3, (0,)), growth.Tree("k", 2, 1, 3, (0,))]
    rows = spark.createDataFrame([([1.0], 1, [0, 1])], "x array<double>, y long, drawn array<int>")
    plan = _plan(growth.level_cells(rows, trees, 1, growth.Splits(trees, 1), 0, None, None, []))
    assert plan.count("Exchange") == 1 and plan.count("MapInArrow") == 1 and "Join" not in plan
    assert "partial_sum" in plan and "Generate" not in plan


def test_scoring_has_no_join_shuffle_or_grouping_of_rows(spark):
    nodes = spark.createDataFrame(
        [("k", 1, 1, 0, 4, 2, 0, 0.5, False, 0), ("k", 1, 2, 1, 2, 0, None, None, True, 0), ("k", 1, 3, 1, 2, 2, None, None, True, 1_000_000_000)],
        "k string, tree int, node int, depth int, n long, s long, f int, thr double, is_leaf boolean, vote long")
    rows = spark.createDataFrame([("a", [0.0]), ("a", [0.0]), ("b", [1.0]), ("c", None)], "rid string, x array<double>")
    votes = fo.clf_outputs(fo.forest_votes(rows, nodes))
    plan = _plan(votes)
    assert "Join" not in plan and "Exchange" not in plan and "Aggregate" not in plan
    got = sorted((r["rid"], r["score"]) for r in votes.collect() if r["rid"] != "c")
    assert got == [("a", 0), ("a", 0), ("b", 1_000_000_000)]
    assert [r["score"] for r in votes.collect() if r["rid"] == "c"] == [None]
