"""Every registered query against its DuckDB oracle (exact) or, without one, a row-count check."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from sylvan.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


def test_every_query_is_registered_with_a_name_in_oracles_or_rows_only():
    rows_only = sorted(set(QUERIES) - set(ORACLES))
    assert rows_only == ["forest_fit_clf", "forest_fit_reg", "grid_select_deep"]
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, name, QUERIES[name], ORACLES.get(name), SF_SMALL)
    if name in ORACLES:
        assert res["status"] == "match", res
    else:
        assert res["spark_rows"] > 0, res


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 10
    assert df.columns == ["w", "n"]
