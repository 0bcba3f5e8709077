"""Queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from sylvan.llm import alignment, bestfit, language, licenses, lm, mixing, ngramjoin, nndescent, packing, search, toxicity, urlfilter, variants

MODULES = [toxicity, search, language, ngramjoin, mixing, urlfilter, licenses, nndescent, packing, lm, bestfit, alignment, variants]


def queries() -> dict:
    out = {"pipeline": corpus_pipeline.run}
    for m in MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in MODULES:
        out.update(m.ORACLES)
    if corpus_pipeline.ORACLE_SQL is not None:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
