"""Every operator and pipeline stage over nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sylvan.llm import language, licenses, lm, mixing, ngramjoin, nndescent, packing, toxicity, urlfilter
from sylvan.llm.common import word_count

ROWS = 15
#: Names that operators use inside; as input columns they must do no harm.
CLASHES = ["host", "path", "rule", "verdict", "size", "target", "copies", "taken", "x", "u", "v", "n", "id", "label", "sig", "words",
           "hits", "rank", "score", "key", "stack", "tox_score", "lid_lang", "lm_score", "start", "length", "offset", "code", "row"]


def clashing(docs):
    for i, name in enumerate(CLASHES):
        docs = docs.withColumn(name, F.lit(f"clash {i}"))
    return docs


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_toxicity(nasty, none, wrap):
    rows = toxicity.score_texts(wrap(nasty), toxicity.Model()).collect()
    assert len(rows) == ROWS and all(0 <= r["tox_score"] <= 1 for r in rows)
    by = {r["doc_id"]: r for r in rows}
    assert by[9]["tox_hits"] == 1 and by[9]["tox_score"] > toxicity.THRESHOLD
    assert by[3]["tox_score"] == by[4]["tox_score"] and by[3]["tox_hits"] == 0
    assert toxicity.score_texts(wrap(none), toxicity.Model()).count() == 0


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_language(nasty, none, wrap):
    rows = language.identify(wrap(nasty)).collect()
    assert len(rows) == ROWS
    by = {r["doc_id"]: r for r in rows}
    assert not by[3]["lid_kept"] and not by[4]["lid_kept"] and not by[5]["lid_kept"]
    assert all(0 < r["lid_posterior"] <= 1 + 1e-9 and r["lid_lang"] in language.LANGUAGES for r in rows)
    assert language.identify(wrap(none)).count() == 0


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_ngram_join(nasty, none, wrap):
    rows = ngramjoin.similar_components(wrap(nasty)).collect()
    assert len(rows) == ROWS
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in rows)
    assert got == sorted([
        (1, 6, 1), (2, 6, 1), (2, 6, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (-1, 7, 1), (-1, 0, -1), (6, 977, 6), (7, 978, 6),
        (8, 1, 8), (9, 2, 9), (10, 1, 10), (11, 1, 10), (12, 11, 12)])
    assert ngramjoin.similar_components(wrap(none)).count() == 0


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_mixing(nasty, none, wrap):
    def sized(docs):
        return wrap(docs).withColumn("size", word_count(F.col("text")))

    rows = mixing.mix(sized(nasty)).collect()
    assert len(rows) == ROWS
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] + 1e-9
        assert r["taken"] == r["copies"] * r["size"]
    again = mixing.mix(sized(nasty).repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.mix(sized(none)).count() == 0


def test_mixing_without_words(spark):
    rows = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert [(r["target"], r["taken"]) for r in mixing.mix(rows).collect()] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_licenses(nasty, none, wrap):
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(wrap(nasty)).collect()}
    assert rows[12]["base_labels"] == "gpl,reserved" and rows[12]["n_base"] == 2
    assert (rows[12]["first_word"], rows[12]["last_word"]) == (7, 12) and rows[12]["labels"] == "gpl,gpl-3,reserved"
    assert (rows[3]["n_words"], rows[3]["n_base"], rows[3]["first_word"], rows[3]["base_labels"], rows[3]["score"]) == (0, 0, None, "", 0.0)
    assert rows[6]["n_words"] == 60_000
    assert licenses.scan_licenses(wrap(none)).count() == 0


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_packing(nasty, none, wrap):
    rows = packing.pack(wrap(nasty), packing.tokenizer_file()).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 3) == 1
    assert {r["doc_tokens"] for r in rows if r["doc_id"] in (4, 5)} == {1}
    assert packing.pack(wrap(none), packing.tokenizer_file()).count() == 0


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_language_model(nasty, none, wrap):
    model = lm.train(nasty.select("text"))
    rows = lm.score_texts(wrap(nasty), model).collect()
    assert len(rows) == ROWS and all(r["lm_known"] == r["lm_tokens"] and r["lm_score"] < 0 for r in rows)
    assert {r["lm_tokens"] for r in rows if r["doc_id"] in (3, 4, 5)} == {1}
    assert lm.score_texts(wrap(none), model).count() == 0
    unread = lm.score_texts(wrap(nasty), lm.train(none.select("text"))).collect()
    assert all(r["lm_known"] == 0 and math.isfinite(r["lm_score"]) for r in unread)


def test_url_filters(spark):
    rows = [(1, "HTTP://A.Example.NET/en/x?y#z"), (2, None), (3, "no scheme"), (4, "http://example.com"), (5, "x://b.example.com/de/"),
            (6, "x://example.comx/de/"), (7, "x://sub.org/fr/a"), (7, "x://sub.org/fr/a"), (None, "x://c.net/"), (8, "x://net?/"), (9, "x:///en/")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string"))
    got = sorted((r["page_id"] or 0, r["host"], r["path"], r["rule"] or "-", r["verdict"]) for r in
                 urlfilter.judge_urls(pages, urlfilter.rules_table(spark)).collect())
    assert got == sorted([
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "", "", "-", "allow"), (3, "", "", "-", "allow"),
        (4, "example.com", "", "-", "allow"), (5, "b.example.com", "/de/", "example.com/de/", "block"), (6, "example.comx", "/de/", "-", "allow"),
        (7, "sub.org", "/fr/a", "org/fr/", "allow"), (7, "sub.org", "/fr/a", "org/fr/", "allow"), (0, "c.net", "/", "net/", "block"),
        (8, "net", "", "-", "allow"), (9, "", "/en/", "-", "allow")])
    assert urlfilter.judge_urls(pages.filter("false"), urlfilter.rules_table(spark)).count() == 0


def test_neighbours(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [None, 1.0]),
            (100, [-1.0, 0.5]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [1e30, 1e30])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).withColumn("rank", F.lit(0))
    got = [tuple(r) for r in nndescent.nearest(vectors, F.col("id") % 50 == 0, 3).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 50), (0, 3, 8), (50, 1, 0), (50, 2, 1), (50, 3, 8), (100, 1, 2), (100, 2, 8), (100, 3, 0)]
    assert got[0][3] == 1.0 and got[2][3] == pytest.approx(0.5 ** 0.5)
    assert nndescent.nearest(vectors.filter("false"), F.col("id") % 50 == 0).count() == 0
    assert nndescent.nearest(vectors.filter("vec_id = 0"), F.col("id") % 50 == 0).count() == 0


def test_neighbours_of_each_vector_length(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0]), (50, [1.0, 0.0, 0.0]), (51, [1.0, 1.0, 0.0]), (100, [3.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r)[:3] for r in nndescent.nearest(vectors, F.col("id") % 50 == 0, 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (50, 1, 51)]


@pytest.mark.parametrize("which", ["full", "empty"])
def test_pipeline_stages(spark, folder, which):
    sf_dir = f"{folder}/{which}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, clashing(docs), sf_dir)
        if name != "packing":
            assert set(out.columns) == set(clashing(docs).columns)
        assert (out.count() > 0) == (which == "full")
    assert corpus_pipeline.run(spark, sf_dir).count() >= (3 if which == "full" else 0)
