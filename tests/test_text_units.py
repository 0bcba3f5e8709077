"""Text operators on literal rows: cases the test tables never hit."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from sylvan.functions import text as tx
from sylvan.operators import aggregate as ag
from sylvan.operators import text as tops
from sylvan.sources import lines_of


def _lines(spark, texts, lang="en"):
    docs = spark.createDataFrame([(i, t, lang) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    return lines_of(docs)


def _tokens_of(spark, text):
    df = spark.createDataFrame([(text,)], "line string")
    return df.select(tx.tokens(tx.strip_dates(F.lower("line"))).alias("t")).first()["t"]


def test_split_keeps_empty_words(spark):
    rows = tops.split_words(_lines(spark, ["a  b "])).orderBy("pos").collect()
    assert [r["w"] for r in rows] == ["a", "", "b", ""]


def test_null_text_gives_no_lines(spark):
    docs = spark.createDataFrame([(1, None, "en")], "doc_id long, text string, lang string")
    assert lines_of(docs).count() == 0


def test_lines_drop_newline_and_number_from_zero(spark):
    rows = _lines(spark, ["one\ntwo\n"]).orderBy("line_no").collect()
    assert [(r["line_no"], r["line"]) for r in rows] == [(0, "one"), (1, "two"), (2, "")]


def test_ampersand_pattern_takes_one_char_after_ampersand(spark):
    assert _tokens_of(spark, "a&bc") == ["a&b"]
    assert _tokens_of(spark, "johnson&johnson") == ["johnson&j", "ohnson"]


def test_token_pattern_keeps_unicode_letters_and_apostrophes(spark):
    assert _tokens_of(spark, "Déjà-vu l'été x 42 ab1") == ["déjà", "vu", "l'été", "ab1"]


def test_dates_are_stripped_from_short_lines(spark):
    assert _tokens_of(spark, "Sale (Jan. 2020) today") == ["sale", "today"]
    assert _tokens_of(spark, "Sale (January 2020) today") == ["sale", "today"]


def test_entity_gate_is_strictly_longer_than_70(spark):
    base = "Paris "
    for n, removed in [(69, False), (70, False), (71, True)]:
        line = (base + "x" * n)[:n]
        df = spark.createDataFrame([(line,)], "line string")
        cleaned = df.select(tx.clean_line(F.col("line")).alias("c")).first()["c"]
        assert ("paris" not in cleaned) == removed, (n, cleaned)


def test_entity_rules_and_gazetteer(spark):
    line = "In Paris on 2020-01-02 at 10:30 we paid $40 for 3 kg, 15% off, the 2nd time, 1,000 people "
    assert len(line) > 70
    df = spark.createDataFrame([(line,)], "line string")
    row = df.select(tx.remove_entities(F.col("line")).alias("c"), tx.entity_matches(F.col("line")).alias("e")).first()
    assert row["c"] == "In   on   at   we paid   for  ,   off, the   time,   people "
    assert {tuple(e) for e in row["e"]} == {
        ("PERCENT", "15%"), ("MONEY", "$40"), ("TIME", "10:30"), ("DATE", "2020-01-02"), ("ORDINAL", "2nd"),
        ("QUANTITY", "3 kg"), ("CARDINAL", "1,000"), ("GPE", "Paris")}


def test_entity_removal_keeps_every_line(spark):
    from sylvan.operators import text as tops

    lines = _lines(spark, ["Paris 15%", "Paris " + "x" * 80, ""], lang="en")
    assert [r["line"] for r in tops.remove_entities(lines).orderBy("line_no").collect()] == ["Paris 15%", "  " + "x" * 80, ""]


def test_stop_words_need_no_spark_installation(monkeypatch):
    import pyspark

    monkeypatch.setattr(pyspark, "__file__", "/missing/pyspark/__init__.py")
    tx.stopwords.cache_clear()
    words = tx.stopwords()
    assert {lang for lang, _ in words} == {"en", "fr", "de", "es"} and ("en", "the") in words


def test_stopwords_are_removed_by_language(spark):
    lines = _lines(spark, ["the cat and le chien"], lang="en")
    toks = [r["token"] for r in tops.clean_tokens(lines).collect()]
    assert toks == ["cat", "le", "chien"]
    lines_fr = _lines(spark, ["the cat and le chien"], lang="fr")
    toks_fr = [r["token"] for r in tops.clean_tokens(lines_fr).collect()]
    assert "le" not in toks_fr and "the" in toks_fr


def _counts(spark, pairs):
    return spark.createDataFrame(pairs, "w string, n long")


def test_topk_ties_at_tenth_place_are_kept(spark):
    pairs = [(f"w{i}", 100 - i) for i in range(9)] + [("tie_a", 5), ("tie_b", 5), ("tie_c", 5), ("low", 1)]
    got = sorted(r["w"] for r in ag.topk_with_ties(_counts(spark, pairs), 10).collect())
    assert got == sorted([f"w{i}" for i in range(9)] + ["tie_a", "tie_b", "tie_c"])


def test_topk_with_fewer_than_k_words_returns_all(spark):
    pairs = [("a", 3), ("b", 2), ("c", 2)]
    assert ag.topk_with_ties(_counts(spark, pairs), 10).count() == 3


def test_topk_on_empty_input_is_empty(spark):
    assert ag.topk_with_ties(_counts(spark, []), 10).count() == 0


def test_topk_equals_rank_property(spark):
    import random

    rnd = random.Random(7)
    for _ in range(5):
        pairs = [(f"w{i}", rnd.randint(1, 6)) for i in range(rnd.randint(1, 30))]
        df = _counts(spark, pairs)
        got = sorted((r["w"], r["n"]) for r in ag.topk_with_ties(df, 10).collect())
        ranked = df.withColumn("r", F.rank().over(Window.orderBy(F.col("n").desc())))
        want = sorted((r["w"], r["n"]) for r in ranked.filter("r <= 10").collect())
        assert got == want


def test_topk_values_keep_repeats(spark):
    pairs = [("a", 3), ("b", 3), ("c", 1)]
    assert [r["n"] for r in ag.topk_values(_counts(spark, pairs), 2).collect()] == [3, 3]


def test_text_file_source_counts_equal_table_counts(spark):
    import tempfile

    from sylvan.plans.wordcount import plain_word_counts
    from sylvan.sources import read_text_lines
    from tests.conftest import SF_SMALL

    out = tempfile.mkdtemp(prefix="sylvan-text-")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.select("text").write.mode("overwrite").text(out)
    lines = read_text_lines(spark, out)
    got = {(r["w"], r["n"]) for r in tops.word_count(tops.split_words(lines)).collect()}
    want = {(r["w"], r["n"]) for r in plain_word_counts(spark, SF_SMALL).collect()}
    assert got == want
    assert tops.clean_tokens(lines).count() > 0


def _random_lines(spark, pieces, n=4000):
    import random

    rnd = random.Random(11)
    return spark.createDataFrame([("".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 30))),) for _ in range(n)], "line string")


def test_fast_patterns_find_what_the_plain_ones_find(spark):
    """Runs of letters, signs between Z and a, digits, other scripts and characters of two code units."""
    lines = _random_lines(spark, list("aAz Z[`^_&'é1ß 漢.\\😀𝒳٣-"))
    tokens = [F.regexp_extract_all("line", F.lit(p), 0) for p in (tx.TOKEN_PATTERN, tx.FAST_TOKEN_PATTERN)]
    assert lines.filter(tokens[0] != tokens[1]).count() == 0 and lines.filter(F.size(tokens[0]) > 2).count() > 1000
    names = [p for p, _ in tx.GAZETTEER]
    lines = _random_lines(spark, [*names, *[p[:4] for p in names], *[p[1:] for p in names], " ", "x"])
    found = [F.regexp_extract_all("line", F.lit(p), 1) for p in (tx.gazetteer_pattern(), tx.fast_gazetteer_pattern())]
    assert lines.filter(found[0] != found[1]).count() == 0 and lines.filter(F.size(found[0]) > 2).count() > 1000


def test_a_line_without_a_word_is_read_in_linear_time(spark):
    import time

    lines = spark.range(2).select(F.repeat(F.lit("漢1"), 200_000).alias("line"))
    begun = time.time()
    assert lines.select(F.sum(F.size(tx.tokens(F.col("line"))))).first()[0] == 0
    assert time.time() - begun < 20


def test_lines_without_digits_keep_every_rule_out(spark):
    """The gate of the rules is exact: each rule needs what the gate looks for."""
    import re

    lines = _random_lines(spark, list("$€£%.,: -stndrhkgm٣"))
    for _, pattern in tx.ENTITY_RULES:
        assert re.search(pattern, "2020-01-02 3 kg 15% $4 10:30 2nd") and lines.filter(F.rlike("line", F.lit(pattern))).count() == 0


def test_entity_set_is_every_lines_matches_in_a_plan_that_works_each_rule_out_once(spark):
    from sylvan.operators import text as tops

    lines = _random_lines(spark, ["Paris", "12", "3 kg", "15%", "$40", " ", "10:30", "2020-01-02", "2nd", "x", "é", ","]).unionByName(
        spark.createDataFrame([(None,), ("",)], "line string")).withColumns({"doc_id": F.lit(1), "line_no": F.lit(1)})
    got = tops.entity_set(lines)
    long_lines = lines.filter(F.length("line") > tx.ENTITY_MIN_LINE_LENGTH)
    want = long_lines.select(F.inline(tx.entity_matches(F.col("line")))).distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 50
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 2 * len(tx.ENTITY_RULES)  # both branches of the union
