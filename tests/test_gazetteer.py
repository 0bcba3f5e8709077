"""Phrases of a table in lines: literal cases, the fixed names against their pattern, brute force, a large table."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from sylvan.functions import text as tx
from sylvan.operators import gazetteer as ga
from sylvan.plans import gazetteer as pg
from sylvan.sources import scan_lines
from tests.conftest import SF_SMALL


def found(spark, lines, phrases):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    table = spark.createDataFrame(phrases, "phrase string, label string")
    rows = ga.matched(df, table).orderBy("i").collect()
    return [[(m.start, m.phrase, m.label) for m in r.matches] for r in rows]


def test_leftmost_longest_inside_words_and_over_words(spark):
    phrases = [("New York", "A"), ("New York City", "B"), ("York City Hall", "C"), ("Yo", "D"), ("ork", "E"), (" é b ", "F"), ("a  b", "G"),
               ("", "X"), (None, "X"), ("Yo", "C")]
    lines = ["in New York City Hall", "aNew Yorker", "Yorkork", "né bé", "a  b  a b", None, "", "New York", "New York"]
    assert found(spark, lines, phrases) == [
        [(3, "New York City", "B")], [(1, "New York", "A")], [(0, "Yo", "C"), (4, "ork", "E")], [(1, "é b", "F")],
        [(0, "a  b", "G")], [], [], [(0, "New York", "A")], [(0, "New York", "A")]]
    assert found(spark, ["x"], [("", "X")]) == [[]]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_an_alternation_on_random_lines(spark, seed):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice("ab ") for _ in range(n))
    phrases = sorted({p.strip() for p in (text(rnd.randint(1, 6)) for _ in range(25)) if p.strip()})
    lines = [text(rnd.randint(0, 40)) for _ in range(120)]
    pattern = re.compile("|".join(sorted(map(re.escape, phrases), key=len, reverse=True)))
    # An alternation takes the first that fits: the longest, as they are ordered.
    ordered = re.compile("|".join(re.escape(p) for p in sorted(phrases, key=lambda p: -len(p))))
    assert pattern.pattern
    want = [[(m.start(), m.group(), "L") for m in ordered.finditer(line)] for line in lines]
    assert found(spark, lines, [(p, "L") for p in phrases]) == want


def test_fixed_names_are_removed_as_by_their_pattern(spark):
    lines = scan_lines(spark, SF_SMALL).select("doc_id", "line_no", "line")
    some = lines.limit(0).unionByName(spark.createDataFrame(
        [(1, 1, f"In {p}s and {p}, {p}{p} now") for p, _ in tx.GAZETTEER], "doc_id long, line_no int, line string"))
    both = lines.unionByName(some)
    want = both.withColumn("line", F.regexp_replace("line", tx.gazetteer_pattern(), " "))
    got = ga.without_phrases(both, pg.names(spark))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.columns == lines.columns


def test_a_million_phrases(spark):
    table = spark.range(1_000_000).select(F.concat(F.lit("k"), F.col("id").cast("string"), F.lit(" z")).alias("phrase"), F.lit("L").alias("label"))
    lines = spark.createDataFrame([("see k999999 zoo",), ("k1000000 z",), ("k77 zk78 z",)], "line string")
    got = {r.line: [(m.start, m.phrase) for m in r.matches] for r in ga.matched(lines, table).collect()}
    assert got == {"see k999999 zoo": [(4, "k999999 z")], "k1000000 z": [], "k77 zk78 z": [(0, "k77 z"), (5, "k78 z")]}


def test_no_python_in_the_plan(spark):
    plan = pg.phrase_removal(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_phrases_that_share_their_first_words_are_not_met_at_each_other(spark):
    """Every line holds the head of every phrase: a place is one that fits, not lines times phrases."""
    n = 20_000
    table = spark.range(n).select(F.concat(F.lit("The w"), "id").alias("phrase"), F.lit("L").alias("label")).unionByName(
        spark.range(n).select(F.concat(F.lit("Of the big k"), "id", F.lit(" z")).alias("phrase"), F.lit("M").alias("label")))
    lines = spark.range(n).select(F.concat(F.lit("The w"), "id", F.lit(" Of the big k"), "id", F.lit(" zoo The Of the ")).alias("line"))
    assert ga.places(lines, ga.phrase_index(table)).count() < 12 * n
    got = ga.matched(lines, table)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.regexp_extract("line", "^The w[0-9]+", 0).alias("phrase"), F.lit("L").alias("label")),
                    F.struct((F.instr("line", "Of") - 1).alias("start"), F.regexp_extract("line", "Of the big k[0-9]+ z", 0).alias("phrase"), F.lit("M").alias("label")))
    assert got.filter(F.col("matches") == whole).count() == n


def test_lookups_too_large_to_send_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(ga, "BROADCAST_ROWS", 0)
    phrases = [("New York", "A"), ("New York City", "B"), ("ork", "E"), ("é b", "F"), ("a  b", "G")]
    lines = ["in New York City Hall", "aNew Yorker", "né bé New ork", "a  b  a b", None, "", "New York"]
    assert found(spark, lines, phrases) == [
        [(3, "New York City", "B")], [(1, "New York", "A")], [(1, "é b", "F"), (10, "ork", "E")], [(0, "a  b", "G")], [], [], [(0, "New York", "A")]]


def test_matches_are_worked_out_once(spark):
    plan = pg.phrase_matches(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
