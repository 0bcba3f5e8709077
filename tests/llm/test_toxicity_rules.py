"""Evidence, quotations and misspellings of the toxicity scores."""

from __future__ import annotations

import pytest

from sylvan.llm import toxicity


def test_only_copies_are_one_piece_of_evidence(spark):
    # Rows that share most of their words are no copies; the same words in order are.
    texts = [f"common words of every row number{i}" for i in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t.upper() + " !") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 100 < 10)) for i, _ in rows], "doc_id long, toxic int")
    assert toxicity.learn(docs, labels).learned_from == 40


@pytest.mark.parametrize("quoted", ['"you are an idiot"', "«you are an idiot»", "„you are an idiot“", "“what an idiot,”", '"idiot,"', "»so ein idiot, du«", "‘you idiot’"])
def test_quoted_phrases_count_as_quoted(quoted):
    scorer = toxicity.Scorer(toxicity.Model())
    (hit,), _ = scorer.hits(f"The judge read out {quoted} aloud")
    assert hit[2] == toxicity.QUOTED
    assert scorer.score(f"The judge read out {quoted} aloud")[0] < toxicity.THRESHOLD


@pytest.mark.parametrize("text", ['it is 5" wide you idiot "', 'open "here\nyou idiot" there', "don’t, you idiot, don’t", '"hello" you idiot "bye"'])
def test_abuse_outside_quotations_counts(text):
    (hit,), _ = toxicity.Scorer(toxicity.Model()).hits(text)
    assert hit[2] == toxicity.ADDRESSED


def test_stems_match_with_one_edit():
    automaton = toxicity.Automaton(("xyz",), ("grobian", "abc"))
    assert automaton.kind("grobians") == "stem"
    for word in ("grobjan", "grobjans", "gobians", "groobianen", "rgrobian", "xgrobians", "grobia"):
        assert automaton.kind(word) == "fuzzy", word
    for word in ("grxbjan", "grob", "abx", "abxde"):  # two edits, too much left out, short stems
        assert automaton.kind(word) == "", word
