"""Column expressions for cleaning and tokenising text.

Everything here is a native Catalyst expression (regexp_replace, replace,
regexp_extract_all, lower, split); no Python runs per row.  Each pattern is
written so that Java regex (Spark) and RE2 (DuckDB) read it the same way: no
``\\w``, ``\\b`` or look-around.
"""

from __future__ import annotations

import functools
from importlib import resources

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to match).
# ---------------------------------------------------------------------------

# Dates such as "(jan. 2020)" removed before tokenising.
DATE_PATTERN = r"\([aA-zZ]{3,6}.? [0-9]{4}\)"

# Word characters, Unicode-aware in both engines.
WORD_CLASS = r"[\p{L}\p{N}_^']"

# Token pattern: "<c>&<c>" pairs, then words that contain at least one ASCII letter.
TOKEN_PATTERN = (
    r"[aA-zZ]+&[aA-zZ]"
    r"|[A-Za-z]+" + WORD_CLASS + r"*"
    r"|" + WORD_CLASS + r"*[A-Za-z]+" + WORD_CLASS + r"*"
)

# The same tokens for Java's matcher, in time linear in the line: runs are read once (possessive), and a run that gave
# nothing from its start is not tried again from its middle (only a match may end there: \G).
NO_LETTER = r"[\p{L}\p{N}_^'&&[^A-Za-z]]"
FAST_TOKEN_PATTERN = (
    r"(?:\G|(?<![aA-zZ]))[aA-zZ]++&[aA-zZ]"
    r"|[A-Za-z]++" + WORD_CLASS + r"*+"
    r"|(?:\G|(?<!" + WORD_CLASS + r"))" + NO_LETTER + r"++[A-Za-z]" + WORD_CLASS + r"*+"
)

MIN_TOKEN_LENGTH = 2

# Lines longer than this many characters get entities removed.
ENTITY_MIN_LINE_LENGTH = 70

# Entity rules applied in this order: pattern and the group that is the entity.
# A match becomes one space; what the pattern reads after its entity is put back.
ENTITY_RULES = [
    ("PERCENT", r"([0-9]+([.,][0-9]+)? ?%)"),
    ("MONEY", r"([$€£] ?[0-9][0-9.,]*)"),
    ("TIME", r"([0-9]{1,2}:[0-9]{2}(:[0-9]{2})?)"),
    ("DATE", r"([0-9]{4}-[0-9]{2}-[0-9]{2})"),
    ("ORDINAL", r"([0-9]+(st|nd|rd|th))"),
    ("QUANTITY", r"([0-9]+([.,][0-9]+)? ?(km|kg|cm|mm|mi|lb|m|g))([^A-Za-z0-9]|$)"),
    ("CARDINAL", r"([0-9]+([.,][0-9]+)*)"),
]
# Every entity rule reads one of these: lines without are left as they are by all rules.
RULE_CHARACTER = "[0-9]"
# Group of a rule that follows its entity.
ENTITY_REST = {"QUANTITY": 4}

# Gazetteer of place, group and facility names (labels GPE, LOC, NORP, FAC).
GAZETTEER = [
    ("France", "GPE"), ("Germany", "GPE"), ("Spain", "GPE"), ("Italy", "GPE"),
    ("England", "GPE"), ("Portugal", "GPE"), ("Belgium", "GPE"), ("Austria", "GPE"),
    ("Switzerland", "GPE"), ("Canada", "GPE"), ("Mexico", "GPE"), ("Brazil", "GPE"),
    ("China", "GPE"), ("Japan", "GPE"), ("India", "GPE"), ("Egypt", "GPE"),
    ("Israel", "GPE"), ("Paris", "GPE"), ("London", "GPE"), ("Berlin", "GPE"),
    ("Madrid", "GPE"), ("Rome", "GPE"), ("Lyon", "GPE"), ("Marseille", "GPE"),
    ("Munich", "GPE"), ("Hamburg", "GPE"), ("Barcelona", "GPE"), ("Seville", "GPE"),
    ("Vienna", "GPE"), ("Brussels", "GPE"), ("Geneva", "GPE"), ("Lisbon", "GPE"),
    ("Amsterdam", "GPE"), ("New York", "GPE"), ("Jerusalem", "GPE"), ("Babylon", "GPE"),
    ("Frankreich", "GPE"), ("Deutschland", "GPE"), ("Allemagne", "GPE"), ("Espagne", "GPE"),
    ("Alemania", "GPE"), ("Francia", "GPE"), ("Spanien", "GPE"), ("Londres", "GPE"),
    ("Europe", "LOC"), ("Asia", "LOC"), ("Africa", "LOC"), ("Atlantic", "LOC"),
    ("Pacific", "LOC"), ("Mediterranean", "LOC"), ("Alps", "LOC"), ("Pyrenees", "LOC"),
    ("Rhine", "LOC"), ("Seine", "LOC"), ("Danube", "LOC"), ("Nile", "LOC"),
    ("Sahara", "LOC"), ("Andes", "LOC"), ("Europa", "LOC"),
    ("French", "NORP"), ("German", "NORP"), ("Spanish", "NORP"), ("Italian", "NORP"),
    ("English", "NORP"), ("British", "NORP"), ("European", "NORP"), ("American", "NORP"),
    ("Christian", "NORP"), ("Catholic", "NORP"), ("Protestant", "NORP"), ("Jewish", "NORP"),
    ("Muslim", "NORP"), ("Roman", "NORP"), ("Greek", "NORP"), ("Français", "NORP"),
    ("Eiffel Tower", "FAC"), ("Louvre", "FAC"), ("Brandenburg Gate", "FAC"), ("Prado", "FAC"),
    ("Colosseum", "FAC"), ("Golden Gate Bridge", "FAC"), ("Big Ben", "FAC"), ("Notre Dame", "FAC"),
    ("Heathrow", "FAC"), ("Sagrada Familia", "FAC"),
]

# Document language code -> stop-word list in sylvan/data/stopwords (the lists Spark MLlib publishes).
STOPWORD_LANGUAGES = {"en": "english", "fr": "french", "de": "german", "es": "spanish"}


def gazetteer_in_order() -> list[tuple[str, str]]:
    """Longest phrase first, then alphabetical: a fixed, run-independent order."""
    return sorted(GAZETTEER, key=lambda pl: (-len(pl[0]), pl[0]))


@functools.lru_cache(maxsize=None)
def stopwords() -> tuple[tuple[str, str], ...]:
    """(lang, word) pairs of the public stop-word lists kept as package data.

    Plain files read with importlib.resources: the Spark side and the oracle
    SQL see the same words without a JVM or a Spark installation layout.
    """
    folder = resources.files("sylvan.data") / "stopwords"
    pairs = []
    for lang, name in sorted(STOPWORD_LANGUAGES.items()):
        text = (folder / f"{name}.txt").read_text(encoding="utf-8")
        pairs.extend((lang, w) for w in sorted({w.strip() for w in text.splitlines() if w.strip()}))
    return tuple(pairs)


# ---------------------------------------------------------------------------
# Spark column expressions
# ---------------------------------------------------------------------------


def split_words(line: Column) -> Column:
    """Split on a single space; empty strings are kept (limit -1)."""
    return F.split(line, " ", -1)


def strip_dates(text: Column) -> Column:
    return F.regexp_replace(text, DATE_PATTERN, "")


def tokens(text: Column) -> Column:
    """All token-pattern matches of length >= 2, in order."""
    found = F.regexp_extract_all(text, F.lit(FAST_TOKEN_PATTERN), 0)
    return F.filter(found, lambda t: F.length(t) >= MIN_TOKEN_LENGTH)


def gazetteer_pattern() -> str:
    """One alternation of all phrases, the longest first."""
    return "(" + "|".join(p for p, _ in gazetteer_in_order()) + ")"


def fast_gazetteer_pattern() -> str:
    """:func:`gazetteer_pattern` for Java's matcher: phrases are tried only where one's first letter stands, by that letter."""
    of_letter: dict[str, list[str]] = {}
    for p, _ in gazetteer_in_order():
        of_letter.setdefault(p[0], []).append(p[1:])
    tried = "|".join(f"{first}(?:{'|'.join(rests)})" for first, rests in sorted(of_letter.items()))
    return f"(?=[{''.join(sorted(of_letter))}])({tried})"


def without_rule(line: Column, label: str, pattern: str) -> Column:
    """``line`` with each match of one rule replaced by a space."""
    return F.regexp_replace(line, pattern, f" ${ENTITY_REST[label]}" if label in ENTITY_REST else " ")


def has_rule_character(line: Column) -> Column:
    """Whether an entity rule may match in ``line``."""
    return F.rlike(line, F.lit(RULE_CHARACTER))


def without_rules(line: Column) -> Column:
    """``line`` after all entity rules, in their order."""
    left = line
    for label, pattern in ENTITY_RULES:
        left = without_rule(left, label, pattern)
    return F.when(has_rule_character(line), left).otherwise(line)


def remove_entities(line: Column) -> Column:
    """Replace entity strings with one space (rules first, then gazetteer phrases)."""
    return F.regexp_replace(without_rules(line), fast_gazetteer_pattern(), " ")


def gated_entities(line: Column) -> Column:
    """Entity removal on lines longer than the gate; shorter ones pass as they are."""
    return F.when(F.length(line) > ENTITY_MIN_LINE_LENGTH, remove_entities(line)).otherwise(line)


def clean_line(line: Column) -> Column:
    """Entity removal on long lines, then lowercase and strip dates."""
    return strip_dates(F.lower(gated_entities(line)))


def rule_matches(line: Column, label: str, pattern: str) -> Column:
    """array<struct<label, entity>> of the strings that one rule takes out of ``line``."""
    found = F.regexp_extract_all(line, F.lit(pattern), F.lit(1))
    return F.transform(found, lambda e: F.struct(F.lit(label).alias("label"), e.alias("entity")))


def name_matches(line: Column) -> Column:
    """array<struct<label, entity>> of the gazetteer phrases in ``line``."""
    kinds = F.create_map(*[F.lit(x) for pair in gazetteer_in_order() for x in pair])
    found = F.regexp_extract_all(line, F.lit(fast_gazetteer_pattern()), F.lit(1))
    return F.transform(found, lambda e: F.struct(kinds[e].alias("label"), e.alias("entity")))


def entity_matches(line: Column) -> Column:
    """array<struct<label, entity>> of the distinct entity strings that :func:`remove_entities` takes out."""
    parts, left = [], line
    for label, pattern in ENTITY_RULES:
        parts.append(rule_matches(left, label, pattern))
        left = without_rule(left, label, pattern)
    return F.array_distinct(F.concat(*parts, name_matches(left)))
