"""Text operators over a DataFrame of lines ``(doc_id, lang, line_no, line)``.

Tokens are produced with ``posexplode`` of native array expressions; stop
words are removed with a broadcast anti join against a fixed (lang, w) table
whose size is known in advance (a few hundred rows per language).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.functions import text as tx

# The stop-word table has this many rows at most; broadcasting it is safe.
STOPWORD_TABLE_MAX_ROWS = 5000


def stopword_table(spark: SparkSession) -> DataFrame:
    """``(lang, w)``: one newline-joined literal per language, exploded on the JVM side.

    A few literals keep the plan small (an array of ~900 literal rows makes
    analysis itself slow) and no Python worker is involved.
    """
    pairs = tx.stopwords()
    if len(pairs) > STOPWORD_TABLE_MAX_ROWS:
        raise ValueError(f"stop-word table has {len(pairs)} rows, above the broadcast bound")
    by_lang: dict[str, list[str]] = {}
    for lang, w in pairs:
        by_lang.setdefault(lang, []).append(w)
    per_lang = F.array(*[
        F.struct(F.lit(lang).alias("lang"), F.split(F.lit("\n".join(words)), "\n").alias("ws"))
        for lang, words in sorted(by_lang.items())
    ])
    return spark.range(1).select(F.inline(per_lang)).select("lang", F.explode("ws").alias("w"))


def _ids(lines: DataFrame) -> list[str]:
    """Line identity columns: everything but the text and its language."""
    return [c for c in lines.columns if c not in ("line", "lang")]


def split_words(lines: DataFrame) -> DataFrame:
    """One row per space-separated word (empty words kept): ``(<line ids>, pos, w)``."""
    return lines.select(*_ids(lines), F.posexplode(tx.split_words(F.col("line"))).alias("pos", "w"))


def lower_lines(lines: DataFrame) -> DataFrame:
    return lines.select(*_ids(lines), F.lower("line").alias("line"))


def strip_dates(lines: DataFrame) -> DataFrame:
    """Dates removed from lowercased lines."""
    return lines.select(*_ids(lines), tx.strip_dates(F.lower("line")).alias("line"))


def tokenize(lines: DataFrame) -> DataFrame:
    """Tokens of lowercased, date-stripped lines (no entity removal, no stop words)."""
    cleaned = tx.strip_dates(F.lower("line"))
    return lines.select(*_ids(lines), F.posexplode(tx.tokens(cleaned)).alias("pos", "token"))


def remove_entities(lines: DataFrame) -> DataFrame:
    """Every line, with entity strings replaced by a space where the line is longer than the gate length."""
    return lines.select(*_ids(lines), tx.gated_entities(F.col("line")).alias("line"))


def entity_set(lines: DataFrame) -> DataFrame:
    """Distinct (label, entity) strings that entity removal takes out of the corpus."""
    left = lines.filter(F.length("line") > tx.ENTITY_MIN_LINE_LENGTH).select(
        F.col("line").alias("_left"), tx.has_rule_character(F.col("line")).alias("_ruled"))
    at, none = F.col("_left"), F.array().cast("array<struct<label: string, entity: string>>")
    names = []
    # A column after each rule, so that what it left is worked out once and not again for every rule that follows.
    for i, (label, pattern) in enumerate(tx.ENTITY_RULES):
        names.append(f"_found{i}")
        left = left.withColumns({
            names[-1]: F.when(F.col("_ruled"), tx.rule_matches(at, label, pattern)).otherwise(none),
            "_left": F.when(F.col("_ruled"), tx.without_rule(at, label, pattern)).otherwise(at)})
    found = left.select(F.explode(F.array_distinct(F.concat(*names, tx.name_matches(at)))).alias("e"))
    return found.select(F.col("e.label").alias("label"), F.col("e.entity").alias("entity")).distinct()


def stopword_filter(tokens: DataFrame, spark: SparkSession | None = None,
                    lang_col: str = "lang", word_col: str = "token") -> DataFrame:
    """Drop tokens that are stop words of their document's language (broadcast anti join)."""
    spark = spark or tokens.sparkSession
    stop = stopword_table(spark).withColumnRenamed("lang", lang_col).withColumnRenamed("w", word_col)
    return tokens.join(F.broadcast(stop), [lang_col, word_col], "left_anti")


# Language assumed for lines that carry none (plain text files).
DEFAULT_LANG = "en"


def _lang(lines: DataFrame):
    return F.col("lang") if "lang" in lines.columns else F.lit(DEFAULT_LANG)


def filtered_tokens(lines: DataFrame) -> DataFrame:
    """Tokens of lowercased, date-stripped lines without stop words (no entity removal)."""
    ids = _ids(lines)
    toks = lines.select(
        *ids, _lang(lines).alias("lang"),
        F.posexplode(tx.tokens(tx.strip_dates(F.lower("line")))).alias("pos", "token"),
    )
    return stopword_filter(toks).select(*ids, "pos", "token")


def clean_tokens(lines: DataFrame) -> DataFrame:
    """Full cleaning: entities (long lines) -> lowercase -> dates -> tokens -> stop words.

    Output ``(<line ids>, pos, token)``; ``pos`` is the token's place before
    stop words were removed.  Lines without a ``lang`` column use English
    stop words.
    """
    ids = _ids(lines)
    cleaned = lines.select(*ids, _lang(lines).alias("lang"), tx.clean_line(F.col("line")).alias("clean"))
    toks = cleaned.select(
        *ids, "lang",
        F.posexplode(tx.tokens(F.col("clean"))).alias("pos", "token"),
    )
    return stopword_filter(toks).select(*ids, "pos", "token")


def word_count(words: DataFrame, word_col: str = "w") -> DataFrame:
    """``(w, n)``: count per word, partial aggregation before the shuffle."""
    return words.groupBy(F.col(word_col).alias("w")).agg(F.count(F.lit(1)).alias("n"))
