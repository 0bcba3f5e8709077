"""Finding the phrases of a table in lines: any number of phrases, no pattern.

A phrase may stand anywhere, also inside words; of overlapping phrases the leftmost
counts, and of those that start together the longest.

1. Every *distinct* word of the lines is looked up once: phrases of one word anywhere inside
   it, and first words of longer phrases (heads) where the word ends with one.
2. A word that ends with a head, together with the words after it, is a gram, as long as the
   head's phrases.  Every distinct gram gives one candidate for each length that phrases of
   its head have, and an equality join finds which are phrases.  So the work follows the
   places and the lengths, never the number of phrases that share a first word.
3. Places in the lines whose word or gram was found meet per line, by the line's hash, as
   places (word, letter in it).
4. Next to the line's own text each place is compared letter by letter, so hash
   collisions only cost a comparison, and the kept ones are chosen from left to right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.session import materialize

#: Rows of a lookup table up to which it is sent to all tasks; larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000


def phrase_index(phrases: DataFrame) -> DataFrame:
    """``(phrase, label, head, n, rest)`` of a ``(phrase, label)`` table.

    Spaces around phrases do not count; null and empty phrases are left out; a phrase
    with several labels has the smallest.  ``n``: words of the phrase; ``rest``: letters after its first word.
    """
    trimmed = phrases.select(F.trim("phrase").alias("phrase"), "label").filter("phrase <> ''")
    one = trimmed.groupBy("phrase").agg(F.min("label").alias("label"))
    head = F.substring_index("phrase", " ", 1)
    return one.select("phrase", "label", head.alias("head"), F.size(_words(F.col("phrase"))).alias("n"),
                      (F.length("phrase") - F.length(head) - 1).alias("rest"))


def _words(line: Column) -> Column:
    return F.split(line, " ", -1)


def _lookup(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, and sent to all tasks by joins if it is small."""
    kept = materialize(df, name)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def word_hits(words: DataFrame, index: DataFrame) -> DataFrame:
    """``(word, at, phrase, label)``: phrases of one word at letter ``at`` of a distinct word."""
    single = index.filter("n = 1").select("phrase", "label")
    # Lengths of phrases of one word: a handful of numbers, bounded by the longest one.
    lengths = [r["n"] for r in single.select(F.length("phrase").alias("n")).distinct().orderBy("n").collect()]
    size = F.length("word")
    starts = F.transform(F.sequence(F.lit(0), size - 1), lambda s: F.struct(s.alias("at")))
    each = words.filter(size > 0).select("word", F.inline(starts))
    sizes = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: F.col("at") + n <= size)
    parts = each.select("word", "at", F.explode(sizes).alias("_size")).select(
        "word", "at", F.substring(F.col("word"), F.col("at") + 1, F.col("_size")).alias("phrase"))
    return parts.join(_lookup(single, "single-phrases"), "phrase").select("word", "at", "phrase", "label")


def word_heads(words: DataFrame, index: DataFrame) -> DataFrame:
    """``(word, at, head, n, rests)``: heads that a distinct word ends with, and what lengths their phrases of ``n`` words go on for."""
    heads = index.filter("n > 1").groupBy("head", "n").agg(F.collect_set("rest").alias("rests"))  # no more than the longest phrase
    size = F.length("word")
    starts = F.transform(F.sequence(F.lit(0), size - 1), lambda s: F.struct(s.alias("at")))
    ends = words.filter(size > 0).select("word", F.inline(starts)).withColumn("head", F.substring(F.col("word"), F.col("at") + 1, size))
    return ends.join(_lookup(heads, "phrase-heads"), "head").select("word", "at", "head", "n", "rests")


def gram_hits(grams: DataFrame, heads: DataFrame, index: DataFrame) -> DataFrame:
    """``(word, n, gram, at, phrase, label)``: phrases of ``n`` words that begin in a word and end in the last of the words after it."""
    last = F.length(F.substring_index("gram", " ", -1))
    fitting = F.filter("rests", lambda r: (r <= F.length("gram")) & (r > F.length("gram") - last))
    each = grams.join(heads, ["word", "n"]).select("word", "n", "gram", "at", "head", F.explode(fitting).alias("_rest"))
    phrase = F.concat("head", F.lit(" "), F.substring(F.col("gram"), F.lit(1), F.col("_rest")))
    long = index.filter("n > 1").select("phrase", "label")
    return each.withColumn("phrase", phrase).join(long, "phrase").select("word", "n", "gram", "at", "phrase", "label")


def places(lines: DataFrame, index: DataFrame, line: str = "line") -> DataFrame:
    """``(_line, _word, at, phrase, label)``: where in a line, known by its hash, a phrase may begin."""
    most = index.agg(F.max("n")).first()[0]
    split = lines.select(F.xxhash64(line).alias("_line"), _words(F.col(line)).alias("_words"))
    placed = split.select("_line", "_words", F.posexplode("_words").alias("_word", "word")).select(
        "_line", "_word", "word", F.slice("_words", F.col("_word") + 2, F.lit(max(most - 1, 1))).alias("_after"))
    words = lines.select(F.explode(_words(F.col(line))).alias("word")).distinct()

    def found(hits: DataFrame, *by: str) -> DataFrame:
        return hits.groupBy(*by).agg(F.collect_list(F.struct("at", "phrase", "label")).alias("_found"))

    whole = _lookup(found(word_hits(words, index), "word"), "word-hits")
    out = placed.join(whole, "word").select("_line", "_word", F.inline("_found"))
    if most == 1:
        return out
    heads = materialize(word_heads(words, index), "word-heads")
    sizes = _lookup(heads.groupBy("word").agg(F.collect_set("n").alias("_sizes")), "head-sizes")
    of_size = placed.join(sizes, "word").select("_line", "_word", "word", "_after", F.explode("_sizes").alias("n"))
    spelt = of_size.filter(F.size("_after") >= F.col("n") - 1).select(
        "_line", "_word", "word", "n", F.array_join(F.slice("_after", F.lit(1), F.col("n") - 1), " ").alias("gram"))
    grams = _lookup(found(gram_hits(spelt.select("word", "n", "gram").distinct(), heads, index), "word", "n", "gram"), "gram-hits")
    return out.unionByName(spelt.join(grams, ["word", "n", "gram"]).select("_line", "_word", F.inline("_found")))


def matched(lines: DataFrame, phrases: DataFrame, line: str = "line") -> DataFrame:
    """``lines`` with ``matches``: array of ``(start, phrase, label)``, leftmost-longest, in order of ``start`` (from 0).

    Null lines and lines without a phrase have an empty array.  Equal lines are kept
    apart; a phrase table without phrases matches nothing.
    """
    index = materialize(phrase_index(phrases), "phrases")
    if index.isEmpty():
        empty = F.array().cast("array<struct<start: int, phrase: string, label: string>>")
        return lines.withColumn("matches", empty)
    place = F.struct("_word", "at", "phrase", "label")
    per_line = places(lines, index, line).groupBy("_line").agg(F.collect_set(place).alias("_places"))

    text = F.col(line)

    def start(p: Column) -> Column:
        before = F.when(p["_word"] > 0, F.length(F.array_join(F.slice(_words(text), F.lit(1), p["_word"]), " ")) + 1).otherwise(0)
        return before + p["at"]

    def told(p: Column) -> Column:
        return F.struct(start(p).alias("start"), (-F.length(p["phrase"])).alias("minus"), p["phrase"].alias("phrase"), p["label"].alias("label"))

    there = F.filter(F.transform("_places", told), lambda c: F.substring(text, c["start"] + 1, -c["minus"]) == c["phrase"])
    kind = "array<struct<start: int, phrase: string, label: string>>"
    chosen = F.aggregate(
        F.array_sort(there), F.struct(F.lit(0).alias("free"), F.array().cast(kind).alias("kept")),
        lambda acc, c: F.when(c["start"] < acc["free"], acc).otherwise(F.struct(
            (c["start"] - c["minus"]).alias("free"),
            F.concat(acc["kept"], F.array(F.struct(c["start"].alias("start"), c["phrase"].alias("phrase"), c["label"].alias("label")))).alias("kept"))),
        lambda acc: acc["kept"])
    joined = lines.withColumn("_line", F.xxhash64(line)).join(per_line, "_line", "left")
    return joined.withColumn("matches", F.when(F.col("_places").isNull(), F.array().cast(kind)).otherwise(chosen)).select(*lines.columns, "matches")


def without_phrases(lines: DataFrame, phrases: DataFrame, line: str = "line") -> DataFrame:
    """``lines`` with each phrase replaced by a space."""
    text = F.col(line)
    cut = F.aggregate(
        "matches", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, m: F.struct(
            (m["start"] + F.length(m["phrase"])).alias("at"),
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, m["start"] - acc["at"]), F.lit(" ")).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    kept = [F.when(F.size("matches") > 0, cut).otherwise(text).alias(line) if c == line else F.col(f"`{c}`") for c in lines.columns]
    return matched(lines, phrases, line).select(*kept)
