"""License scans with a positional rare-token index (native DataFrame operations only).

Every template is a run of licence words with a label; its mandatory key phrase
is a run of words inside it.  A file is reduced to its licence words with their
places.  The index has a posting (word, place, template) for the word of each
key phrase with the highest inverse document frequency over all documents: a
file that holds the phrase holds that word, and none of the phrase is rarer in
it.  One pass over a file's licence words finds the indexed ones; the postings
of each give the places where templates would start, the key phrase is verified
word by word, and the template's other postings are looked up at their places
relative to it.  A match scores by the share of inverse document frequency that
lies where the template has it.

The licence words of a file are an array in its row, so postings are intersected
inside the row: nothing is shuffled by word or template, however frequent.
Places in that array rise by at least one, so the words of a template that
starts at a given place lie in a slice of the template's length around the key
phrase: the work is linear in a file's licence words, however often it repeats
a notice.  Only document frequencies, one number for each licence word, go to
the driver; their number is the size of the vocabulary, which the template
parameter fixes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm.common import LOWER, UPPER, ascii_lower, materialize, table

# Fixed values of the query: the word rule, and the base phrases with their labels.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

#: (label, notice, key phrase in it).  Notices are lower-case words.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "dedicated to the public domain under cc0 1 0", "cc0 1 0"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2",
     "gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose",
     "permission to use copy modify and or distribute this software"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy",
     "permission is hereby granted free of charge"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software released into the public domain"),
]

#: A verified template counts as found from this share of its weight on.
MIN_SCORE = 0.5
#: Decimal places of a score.
SCORE_DIGITS = 6


def file_words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(LICENSE_WORD), F.lit(0))


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _index(entries: list[tuple[list[str], list[str]]], idf: dict[str, float]) -> Column:
    """The postings, as an array: indexed word ``w``, its place ``at`` in the key phrase, and the template it belongs to."""
    out = []
    for t, (notice, key) in enumerate(entries):
        at = max(range(len(key)), key=lambda j: (idf[key[j]], -j))
        shift = next(j for j in range(len(notice)) if notice[j: j + len(key)] == key)
        total = sum(idf[w] for w in notice)
        out.append(F.struct(
            F.lit(key[at]).alias("w"), F.lit(at).alias("at"), F.lit(t).alias("t"), F.lit(shift).alias("shift"), _strings(key).alias("key"),
            _strings(notice).alias("notice"), F.array(*[F.lit(idf[w] / total) for w in notice]).alias("share")))
    return F.array(*out)


def _stands(hits: Column, first: Column, key: Column) -> Column:
    """Whether the words of ``key`` stand consecutively from hit ``first`` on (no hit before the first or after the last is read)."""
    place = F.get(hits, first)["p"]
    same = F.forall(F.sequence(F.lit(0), F.size(key) - 1), lambda j: F.coalesce(
        (F.get(hits, first + j)["w"] == F.get(key, j)) & (F.get(hits, first + j)["p"] == place + j), F.lit(False)))
    return (first >= 0) & same


def _share(hits: Column, found: Column) -> Column:
    """Share of a notice's weight at its relative places, around a verified key phrase at hit ``found.first``."""
    start = F.get(hits, found["first"])["p"] - found["e"]["shift"]
    around = F.sequence(F.lit(0), F.size(found["e"]["notice"]) - 1)

    def add(total: Column, k: Column) -> Column:
        hit = F.get(hits, found["first"] - found["e"]["shift"] + k)
        there = F.get(found["e"]["notice"], hit["p"] - start) == hit["w"]
        return total + F.when(there, F.get(found["e"]["share"], hit["p"] - start)).otherwise(0.0)

    return F.aggregate(around, F.lit(0.0), add)


def _matches(hits: Column, index: Column, words: list[str]) -> Column:
    """``(t, place, score)`` of every place where a template's key phrase stands."""
    rare = F.filter(F.transform(hits, lambda h, i: F.when(h["w"].isin(words), F.struct(i.alias("i"), h["w"].alias("w")))), lambda r: r.isNotNull())
    meets = F.flatten(F.transform(rare, lambda r: F.transform(
        F.filter(index, lambda e: e["w"] == r["w"]), lambda e: F.struct(e.alias("e"), (r["i"] - e["at"]).alias("first")))))
    verified = F.filter(meets, lambda m: _stands(hits, m["first"], m["e"]["key"]))
    return F.transform(verified, lambda m: F.struct(
        m["e"]["t"].alias("t"), F.get(hits, m["first"])["p"].cast("long").alias("place"), F.round(_share(hits, m), SCORE_DIGITS).alias("score")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None, base=None,
                  min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document: words, base places, labels and the score of the best verified template.

    ``n_base`` counts every place of every base phrase; ``first_word`` and
    ``last_word`` are the smallest and the largest start (null without any).
    ``base_labels`` and ``labels`` are distinct, sorted and comma-joined (empty
    without any); ``labels`` has the base ones and the verified templates with
    at least ``min_score``.  ``score`` is 1 for a base phrase, since it is there
    word by word, else the best share of weight of a verified template with at
    least ``min_score``, else 0; shares have six digits.  Null texts are
    empty; empty files have no words and labels; ids may be null or repeated;
    an empty table gives no rows.  Other columns of ``docs`` are not read.
    """
    templates = TEMPLATES if templates is None else templates
    base = BASE_PHRASES if base is None else base
    labels = [label for _, label in base] + [label for label, _, _ in templates]
    entries = [(phrase.split(), phrase.split()) for phrase, _ in base] + [(notice.split(), phrase.split()) for _, notice, phrase in templates]
    vocabulary = sorted({w for notice, key in entries for w in notice + key})

    words = docs.select(F.col(id_col), file_words(F.col(text_col)).alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(i.alias("p"), w.alias("w")))),
                    lambda h: h.isNotNull())
    files = materialize(words.select(id_col, F.size("words").cast("long").alias("n_words"), hits.alias("hits")), "licence-words")

    # Document frequencies of the licence words, over all documents.
    counted = (files.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w"))
               .groupBy("w").agg(F.count(F.lit(1)).alias("df")).collect())
    df = {r["w"]: r["df"] for r in counted}
    n = files.count()
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 0.5)) + 1e-6 for w in vocabulary}

    rare = sorted({max(key, key=lambda w: idf[w]) for _, key in entries})
    found = files.select(id_col, "n_words", _matches(F.col("hits"), _index(entries, idf), rare).alias("found"))
    in_base = F.filter("found", lambda m: m["t"] < len(base))
    good = F.filter("found", lambda m: (m["t"] >= len(base)) & (m["score"] >= min_score))
    found = found.select(id_col, "n_words", F.transform(in_base, lambda m: m["place"]).alias("places"),
                         F.transform(in_base, lambda m: m["t"]).alias("base"), F.transform(good, lambda m: m["t"]).alias("own"),
                         F.array_max(F.transform(good, lambda m: m["score"])).alias("best"))

    def joined(which: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(F.array_distinct(which), lambda t: F.get(_strings(labels), t)))), ",")

    return found.select(
        id_col, "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        joined(F.col("base")).alias("base_labels"), joined(F.concat("base", "own")).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.col("best"), F.lit(0.0))).alias("score"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same result from the words of each text: places of key phrases, then the notice's words at their places."""
    rows = [(f"'{label}'", phrase, phrase, "true") for phrase, label in BASE_PHRASES]
    rows += [(f"'{label}'", notice, phrase, "false") for label, notice, phrase in TEMPLATES]
    values = ", ".join(f"({t}, {label}, split('{notice}', ' '), split('{key}', ' '), {base})" for t, (label, notice, key, base) in enumerate(rows))
    return rf"""
WITH templates(t, label, notice, key, base) AS (VALUES {values}),
slots AS (SELECT t, unnest(notice) AS w, generate_subscripts(notice, 1) - 1 AS j FROM templates),
shifts AS (SELECT *, (SELECT min(j) FROM range(len(notice)) r(j) WHERE notice[j + 1: j + len(key)] = key) AS shift FROM templates),
files AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{LICENSE_WORD}'), lambda w: w <> '') AS ws FROM documents
), hits AS (
  SELECT * FROM (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM files) WHERE w IN (SELECT w FROM slots)
), idf AS (
  SELECT v.w, ln((SELECT count(*) + 1 FROM files) / (count(DISTINCT r) + 0.5)) + 1e-6 AS idf
  FROM (SELECT DISTINCT w FROM slots) v LEFT JOIN hits USING (w) GROUP BY v.w
), totals AS (SELECT t, sum(idf) AS total FROM slots JOIN idf USING (w) GROUP BY t
), places AS (
  SELECT h.r, h.p, s.* FROM hits h JOIN shifts s ON s.key[1] = h.w JOIN files f ON f.r = h.r WHERE f.ws[h.p + 1: h.p + len(s.key)] = s.key
), scored AS (
  SELECT x.r, x.t, x.label, x.base, x.p, round(sum(idf / total), {SCORE_DIGITS}) AS score
  FROM places x JOIN slots s ON s.t = x.t JOIN hits h ON h.r = x.r AND h.p = x.p - x.shift + s.j AND h.w = s.w
  JOIN idf i ON i.w = s.w JOIN totals y ON y.t = x.t GROUP BY ALL
), judged AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(p) FILTER (base) AS first_word, max(p) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR score >= {MIN_SCORE}) AS labels,
    max(score) FILTER (NOT base AND score >= {MIN_SCORE}) AS best
  FROM scored GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM files LEFT JOIN judged USING (r)
"""


QUERIES = {"op7_licenses": op7_licenses}
ORACLES = {"op7_licenses": _oracle()}
