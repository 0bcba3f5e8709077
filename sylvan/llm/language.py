"""Language identification by Bayesian evidence fusion.

Four pieces of evidence about a document's language are multiplied:

* the likelihood of its whole text under byte-trigram models of each language;
* the declared language (``<html lang=...>`` in the text, else a column), which
  is right or wrong with probabilities counted per declared language;
* the address suffix and the host, whose language shares are smoothed
  hierarchically: a host's counts are added to ``SMOOTHING`` rows with its
  suffix's shares, a suffix's to as many rows with the shares of all documents.

Counts come from one pass over all documents that adds up each document's text
likelihoods (as shares) by host, suffix and declared language, pre-aggregated
before the shuffle; hosts are joined back, and a hot host is only a join key
with many rows on one side.  The trigram models are fitted on a bounded sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm.common import bounded_batches, by_value, materialize, table
from sylvan.llm.memory import give_back, released
from sylvan.llm.urlfilter import url_host
from sylvan.llm.words import LOWER, SEGMENT, text_bytes

by_value(__name__)

LANGUAGES = ("de", "en", "es", "fr")
#: Rows with a declared language that the trigram models are fitted on, at most.
SAMPLE_ROWS = 20_000
GRAM_BITS = 16
#: Rows that a parent's shares count for in its child's.
SMOOTHING = 20.0
#: A text's trigrams are not independent: so many of them count at most.
EFFECTIVE_GRAMS = 60.0
#: Rejected: a best language with less posterior than this, or a text without any letters.
MIN_POSTERIOR = 0.6
MIN_LETTERS = 1


def _grams(raw: np.ndarray) -> np.ndarray:
    """Hash of the lower-cased bytes at each place and its two predecessors."""
    low = LOWER[raw].astype(np.uint32)
    low[(low >= 33) & (low <= 64)] = 32  # digits and marks are as good as a space
    key = low.copy()
    key[1:] += low[:-1] << np.uint32(8)
    key[2:] += low[:-2] << np.uint32(16)
    key *= np.uint32(2654435761)
    return key >> np.uint32(32 - GRAM_BITS)


def _text_sums(raw: np.ndarray, bounds: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Per text and language the sum of log-likelihoods, in segments of bounded size."""
    out = np.zeros((len(bounds) - 1, tables.shape[1]))
    a, last = int(bounds[0]), int(bounds[-1])
    while a < last:
        b = min(a + SEGMENT, last)
        lo = np.searchsorted(bounds, a, "right") - 1
        hi = np.searchsorted(bounds, b, "left")
        marks = np.clip(bounds[lo: hi + 1], a, b) - a
        grams = _grams(raw[a:b])
        for k in range(tables.shape[1]):
            total = np.concatenate(([0.0], np.cumsum(tables[grams, k], dtype=np.float64)))
            out[lo:hi, k] += total[marks[1:]] - total[marks[:-1]]
        a = b
    return out


def fit_models(docs: DataFrame, text_col: str, declared_col: str, id_col: str, languages=LANGUAGES,
               sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Log-probabilities (gram, language), from the sample rows whose declared language is known."""
    chosen = (docs.filter(F.col(declared_col).isin(list(languages)) & F.col(id_col).isNotNull()).select(id_col).distinct()
              .orderBy(F.md5(F.col(id_col).cast("string")), id_col).limit(sample_rows))
    # At most sample_rows ids are broadcast.
    rows = docs.select(id_col, F.col(declared_col).alias("lang"), F.col(text_col).alias("text")).join(F.broadcast(chosen), id_col, "left_semi")
    known = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(known), 1 << GRAM_BITS), dtype=np.int64)
        for batch in batches:
            raw, bounds = text_bytes(batch.column(1))
            for i, lang in enumerate(batch.column(0).to_pylist()):
                if lang in known:
                    seen[known[lang]] += np.bincount(_grams(raw[bounds[i]: bounds[i + 1]]), minlength=1 << GRAM_BITS)
        lang, gram = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(gram.astype(np.int32)), pa.array(seen[lang, gram])], ["lang", "gram", "n"])

    counts = np.zeros((1 << GRAM_BITS, len(languages)))
    counted = rows.select("lang", "text").mapInArrow(released(count), "lang int, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    for lang, gram, n in counted.collect():  # at most languages x 2^GRAM_BITS numbers
        counts[gram, lang] = n
    counts += 0.05
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def text_evidence(text: Column, tables: np.ndarray) -> Column:
    """Struct of ``ll`` (log-likelihood per language, tempered) and ``letters`` (bytes that are letters)."""
    @F.arrow_udf("struct<ll: array<double>, letters: long>")
    def evidence(texts: pa.Array) -> pa.Array:
        raw, bounds = text_bytes(texts)
        sums = _text_sums(raw, bounds, tables)
        sums -= sums.max(axis=1, keepdims=True)
        size = np.maximum(np.diff(bounds), 1)
        sums *= np.minimum(1.0, EFFECTIVE_GRAMS / size)[:, None]
        letter = np.zeros(256, dtype=np.int64)
        letter[97:123] = letter[65:91] = letter[128:] = 1
        letters = np.array([int(letter[raw[a:b]].sum()) for a, b in zip(bounds[:-1], bounds[1:])], dtype=np.int64)
        give_back()
        return pa.StructArray.from_arrays([pa.array(list(sums), pa.list_(pa.float64())), pa.array(letters)], ["ll", "letters"])

    return evidence(text)


def markup_language(text: Column) -> Column:
    """Two-letter language that an ``<html>`` tag in the text declares, else null."""
    found = F.regexp_extract(text, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2})", 1)
    return F.when(found != "", F.lower(found))


def address_suffix(host: Column) -> Column:
    """Last label of a host name; the whole of a name without a dot."""
    return F.lower(F.element_at(F.split(F.coalesce(host, F.lit("")), r"\."), -1))


def _softmax(ll: Column) -> Column:
    top = F.array_max(ll)
    raised = F.transform(ll, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang",
             host_col: str = "source", languages=LANGUAGES, sample_rows: int = SAMPLE_ROWS,
             smoothing: float = SMOOTHING, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """All rows and columns of ``docs`` with ``lid_lang``, ``lid_posterior`` and ``lid_kept``.

    Null and empty texts have no text evidence and no letters and are rejected;
    a null or unknown declared language says nothing; rows without a host share
    one host.  Of languages with equal posterior the first by name is taken.
    Repeated rows are judged alike; an empty table gives none.  Input columns
    named like an output are replaced.
    """
    bounded_batches(docs.sparkSession)
    tables = fit_models(docs, text_col, declared_col, id_col, languages, sample_rows)
    size = len(languages)
    declared = F.coalesce(markup_language(F.col(text_col)), F.lower(F.col(declared_col)))
    declared = F.when(declared.isin(list(languages)), declared).otherwise(F.lit(""))
    names = ("lid_lang", "lid_posterior", "lid_kept")
    rows = docs.drop(*names).withColumns({
        "_declared": declared, "_host": F.coalesce(F.col(host_col), F.lit("")), "_suffix": address_suffix(F.col(host_col))})

    # One pass over all documents: language shares by host, suffix and declared language.
    share = _softmax(F.col("_e.ll"))
    counted = (rows.select("_declared", "_host", "_suffix", text_evidence(F.col(text_col), tables).alias("_e"))
               .filter("_e.letters > 0").select("_declared", "_host", "_suffix", share.alias("s"))
               .groupBy("_declared", "_host", "_suffix")
               .agg(*[F.sum(F.col("s")[k]).alias(f"n{k}") for k in range(size)]))
    counted = materialize(counted, "language-counts")
    sums = [F.sum(f"n{k}").alias(f"n{k}") for k in range(size)]
    whole = [x or 0.0 for x in counted.agg(*sums).first()]
    prior = [(n + 1.0) / (sum(whole) + size) for n in whole]

    def smoothed(parent: list[Column], name: str) -> Column:
        total = sum((F.col(f"n{k}") for k in range(1, size)), F.col("n0"))
        return F.array(*[(F.col(f"n{k}") + smoothing * parent[k]) / (total + smoothing) for k in range(size)]).alias(name)

    suffixes = counted.groupBy("_suffix").agg(*sums).select("_suffix", smoothed([F.lit(p) for p in prior], "ps"))
    hosts = (counted.groupBy("_host", "_suffix").agg(*sums).join(suffixes, "_suffix")
             .select("_host", smoothed([F.col("ps")[k] for k in range(size)], "_ph")))

    # P(declared | language), at most languages + 1 rows of counts.
    seen = {r["_declared"]: [r[f"n{k}"] for k in range(size)] for r in counted.groupBy("_declared").agg(*sums).collect()}
    options = ["", *languages]
    given = {d: [math.log((seen.get(d, [0.0] * size)[k] + 0.5) / (whole[k] + 0.5 * len(options))) for k in range(size)] for d in options}
    said = F.array(*[F.lit(0.0)] * size)
    for d in languages:
        said = F.when(F.col("_declared") == d, F.array(*[F.lit(x) for x in given[d]])).otherwise(said)

    joined = rows.join(hosts, "_host", "left").withColumn("_e", text_evidence(F.col(text_col), tables))
    log_posterior = F.transform(F.arrays_zip(F.col("_e.ll").alias("a"), said.alias("b"), F.col("_ph").alias("c")),
                                lambda z: z["a"] + z["b"] + F.log(F.coalesce(z["c"], F.lit(1.0 / size))))
    joined = joined.withColumn("_p", log_posterior).withColumn("_q", _softmax(F.col("_p")))
    best = F.array_max("_q")
    out = joined.withColumns({
        "lid_lang": F.element_at(F.array(*[F.lit(x) for x in languages]), F.array_position("_q", best).cast("int")),
        "lid_posterior": best,
        "lid_kept": (best >= min_posterior) & (F.col("_e.letters") >= MIN_LETTERS)})
    return out.drop("_declared", "_host", "_suffix", "_e", "_ph", "_p", "_q")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return identify(docs).select("doc_id", F.col("lang").alias("declared"), F.col("lid_lang").alias("language"),
                                 F.col("lid_posterior").alias("posterior"), F.col("lid_kept").alias("kept"))


def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over raw pages: markup taken off, declared by its ``<html lang>``, host and suffix of the url."""
    html = F.col("html")
    plain = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>|<[^>]*>", " ")
    pages = table(spark, sf_dir, "pages").select("page_id", plain.alias("text"), markup_language(html).alias("lang"), url_host(F.col("url")).alias("source"))
    return identify(pages, id_col="page_id").select("page_id", F.col("lang").alias("declared"), F.col("lid_lang").alias("language"),
                                                    F.col("lid_posterior").alias("posterior"), F.col("lid_kept").alias("kept"))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose language is identified, with their columns."""
    return identify(docs).filter("lid_kept").select(*[F.col(f"`{c}`") for c in docs.columns])


QUERIES = {"op3_language": op3_language, "language_of_pages": language_of_pages}
ORACLES: dict[str, str] = {}
