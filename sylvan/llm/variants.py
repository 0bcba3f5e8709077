"""Spelling variants: words that differ by one letter, found by permuterm rotations.

1. One scan counts the words of whole texts.  The query's rule that spoils every 199th
   (document, word) is a parameter of the count; tasks count in bounded tables before the
   shuffle, so a frequent word is a row per table.
2. A word ends with a terminator and is rotated.  The rotation that begins behind letter
   ``i`` ends with letter ``i``: without its last letter it is a prefix that skips the
   edited letter.  Words that share this prefix differ by replacing that letter, and a
   word that is the prefix itself, as a whole rotation, is the word without that letter.
   In a run of equal letters only the last one's prefix counts as a deletion, so every
   pair of near words meets exactly once.
3. Prefixes and whole rotations are range-partitioned and sorted together, and a scan
   reads them group by group.  A group holds words equal but for one letter (at most the
   alphabet) and the one word without it; each member learns how many neighbours it has
   there and the best of them, so no pairs are written.
4. A word's form is its most frequent neighbour, if frequent enough.  Along forms counts
   grow by that factor, so the longest chain is bounded by the logarithm of the largest
   count, and roots are found by doubling in the logarithm of that.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm.common import bounded_batches, by_value, materialize, table

by_value(__name__)

MIN_LETTERS = 6
MIN_COUNT = 5
#: A form is at least so many times as frequent as the word.
FACTOR = 5
#: Every so many-th hash value spoils a word (0: none).
SPOIL = 199
#: Different words that a task counts before it hands them on.
TABLE_WORDS = 400_000

#: Fixed by the query's contract: runs of these letters, with A-Z already lower-cased.
LETTERS = re.compile("[a-zÀ-ÿ]+")
#: Behind a word; no letter.
END = "$"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                min_count: int = MIN_COUNT, spoil: int = SPOIL) -> DataFrame:
    """``(word, n)`` of the words of all texts; a null id is hashed as an empty string."""
    bounded_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                if not text:
                    continue
                begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # Bytes are lower-cased as ASCII, and only then read as text.
                for run, n in Counter(LETTERS.findall(text.lower().decode("utf-8", "replace"))).items():
                    if spoil:
                        h = zlib.crc32(run.encode(), begun)
                        if h % spoil == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1:]
                    if len(run) >= min_letters:
                        counts[run] += n
                if len(counts) >= TABLE_WORDS:
                    yield flush()
        yield flush()

    found = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(rows, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """``(prefix, word, n, kind)``: prefixes that skip a letter (kind 1, or 2 where it counts as deleted) and whole rotations (0)."""
    word = F.col("word")
    letters = F.length(word)

    def behind(i):  # the rotation that begins at letter i, up to letter j
        return lambda j: F.concat(F.substr(word, i + 1), F.lit(END), F.substr(word, F.lit(1), j))

    whole = F.transform(F.sequence(F.lit(0), letters), lambda i: F.struct(behind(i)(i).alias("prefix"), F.lit(0).alias("kind")))
    skipping = F.transform(
        F.sequence(F.lit(0), letters - 1),
        lambda i: F.struct(behind(i + 1)(i).alias("prefix"),
                           F.when(F.substr(word, i + 1, F.lit(1)) != F.substr(word, i + 2, F.lit(1)), 2).otherwise(1).alias("kind")))
    return words.select("word", "n", F.explode(F.concat(whole, skipping)).alias("r")).select("r.prefix", "word", "n", "r.kind")


def _neighbours(group: list[tuple[int, str, int]], out: list[tuple[str, int, int, str]]) -> None:
    """Members ``(n, word, kind)`` of one prefix, the best first: each with the neighbours it has here and the best."""
    same = [m for m in group if m[2]]
    shorter = next((m for m in group if not m[2]), None)
    for k, (_, word, kind) in enumerate(same):
        best = same[0] if k else same[1] if len(same) > 1 else None
        near = len(same) - 1
        if shorter and kind == 2:
            near += 1
            if best is None or (-shorter[0], shorter[1]) < (-best[0], best[1]):
                best = shorter
        if best:
            out.append((word, near, best[0], best[1]))
    longer = [m for m in same if m[2] == 2]
    if shorter and longer:
        out.append((shorter[1], len(longer), longer[0][0], longer[0][1]))


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` of the words that have a near word: how many, and the most frequent (ties: smallest)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, group = None, []
        for batch in batches:
            out: list[tuple[str, int, int, str]] = []
            for key, word, n, kind in zip(*[c.to_pylist() for c in batch.columns]):
                if key != prefix:
                    if len(group) > 1:
                        _neighbours(group, out)
                    prefix, group = key, []
                group.append((n, word, kind))
            yield _rows(out)
        out = []
        if len(group) > 1:
            _neighbours(group, out)
        yield _rows(out)

    def _rows(out):
        columns = [list(c) for c in zip(*out)] or [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "near", "n", "best"])

    ordered = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix", F.col("n").desc(), "word")
    found = ordered.select("prefix", "word", "n", "kind").mapInArrow(scan, "word string, near long, n long, best string")
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col("best")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """``(word, root)`` of words that have a form: the end of a chain of at most ``longest`` forms."""
    ends = forms.select("word", F.col("form").alias("root"))
    for step in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        on = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = materialize(ends.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), f"roots-{step}")
    return ends


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
             min_count: int = MIN_COUNT, factor: int = FACTOR, spoil: int = SPOIL) -> DataFrame:
    """One row per word: its count, its near words, and the form and root that it is a variant of.

    Null and empty texts have no words; repeated rows and ids all count; other columns
    of ``docs`` are not read.  Of equally frequent near words the smallest in
    code-point order is the form.  An empty table gives no rows.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2, so that counts grow along forms")
    words = materialize(word_counts(docs, id_col, text_col, min_letters, min_count, spoil), "words")
    enough = F.col("best_n") >= F.lit(factor) * F.col("n")
    told = materialize(words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")), "forms")
    most = told.agg(F.max("form_n")).first()[0]
    # Every form has at least ``factor`` times its word's count, and words have ``min_count``.
    longest = int(math.log(most / min_count, factor) + 1e-9) if most else 0
    ends = roots(told.filter("form is not null"), longest)
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


#: The crc of a byte string is folded byte by byte over the table of the reflected polynomial.
SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(CAST(b AS BIGINT), range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) r(b)),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY doc_id, run),
spelled AS (
  SELECT run, n, hex(encode(concat(doc_id, ':', run))) AS bytes FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(bytes) // 2),
      lambda i: CAST('0x' || substr(bytes, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM spelled, crc_table),
spoiled AS (
  SELECT CASE WHEN h % {SPOIL} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoiled GROUP BY word
  HAVING length(word) >= {MIN_LETTERS} AND sum(n) >= {MIN_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS (
  SELECT DISTINCT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a
  JOIN holes b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION
  SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.head || h.tail
  UNION
  SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.head || h.tail),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n,
    first(other ORDER BY other_n DESC, other) AS best FROM near GROUP BY word),
told AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.best_n >= {FACTOR} * w.n THEN b.best END AS form,
    CASE WHEN b.best_n >= {FACTOR} * w.n THEN b.best_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  SELECT word, coalesce(form, word) AS root FROM told
  UNION ALL
  SELECT c.word, t.form FROM chain c JOIN told t ON t.word = c.root WHERE t.form IS NOT NULL AND c.root <> c.word),
ends AS (
  SELECT c.word, c.root FROM chain c JOIN told t ON t.word = c.root WHERE t.form IS NULL)
SELECT t.word, t.form, e.root, t.n, t.n_near, t.form_n FROM told t JOIN ends e ON e.word = t.word
"""

QUERIES = {"op13_variants": op13_variants}
ORACLES = {"op13_variants": SQL}
