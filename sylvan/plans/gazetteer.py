"""Phrases of a table in the lines of the documents.

The table is the fixed names of :mod:`sylvan.functions.text` and, as a table that grows with the
data, the first two words of every document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.functions import text as tx
from sylvan.operators import gazetteer as ga
from sylvan.plans.oracle_text import LINES, q
from sylvan.sources import read_table, scan_lines
from sylvan.sources.tables import local_rows

TITLE = "TITLE"


def names(spark: SparkSession) -> DataFrame:
    """The fixed names as a ``(phrase, label)`` table."""
    schema = T.StructType([T.StructField("phrase", T.StringType()), T.StructField("label", T.StringType())])
    return local_rows(spark, tx.GAZETTEER, schema)


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.array_join(F.slice(F.split("text", " ", -1), 1, 2), " ")
    titles = read_table(spark, sf_dir, "documents").select(first.alias("phrase"), F.lit(TITLE).alias("label"))
    return names(spark).unionByName(titles)


def phrase_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every phrase of every line: its place there and its label."""
    found = ga.matched(scan_lines(spark, sf_dir), phrases(spark, sf_dir))
    # Outer, since else the optimizer filters by the size of the matches, and so works them out twice.
    return found.select("doc_id", "line_no", F.inline_outer("matches")).filter("start is not null")


def phrase_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, each phrase replaced by a space."""
    return ga.without_phrases(scan_lines(spark, sf_dir).select("doc_id", "line_no", "line"), phrases(spark, sf_dir))


MATCHES = f"""{LINES},
named AS (SELECT trim(phrase) AS phrase, label FROM (
  SELECT * FROM (VALUES {", ".join(f"({q(p)}, {q(label)})" for p, label in tx.GAZETTEER)}) AS g(phrase, label)
  UNION ALL SELECT array_to_string(string_split(text, ' ')[1:2], ' '), '{TITLE}' FROM documents WHERE text IS NOT NULL)),
phrases AS (SELECT phrase, min(label) AS label FROM named WHERE phrase <> '' GROUP BY phrase),
texts AS (SELECT DISTINCT line FROM lines),
held AS (SELECT t.line, p.phrase, p.label FROM texts t JOIN phrases p ON contains(t.line, p.phrase)),
places AS (SELECT line, phrase, label, unnest(range(length(line) - length(phrase) + 1)) AS start FROM held),
longest AS (
  SELECT line, CAST(start AS INTEGER) AS start, phrase, label FROM places WHERE substr(line, start + 1, length(phrase)) = phrase
  QUALIFY row_number() OVER (PARTITION BY line, start ORDER BY length(phrase) DESC) = 1),
linked AS (
  SELECT a.line, a.start, a.phrase, a.label, min(b.start) AS following
  FROM longest a LEFT JOIN longest b ON b.line = a.line AND b.start >= a.start + length(a.phrase)
  GROUP BY a.line, a.start, a.phrase, a.label),
walk AS (
  SELECT * FROM linked QUALIFY start = min(start) OVER (PARTITION BY line)
  UNION ALL
  SELECT n.* FROM walk w JOIN linked n ON n.line = w.line AND n.start = w.following)"""

ORACLES = {
    "phrase_matches": f"WITH RECURSIVE {MATCHES} SELECT l.doc_id, l.line_no, w.start, w.phrase, w.label "
                      "FROM lines l JOIN walk w ON w.line = l.line",
    "phrase_removal": f"""WITH RECURSIVE {MATCHES},
pieces AS (
  SELECT line, start, substr(line, 1 + coalesce(lag(start + length(phrase)) OVER before, 0),
      start - coalesce(lag(start + length(phrase)) OVER before, 0)) || ' ' AS piece, start + length(phrase) AS stop
  FROM walk WINDOW before AS (PARTITION BY line ORDER BY start)),
cut AS (SELECT line, string_agg(piece, '' ORDER BY start) || substr(line, 1 + max(stop)) AS out FROM pieces GROUP BY line)
SELECT l.doc_id, l.line_no, coalesce(c.out, l.line) AS line FROM lines l LEFT JOIN cut c ON c.line = l.line""",
}
QUERIES = {"phrase_matches": phrase_matches, "phrase_removal": phrase_removal}
