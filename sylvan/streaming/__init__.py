"""Structured Streaming form of the cleaned word count.

The reference has no streaming code; nothing here adds an operator.  This is
the same cleaning and counting plan as :mod:`sylvan.plans.wordcount`, fed by
document files that arrive in a directory (``readStream``) instead of a
fixed table.  Counts are a stateful streaming aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylvan.operators import text as tops
from sylvan.sources import lines_of

DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def document_stream(spark: SparkSession, directory: str, max_files_per_trigger: int = 16) -> DataFrame:
    return (spark.readStream.schema(DOCUMENT_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(directory))


def running_word_counts(docs: DataFrame) -> DataFrame:
    """``(w, n)`` over all documents seen so far (use output mode ``complete`` or ``update``)."""
    return tops.word_count(tops.clean_tokens(lines_of(docs)), "token")
