"""The streaming word count equals the batch word count on the same files."""

from __future__ import annotations

import tempfile

from sylvan.plans.wordcount import clean_word_counts
from sylvan.streaming import document_stream, running_word_counts
from tests.conftest import SF_SMALL


def test_streaming_counts_equal_batch_counts(spark):
    src = tempfile.mkdtemp(prefix="sylvan-stream-src-")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.repartition(3).write.mode("overwrite").parquet(src)
    counts = running_word_counts(document_stream(spark, src, max_files_per_trigger=1))
    ckpt = tempfile.mkdtemp(prefix="sylvan-stream-ckpt-")
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("stream_counts")
         .option("checkpointLocation", ckpt).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {(r["w"], r["n"]) for r in spark.sql("SELECT w, n FROM stream_counts").collect()}
    want = {(r["w"], r["n"]) for r in clean_word_counts(spark, SF_SMALL).collect()}
    assert got == want and len(got) > 100
