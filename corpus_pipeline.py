"""The corpus pipeline over ``documents``.

Each stage is one of the numbered operators; its rows are written as Parquet
under the shared checkpoint folder and reread as the next stage's documents.
"""

from __future__ import annotations

from sylvan.llm.common import materialize
from sylvan.llm.language import keep_identified
from sylvan.llm.mixing import take_copies
from sylvan.llm.ngramjoin import keep_one_of_each
from sylvan.llm.packing import pack_documents
from sylvan.llm.toxicity import keep_clean

STAGES = [
    ("language", keep_identified),
    ("toxicity", keep_clean),
    ("near_duplicates", keep_one_of_each),
    ("mixing", take_copies),
    ("packing", pack_documents),
]

#: Language, toxicity and tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The packed sequences' pieces of the documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
