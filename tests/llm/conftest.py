from __future__ import annotations

import re

import pytest

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text: str) -> str:
    """A-Z only."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def nasty_rows():
    """Nulls in every column, empty, blank and long texts, ties, repeated rows and ids."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    same = "one two three four five six seven eight nine ten"
    return [
        (1, same, "en", "a", 48), (2, same, "en", "a", 48), (2, same, "en", "a", 48),
        (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \t\n", "en", "b", 3),
        (None, same + " eleven", None, "b", 55), (None, None, None, None, None),
        (6, long, "en", None, len(long)), (7, long + " tail", "de", "c", len(long) + 5),
        (8, "x", "xx", "", 1), (9, "Ünï çödé \u2003 text \x00 idiot", "fr", "a", 20),
        (10, "ONE two", "es", "c", 7), (11, "one TWO", "es", "c", 7),
        (12, "This work is licensed under the GNU General Public License, version 3. All rights reserved.", "en", "a", 92),
    ]


@pytest.fixture(scope="session")
def nasty(spark):
    return spark.createDataFrame(nasty_rows(), DOC_SCHEMA).repartition(3).checkpoint()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Tables with nasty documents and a few labels, and the same without any row."""
    base = tmp_path_factory.mktemp("tables")
    docs = spark.createDataFrame(nasty_rows(), DOC_SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 1), (9, 0, 0), (None, 1, 1), (10, None, None)], "doc_id long, quality int, toxic int")
    for name, keep in (("full", True), ("empty", False)):
        docs.filter("true" if keep else "false").write.parquet(f"{base}/{name}/documents.parquet")
        labels.filter("true" if keep else "false").write.parquet(f"{base}/{name}/labels.parquet")
    return str(base)
