"""Small helpers shared by the operators: tables, scratch tables and fixed word rules."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.session import materialize  # noqa: F401  (written to the shared checkpoint folder and reread)



def by_value(module: str) -> None:
    """Send functions of ``module`` to the executors with their code, which need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


# Fixed word rules of the query contracts (Java and RE2 read them alike).
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


#: Rows that go to a Python worker at once, at most: texts are long, and batches are held several times.
BATCH_ROWS = 1_000


def bounded_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches small enough for whole texts; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "0")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(col, UPPER, LOWER)


def word_count(col: Column) -> Column:
    """Number of words in a text; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def hash_uniform(tag: str, *parts: Column) -> Column:
    """Repeatable uniform in [0, 1): the first 32 bits of an md5 over tag and parts."""
    key = F.concat_ws("|", F.lit(tag), *[F.coalesce(p.cast("string"), F.lit("\x00null")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
