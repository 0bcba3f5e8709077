"""Versioned model store: a version is written whole, then published by one rename.

``path/versions/<id>/`` holds a version's tables.  ``path/published/<number>`` names
the version that counts from then on; it is written under another name and renamed, and
the rename fails if the number is taken, so of two writers both are published, one after
the other.  Readers take the highest number (or the one they ask for) and then read that
version's folder, which nobody changes: a writer that dies leaves a folder that no
number names, and a reader never sees parts of two versions.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

PUBLISHED, VERSIONS = "published", "versions"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    """File contexts rename atomically and refuse to replace a file, unlike plain file systems."""
    return spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration())


def published_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    folder = _path(spark, f"{path}/{PUBLISHED}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def _publish(spark: SparkSession, path: str, told: str) -> int:
    """Make the version of ``told`` the newest; returns its number."""
    folder = f"{path}/{PUBLISHED}"
    draft = _path(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = draft.getFileSystem(spark._jsc.hadoopConfiguration()).create(draft)
    stream.write(bytearray(told.encode()))
    stream.close()
    none = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    while True:
        number = (published_numbers(spark, path) or [0])[-1] + 1
        try:
            _files(spark, path).rename(draft, _path(spark, f"{folder}/{number:010d}"), none)
            return number
        except Exception as e:
            if "FileAlreadyExistsException" not in str(e):
                raise


def save_tables(spark: SparkSession, path: str, tables: dict[str, DataFrame], about: dict) -> int:
    """Write the tables as a new version and publish it with ``about``; returns its number."""
    version = uuid.uuid4().hex
    for name, table in tables.items():
        table.write.parquet(f"{path}/{VERSIONS}/{version}/{name}")
    return _publish(spark, path, json.dumps({"version": version, "about": about}))


def load_tables(spark: SparkSession, path: str, names, number: int | None = None) -> tuple[dict[str, DataFrame], dict]:
    """``(tables, about)`` of a published version, by default the newest; ``names`` maps ``about`` to the tables to read."""
    numbers = published_numbers(spark, path)
    if not numbers or number not in (None, *numbers):
        raise FileNotFoundError(f"no published model{'' if number is None else f' {number}'} in {path}")
    told = spark.read.text(f"{path}/{PUBLISHED}/{number or numbers[-1]:010d}", wholetext=True).first()["value"]
    told = json.loads(told)
    folder = f"{path}/{VERSIONS}/{told['version']}"
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names(told["about"])}, told["about"]
