"""Reading tables and text.

A text corpus is a DataFrame of lines ``(doc_id, lang, line_no, line)``; it
comes either from text files (``spark.read.text``) or from a document table
whose ``text`` column holds many lines.  Lines never pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.session import materialize


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Session setting: number of partitions that scans are dealt out over before
# heavy per-row work.  Unset (the default), scans keep their own splits.
MIN_PARTITIONS = "spark.sylvan.minPartitions"


def spread(df: DataFrame, keys=None, partitions: int | None = None) -> DataFrame:
    """Deal a scan out over ``partitions`` by the hash of ``keys`` (default: all columns).

    ``partitions`` None takes the session's setting; without one the scan is
    returned as it is.  The plan never depends on the size of the data or on
    the cores at hand.
    """
    partitions = partitions or int(df.sparkSession.conf.get(MIN_PARTITIONS, "0"))
    return df.repartition(partitions, *(keys or df.columns)) if partitions else df


def spread_over_cores(df: DataFrame, keys=None) -> DataFrame:
    """:func:`spread`; without the setting, a scan of fewer splits than the session has cores is dealt out over the cores.

    For steps whose work per row is heavy: a file of one row group is one task, however many cores there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = not int(df.sparkSession.conf.get(MIN_PARTITIONS, "0")) and df.rdd.getNumPartitions() < cores
    return spread(df, keys, cores if few else None)


def lines_of(docs: DataFrame, text_col: str = "text", keep=("doc_id", "lang")) -> DataFrame:
    """Split each document into lines: ``posexplode(split(text, '\\n', -1))``.

    Null text gives no lines.  Line numbers start at 0.
    """
    cols = [F.col(c) for c in keep if c in docs.columns]
    return docs.select(*cols, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "line"))


def scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the ``documents`` table."""
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), keys=["doc_id"])
    return lines_of(docs)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of plain text files: ``(file, line_id, line)``, newline removed.

    ``line_id`` is unique and increases along each file, but is not a
    consecutive line number: numbering lines would need one task per file.
    """
    raw = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))
    return raw.select("file", F.monotonically_increasing_id().alias("line_id"), "line")


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV with a declared schema (no inference pass) and an explicit header option."""
    return spark.read.schema(schema).option("header", str(header).lower()).csv(path)


#: Column that takes a record which does not fit the declared schema, and a value that no field holds.
CORRUPT, NO_FIELD = "_record", "\x01"


def reject_reason(record: Column, schema: T.StructType) -> Column:
    """Why a record does not fit: ``short``, ``long``, ``mistyped:<first such column>`` or ``unreadable``.

    The record is parsed once more as strings, with one column too many; a field that is not
    there is null, an empty one is not.
    """
    wide = ", ".join(f"c{i} string" for i in range(len(schema.fields) + 1))
    fields = F.from_csv(record, F.lit(wide), {"nullValue": NO_FIELD, "mode": "PERMISSIVE", "escape": '"'})
    of = [fields[f"c{i}"] for i in range(len(schema.fields) + 1)]
    reason = F.when(of[-1].isNotNull(), F.lit("long")).when(of[-2].isNull(), F.lit("short"))
    for f, field in zip(schema.fields, of):
        wrong = (field != "") & field.try_cast(f.dataType).isNull()
        reason = reason.when(wrong, F.lit(f"mistyped:{f.name}"))
    return reason.otherwise(F.lit("unreadable"))


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                     multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of a CSV: rows that fit the schema, and ``(record, reason)`` of the others.

    The files are parsed once; both outputs are read from that.  ``multi_line`` allows line
    breaks inside quotes, and then a file is one task.  A quote inside quotes is doubled.  An empty field is a null, not a reject;
    blank lines are skipped.
    """
    if CORRUPT in schema.names:
        raise ValueError(f"the schema may not name {CORRUPT}")
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = (spark.read.schema(wide).option("header", str(header).lower()).option("mode", "PERMISSIVE")
              .option("multiLine", str(multi_line).lower()).option("columnNameOfCorruptRecord", CORRUPT)
              .option("escape", '"').csv(path))
    parsed = materialize(parsed, "csv")
    bad = F.col(CORRUPT).isNotNull()
    return (parsed.filter(~bad).drop(CORRUPT),
            parsed.filter(bad).select(F.col(CORRUPT).alias("record"), reject_reason(F.col(CORRUPT), schema).alias("reason")))


def csv_roundtrip(df: DataFrame, path: str) -> DataFrame:
    write_csv(df, path)
    return read_csv(df.sparkSession, path, df.schema)


def local_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small fixed table as a JVM-side local relation (``inline`` of literal structs).

    Unlike ``createDataFrame(list)`` it needs no Python worker and the planner
    knows its size, so joins against it broadcast without extra shuffles.
    """
    rows = list(rows)
    fields = schema.fields
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
