"""Feature preparation with MLlib transformers: string indexing and vector assembly.

``StringIndexer`` orders labels by frequency (ties alphabetically) and, by
default, fails on unseen or null labels.  Assembled vectors are turned into
``array<double>`` with ``vector_to_array`` so the rest of the engine works on
plain arrays.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from sylvan.session import materialize
from sylvan.sources.tables import local_rows


def indexed_name(col: str) -> str:
    return f"{col}_idx"


#: Labels that are ranked on the driver at most; more are ranked in a range partitioning.
LOCAL_LABELS = 1_000


def string_index_table(df: DataFrame, col: str, local_labels: int = LOCAL_LABELS) -> DataFrame:
    """``(value, idx)``: labels by frequency, ties alphabetical, as StringIndexer orders them.

    Up to ``local_labels`` distinct values come ranked from one top-k; more are ranked
    in a range partitioning of (count, value) by counts per partition, so a large set of
    labels is never gathered in one task.  Null labels have no index.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("cnt"))
    order = [F.col("cnt").desc(), F.col("value")]
    first = counts.orderBy(*order).limit(local_labels + 1).collect()
    if len(first) <= local_labels:
        schema = T.StructType([T.StructField("value", df.schema[col].dataType), T.StructField("idx", T.DoubleType())])
        return local_rows(df.sparkSession, [(r["value"], float(i)) for i, r in enumerate(first)], schema)
    ranged = materialize(counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "labels")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.join(before, "_part").select("value", rank.cast("double").alias("idx"))


def feature_pipeline(numeric: list[str], to_index: list[str], out: str = "features") -> Pipeline:
    stages = [StringIndexer(inputCol=c, outputCol=indexed_name(c)) for c in to_index]
    stages.append(VectorAssembler(inputCols=numeric + [indexed_name(c) for c in to_index], outputCol=out))
    return Pipeline(stages=stages)


def fit_features(train: DataFrame, numeric: list[str], to_index: list[str], out: str = "features") -> PipelineModel:
    return feature_pipeline(numeric, to_index, out).fit(train)


def as_array(df: DataFrame, vec: str = "features", out: str = "x") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(vec), "float64"))


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Numeric columns to one ``array<double>`` column through ``VectorAssembler``."""
    assembled = VectorAssembler(inputCols=cols, outputCol="_vec").transform(df)
    return assembled.withColumn(out, vector_to_array(F.col("_vec"), "float64")).drop("_vec")


def index_labels(df: DataFrame, labels: DataFrame, col: str) -> DataFrame:
    """``df`` with ``<col>_idx`` from a table ``(value, idx)``; null for a null label, an error for an unseen one."""
    table = labels.select(F.col("value").alias("_value"), F.col("idx").alias("_idx"))
    joined = df.join(table, F.col(col) == F.col("_value"), "left")
    unseen = F.col("_idx").isNull() & F.col(col).isNotNull()
    checked = F.when(unseen, F.raise_error(F.lit(f"unseen label in {col}"))).otherwise(F.col("_idx"))
    return joined.withColumn(indexed_name(col), checked.cast("double")).drop("_value", "_idx")
