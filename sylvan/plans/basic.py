"""Queries for sources, projections and simple aggregates, each over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.operators import aggregate as ag
from sylvan.session import scratch_path
from sylvan.sources import csv_roundtrip, read_csv_checked, read_table

def lineitem_rid(df: DataFrame) -> DataFrame:
    """Row id of a lineitem row: its four key columns joined by '-' (unique in the test data)."""
    rid = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return df.withColumn("rid", rid)


RID_SQL = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)"


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    return csv_roundtrip(customer, scratch_path(spark, "customer-csv"))


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as text with faults by their key, and read against the schema: each key with ``ok`` or why it is rejected."""
    customer = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    fields = [F.col(c).cast("string") for c in customer.columns]
    spoiled = F.when(key % 13 == 0, F.lit("n/a")).otherwise(fields[3])
    whole = F.concat_ws(",", *fields[:3], spoiled, fields[4])
    line = F.when(key % 7 == 0, F.concat(whole, F.lit(",more"))).when(key % 11 == 0, F.concat_ws(",", *fields[:4])).otherwise(whole)
    path = scratch_path(spark, "customer-lines")
    customer.select(line.alias("line")).write.text(path)
    rows, rejects = read_csv_checked(spark, path, customer.schema, header=False)
    rejected = rejects.select(F.substring_index("record", ",", 1).cast("long").alias("c_custkey"), "reason")
    return rows.select("c_custkey", F.lit("ok").alias("reason")).unionByName(rejected)


def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.head_n(read_table(spark, sf_dir, "customer"), 5, "c_custkey")


def row_as_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    return nation.select(F.to_json(F.struct(*nation.columns)).alias("row_json"))


def keep_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    keep = ["c_custkey", "c_name"]
    return customer.select(*keep)


# The predicate of the indicator queries: discounted small orders.
PREDICATE = "l_discount >= 0.05 AND l_discount <= 0.07 AND l_quantity < 24"


def indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per lineitem row: does it meet the predicate (0/1; a null value does not)."""
    li = lineitem_rid(read_table(spark, sf_dir, "lineitem"))
    return li.select("rid", ag.indicator(F.expr(PREDICATE)).alias("inside"))


def indicator_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of lineitem rows that meet the predicate, in one pass."""
    return ag.indicator_ratio(read_table(spark, sf_dir, "lineitem"), F.expr(PREDICATE), 1.0, "ratio")


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.row_count(read_table(spark, sf_dir, "lineitem"))


def mean_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    out = ag.mean_by_key(events, "event_type", "value")
    return out.select("event_type", F.round("mean_value", 6).alias("mean_value"))


def threshold_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents at least as long as the mean, the mean as a scalar subquery."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    t = docs.agg(F.avg("n_chars").alias("t"))
    return ag.threshold_filter(docs, t, "n_chars")


def basic_oracles() -> dict[str, str]:
    inside = f"CASE WHEN {PREDICATE} THEN 1 ELSE 0 END"
    return {
        "csv_scan": "SELECT * FROM customer",
        "csv_quarantine": """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'long' WHEN c_custkey % 11 = 0 THEN 'short'
  WHEN c_custkey % 13 = 0 THEN 'mistyped:c_acctbal' ELSE 'ok' END AS reason FROM customer""",
        "head_n": "SELECT * FROM customer ORDER BY c_custkey LIMIT 5",
        "row_as_map": "SELECT CAST(to_json(nation) AS VARCHAR) AS row_json FROM nation",
        "keep_columns": "SELECT c_custkey, c_name FROM customer",
        "indicator": f"SELECT {RID_SQL} AS rid, {inside} AS inside FROM lineitem",
        "indicator_ratio": f"SELECT CAST(sum({inside}) AS DOUBLE) / count(*) AS ratio FROM lineitem",
        "row_count": "SELECT count(*) AS n_rows FROM lineitem",
        "mean_by_key": "SELECT event_type, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type",
    }
