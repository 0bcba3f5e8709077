"""Mixing sources to target weights by systematic sampling (native DataFrame operations only).

Every document of a source is expected ``rate = target / source size`` times.
The documents of a source are put in a fixed order, the expected copies are
summed up along it, one random offset per source is added, and a document is
emitted once for each integer boundary its step crosses.  The order is by size
(bands of sizes that differ by an eighth at most), so over- and under-counts of
neighbours cancel and the taken words stay near the target.

The position of a document in its source comes from two levels: counts per
(source, size band, hash slice) are summed along the source, and only within
such a group rows are numbered.  A source with a third of all rows is thus
spread over all its groups; the per-source window runs over at most
``bands x slices`` counts.  Capped targets come from repeated global sums, so
sources are never gathered in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvan.llm.common import hash_uniform, materialize, table, word_count

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL = 1.5
MAX_COPIES = 2.0
SLICES = 64
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: float = MAX_COPIES) -> DataFrame:
    """``(source, n, source_size, target)`` for sized rows ``(source, size)``.

    Sources in code point order, null last, weigh ``weights`` repeating and
    share ``total`` times all sizes by weight; a target stops at ``cap`` times
    its source's size and the excess is shared again by weight until none is
    above.  Sources are ranked by a range partitioning written to the shared
    folder and per-partition counts.
    """
    order = [F.col("source").asc_nulls_last()]
    ranged = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
              .repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    ranged = materialize(ranged, "mix-sources")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = ranged.join(before, "_part").select("source", "source_size", weight.alias("weight"))

    # The share per unit of weight rises until no further source reaches its cap.
    share, capped_before = 0.0, -1
    all_words = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget = total * all_words
    while True:
        full = cap * F.col("source_size") <= F.lit(share) * F.col("weight")
        capped, n_capped, open_weight = ranked.agg(
            F.sum(F.when(full, F.col("source_size") * cap).otherwise(0.0)), F.count(F.when(full, 1)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n_capped == capped_before or not open_weight:
            break
        capped_before, share = n_capped, (budget - capped) / open_weight
    target = F.least(F.col("source_size") * cap, F.lit(share) * F.col("weight"))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def size_band(size):
    """Size with its last binary digits cut: eight bands to a doubling."""
    bits = F.length(F.bin(size))
    return F.when(bits <= 4, size).otherwise(bits * 8 + F.expr("shiftright(size, cast(greatest(length(bin(size)) - 4, 0) as int))"))


def mix(rows: DataFrame, seed: str = SEED, weights=WEIGHTS, total: float = TOTAL, cap: float = MAX_COPIES,
        slices: int = SLICES, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows ``(id, *keep, source, size)`` with ``source_size``, ``target``, ``copies`` and ``taken``.

    One output row per input row, rows with 0 copies included.  ``copies`` is
    at most ``cap`` rounded up.  Reruns agree: order and offset are hashes of
    id, source and seed; rows that repeat an id are interchangeable.  Null
    sources are one source of their own; null ids are ordinary ids; size 0
    takes nothing; an empty table gives none.
    """
    rows = rows.select(id_col, *keep, "source", F.col("size").cast("long").alias("size"))
    rows = rows.withColumn("band", size_band(F.col("size")).cast("int")).withColumn("u", hash_uniform(seed, F.col(id_col)))
    rows = materialize(rows.withColumn("slice", F.floor(F.col("u") * slices).cast("int")), "mix-sizes")
    targets = source_targets(rows, weights, total, cap)
    counts = rows.groupBy("source", "band", "slice").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("source").orderBy("band", "slice")
    groups = counts.withColumn("before", F.sum("n").over(along) - F.col("n")).drop("n")
    same = groups.join(targets, groups["source"].eqNullSafe(targets["source"])).select(
        groups["source"], "band", "slice", "before", "source_size", "target",
        hash_uniform(f"{seed}|offset", groups["source"]).alias("offset"))
    joined = rows.alias("r").join(
        same.alias("g"),
        F.col("r.source").eqNullSafe(F.col("g.source")) & (F.col("r.band") == F.col("g.band"))
        & (F.col("r.slice") == F.col("g.slice"))).select("r.*", "before", "source_size", "target", "offset")
    inside = Window.partitionBy("source", "band", "slice").orderBy("size", "u", F.col(id_col).asc_nulls_last())
    rank = F.col("before") + F.row_number().over(inside)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    steps = joined.withColumn("rank", rank).withColumn("rate", rate)
    crossed = F.floor(F.col("rate") * F.col("rank") + F.col("offset")) - F.floor(F.col("rate") * (F.col("rank") - 1) + F.col("offset"))
    return steps.withColumn("copies", F.least(crossed, F.ceil("rate")).cast("long")).select(
        id_col, *keep, "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def take_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every row as often as the mix takes it, with its columns.

    Rows are matched with their copies by 128 bits of id, text and source; rows
    alike in all three share their copies evenly.
    """
    key = ["doc_id", "text", "source"]
    keyed = docs.withColumns({"_k1": F.xxhash64(*key), "_k2": F.xxhash64(F.lit(1), *key)})
    taken = mix(keyed.select("doc_id", "_k1", "_k2", "source", word_count(F.col("text")).alias("size")), keep=("_k1", "_k2"))
    taken = taken.groupBy("_k1", "_k2").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    alike = Window.partitionBy("_k1", "_k2").orderBy("_k1")
    out = keyed.join(taken.filter("_copies > 0"), ["_k1", "_k2"]).withColumn("_k", F.row_number().over(alike))
    share = F.floor(F.col("_copies") * F.col("_k") / F.col("_rows")) - F.floor(F.col("_copies") * (F.col("_k") - 1) / F.col("_rows"))
    out = out.withColumn("_n", share.cast("int")).filter("_n > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM sized GROUP BY source
), filled AS (
  -- sources in the order in which a rising share per weight meets their caps
  SELECT *, sum(2.0::DOUBLE * source_size) OVER w AS caps, sum(weight) OVER w AS used,
         sum(weight) OVER () AS weights, 1.5::DOUBLE * sum(source_size) OVER () AS budget
  FROM src WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST)
), level AS (
  SELECT coalesce(max((budget - caps) / (weights - used)) FILTER (
           WHERE weights > used AND 2.0::DOUBLE * source_size / weight <= (budget - caps) / (weights - used)),
         max(budget / weights)) AS share FROM filled
), target AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, share * weight) AS target,
    CAST('0x' || substr(md5(concat_ws('|', 'mix-1|offset', coalesce(source, chr(0) || 'null'))), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS off
  FROM src, level
), keyed AS (
  SELECT *, CAST('0x' || substr(md5(concat_ws('|', 'mix-1', coalesce(CAST(doc_id AS VARCHAR), chr(0) || 'null'))), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u,
    CASE WHEN length(bin(size)) <= 4 THEN size ELSE length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 4, 0)) END AS band
  FROM sized
), ranked AS (
  SELECT doc_id, size, source, row_number() OVER (PARTITION BY source
    ORDER BY band, CAST(floor(u * 64) AS INTEGER), size, u, doc_id NULLS LAST) AS k FROM keyed
), steps AS (
  SELECT doc_id, size, source_size, target, off, k,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate
  FROM ranked JOIN target ON ranked.source IS NOT DISTINCT FROM target.source
)
SELECT doc_id, size, source_size, target, copies, CAST(copies * size AS BIGINT) AS taken
FROM (SELECT *, CAST(least(floor(rate * k + off) - floor(rate * (k - 1) + off), ceil(rate)) AS BIGINT) AS copies FROM steps) AS s
"""

QUERIES = {"op5_mixing": op5_mixing}
ORACLES = {"op5_mixing": ORACLE}
