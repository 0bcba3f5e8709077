"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

1. Every whole text is encoded by both tokenizers.  A batch is a run of documents laid
   end to end: a token's start is its document's first byte there plus its own, so a
   document owns a range of positions and ``pandas.merge_asof`` on them is keyed by
   document.  One direction finds for each A token the B token that covers its start,
   the other the A token for each B token; both together are all overlapping pairs, and
   a pair with equal starts, found twice, is taken once.  Where an A and a B token end
   together, a group ends.
2. The documents' counts, group digests and distinct linked pairs (id pair and how often)
   are written to the shared folder.  In how many documents a pair is linked is one
   pre-aggregated count over these; the highest count of each A id is an aggregate of it.
3. Each document's sums need the counts of its pairs.  The most frequent pairs go to all
   tasks: those linked in at least ``2 ** b`` documents, the least ``b`` for which there
   are at most ``HOT_PAIRS`` of them.  All other pairs are rare by that; they are joined
   by a shuffle and summed per document.  Either way every link is looked up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm.bestfit import ByteEncoder
from sylvan.llm.common import bounded_batches, by_value, table
from sylvan.session import scratch_path

by_value(__name__)

#: Id pairs whose counts are sent to all tasks at most (13 bytes each).
HOT_PAIRS = 1_000_000
#: Text bytes that are aligned at once, about: a batch ends with the document that reaches them.
BATCH_BYTES = 1 << 20
#: An id pair is the number ``A id << B_BITS | B id``; both vocabularies fit 31 bits together.
B_BITS = 15

DOC_SCHEMA = ("{id} {id_type}, doc_row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pairs array<int>, times array<int>")


class PieceEncoder:
    """Ids of texts by a sentencepiece model, and the bytes of each id."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode("utf-8")

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text)


def covering(start: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For each start the place of the other side's token that covers it (both sides tile the same positions)."""
    if not len(start):
        return np.zeros(0, dtype=np.int64)
    left = pd.DataFrame({"start": start})
    right = pd.DataFrame({"start": other, "token": np.arange(len(other))})
    return pd.merge_asof(left, right, on="start")["token"].to_numpy()


def overlaps(start_a: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(a, b)`` of all overlapping tokens of two tilings of the same positions, each pair once."""
    b_of, a_of = covering(start_a, start_b), covering(start_b, start_a)
    later = np.flatnonzero(start_b > start_a[a_of])  # equal starts are in the first direction already
    return np.concatenate([np.arange(len(start_a)), a_of[later]]), np.concatenate([b_of, later])


def _spelled(vocabulary: int, last: str) -> np.ndarray:
    """Decimal ids with a comma, and behind these with the mark that ends their part of a group."""
    return np.array([f"{i}{end}" for end in (",", last) for i in range(vocabulary)], dtype="S")


class Aligner:
    """Aligns batches of documents; one for a task."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteEncoder(a_path), PieceEncoder(b_path)
        self.a_bytes = self.a.bytes()
        self.a_size, self.b_size = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b.bytes))
        self.a_text, self.b_text = _spelled(len(self.a_bytes), "|"), _spelled(len(self.b.bytes), ";")

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both sides; none where the text is null or empty, or the ids do not spell a space and the text."""
        if not text:
            return [], []
        spaced = " " + text
        a, b = self.a.model.encode_ordinary(spaced), self.b.ids(text)
        want = spaced.encode("utf-8")
        same = b"".join([self.a_bytes[i] for i in a]) == want and b"".join([self.b.bytes[i] for i in b]) == want
        return (a, b) if same else ([], [])

    def align(self, texts: list[str | None]) -> dict[str, list]:
        """Columns of ``DOC_SCHEMA`` behind the row number, for each text."""
        both = [self.tokens(t) for t in texts]
        docs = len(both)
        count_a, count_b = (np.array([len(x[side]) for x in both], dtype=np.int64) for side in (0, 1))
        a, b = (np.array([i for x in both for i in x[side]], dtype=np.int64) for side in (0, 1))
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        doc_a = np.repeat(np.arange(docs), count_a)
        at_a, at_b = overlaps(end_a - self.a_size[a], end_b - self.b_size[b])

        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        last_a, last_b = np.append(np.diff(group_a) > 0, True)[:len(a)], np.append(np.diff(group_b) > 0, True)[:len(b)]
        n_groups = np.bincount(doc_a[last_a], minlength=docs)

        # A's part of a group stands behind all of B's earlier groups, B's part behind A's of the same group.
        before_a = np.searchsorted(group_b, group_a)
        before_b = np.searchsorted(group_a, group_b, side="right")
        spelled = np.empty(len(a) + len(b), dtype=max(self.a_text.dtype, self.b_text.dtype))
        spelled[np.arange(len(a)) + before_a] = self.a_text[a + len(self.a_bytes) * last_a]
        spelled[np.arange(len(b)) + before_b] = self.b_text[b + len(self.b.bytes) * last_b]
        cut = np.concatenate([[0], np.cumsum(count_a + count_b)])
        digests = [hashlib.sha256(spelled[s:e].tobytes().replace(b"\x00", b"")[:-1]).hexdigest() if e > s else ""
                   for s, e in zip(cut[:-1], cut[1:])]

        pair = a[at_a] << B_BITS | b[at_b]
        linked, times = np.unique(doc_a[at_a] << 32 | pair, return_counts=True)
        n_links = np.bincount(doc_a[at_a], minlength=docs)
        place = np.concatenate([[0], np.cumsum(np.bincount(linked >> 32, minlength=docs))]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(place), pa.array(values.astype(np.int32)))
                 for values in (linked & 0xFFFFFFFF, times)]
        return {"n_a": count_a, "n_b": count_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": digests,
                "pairs": lists[0], "times": lists[1]}


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its counts, the digest of its groups, its distinct linked pairs and how often each."""
    schema = DOC_SCHEMA.format(id=f"`{id_col}`", id_type=docs.schema[id_col].dataType.simpleString())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1).fill_null("")).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < batch.num_rows:
                done = sizes[at - 1] if at else 0
                n = int(np.searchsorted(sizes, done + BATCH_BYTES)) + 1 - at
                part = batch.slice(at, n)
                columns = aligner.align(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(row + np.arange(part.num_rows))]
                    + [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], [id_col, "doc_row", *columns])
                row += part.num_rows
                at += part.num_rows

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(rows, schema)


def hot_bits(counts: DataFrame, hot_pairs: int) -> int:
    """The least ``b`` for which at most ``hot_pairs`` pairs are linked in ``2 ** b`` documents or more."""
    bits = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("bits")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    total, least = 0, 64
    for row in sorted(bits, key=lambda r: -r["bits"]):
        total += row["pairs"]
        if total > hot_pairs:
            break
        least = row["bits"]
    return least


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per document: tokens, groups and links of both sides, and the corpus counts of its links.

    Null and empty texts, and texts that the tokenizers do not spell again byte for
    byte, have zeros and an empty digest.  Null and repeated ids are carried along;
    each input row is its own document.  Ties for an A id's highest count all count as
    best.  An empty table gives no rows; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    each = written(aligned(docs, a_path, b_path, id_col, text_col), "aligned")
    linked = each.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counted = written(linked, "pair-counts").withColumn("a", F.shiftright("pair", B_BITS))
    highest = counted.groupBy("a").agg(F.max("n").alias("most"))  # one row for each id of a vocabulary
    counts = written(counted.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")

    bits = hot_bits(counts, hot_pairs)
    hot = F.floor(F.log2("n")) >= F.lit(bits)
    top = counts.filter(hot).toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast(tuple(top[c].to_numpy() for c in ("pair", "n", "best")))
    names = [id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (DOC_SCHEMA.format(id=f"`{id_col}`", id_type=id_type) + ", hot_best long, hot_sum long")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(part.schema.get_field_index("pairs"))
                times = part.column(part.schema.get_field_index("times")).flatten().to_numpy().astype(np.int64)
                wanted = lists.flatten().to_numpy()
                doc = np.repeat(np.arange(part.num_rows), np.array(lists.value_lengths()))
                place = np.minimum(np.searchsorted(pair, wanted), max(len(pair) - 1, 0))
                found = pair[place] == wanted if len(pair) else np.zeros(len(wanted), dtype=bool)
                sums = [np.zeros(part.num_rows, dtype=np.int64) for _ in range(2)]
                np.add.at(sums[0], doc[found], times[found] * best[place[found]])
                np.add.at(sums[1], doc[found], times[found] * n[place[found]])
                left = np.concatenate([[0], np.cumsum(np.bincount(doc[~found], minlength=part.num_rows))]).astype(np.int32)
                rest = [pa.ListArray.from_arrays(pa.array(left), pa.array(v[~found].astype(np.int32))) for v in (wanted, times)]
                columns = [part.column(i) for i in range(part.num_columns - 2)] + rest + [pa.array(s) for s in sums]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "hot_best", "hot_sum"])

    looked = written(each.mapInArrow(look_up, schema), "aligned-hot")
    rare = looked.select("doc_row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "doc_row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    per_doc = rare.join(counts.filter(~hot), "pair").groupBy("doc_row").agg(
        F.sum(F.col("times") * F.col("best").cast("int")).alias("rare_best"), F.sum(F.col("times") * F.col("n")).alias("rare_sum"))
    none = F.lit(0).cast("long")
    return looked.drop("pairs", "times").join(per_doc, "doc_row", "left").select(
        *[F.col(f"`{c}`") for c in names[:-1]],
        (F.col("hot_best") + F.coalesce("rare_best", none)).alias("n_best"),
        (F.col("hot_sum") + F.coalesce("rare_sum", none)).alias("count_sum"), "groups_sha256")


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), *tokenizer_files())


QUERIES = {"op12_alignment": op12_alignment}
ORACLES: dict[str, str] = {}
