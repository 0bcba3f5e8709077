"""Interpolated modified Kneser-Ney language model, counted in Spark and scored from memory-mapped arrays.

The model predicts each token from the one before it (the first from a start
mark).  Counting has three passes, each pre-aggregated in its tasks and dealt out by hash
ranges as packed arrays:

1. token counts, which also name the frequent tokens (more than a thousandth of
   all, so a thousand at most);
2. pairs (context, token), dealt out by context; the pairs of a frequent context
   are dealt out by token instead, so no context is one task's work;
3. continuation counts: in how many different contexts a token turns up.

Each range writes its sorted hashes and counts as plain arrays to the shared
folder (under a temporary name first, so a repeated task replaces equal files).
Scoring tasks map these files and look up each batch's tokens by binary search
in sorted order; their memory does not grow with the model.  Nothing but counts
of counts, frequent contexts and totals goes through the driver.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm.common import bounded_batches, by_value, materialize, table
from sylvan.llm.words import mix, text_bytes, word_hashes
from sylvan.session import scratch_path

by_value(__name__)

START, END = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A99)
#: Tokens that a task packs at once; bytes of text for each hash range.
BATCH = 4_000_000
RANGE_BYTES = 24_000_000
#: A token with more than this share of all is frequent.
FREQUENT = 0.001


def pair_keys(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(0xD6E8FEB86659FD93) + token * np.uint64(0xA0761D6478BD642F))


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Hash range of each key; rising with the key."""
    return ((keys >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)


def pair_range(context: np.ndarray, token: np.ndarray, frequent: np.ndarray, ranges: int) -> np.ndarray:
    return range_of(np.where(np.isin(context, frequent), mix(token), context), ranges)


class Store:
    """Arrays in the shared folder: mapped where the folder is mounted, else read through its file system."""

    def __init__(self, folder: str):
        self.fs, self.base = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
        self.local = isinstance(self.fs, pafs.LocalFileSystem)

    def write(self, name: str, array: np.ndarray) -> None:
        self.fs.create_dir(self.base, recursive=True)
        held = io.BytesIO()
        np.save(held, array)
        part = f"{self.base}/.{name}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(part) as out:
            out.write(held.getbuffer())
        self.fs.move(part, f"{self.base}/{name}.npy")

    def read(self, name: str) -> np.ndarray:
        path = f"{self.base}/{name}.npy"
        if self.local:
            return np.load(path, mmap_mode="r")
        with self.fs.open_input_stream(path) as given:
            return np.load(io.BytesIO(given.read()))


def _tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens (words, then the end) of runs of texts, and their offsets."""
    raw, bounds = text_bytes(column)
    for lo in range(0, len(column), 1024):
        hashes, at = word_hashes(raw, bounds[lo: lo + 1025])
        n = len(at) - 1
        yield np.insert(hashes, at[1:], END), at + np.arange(n + 1)


def contexts(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[at[:-1]] = START
    return before


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _expand(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


_PACKED = "bucket int, size long, data binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows], pa.binary())], ["bucket", "size", "data"])


def _unique(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _token_counts(texts: DataFrame, ranges: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(range_of(keys, ranges), np.arange(ranges + 1, dtype=np.uint64))
            return _batch([(k, b - a, _squeeze(keys[a:b], counts[a:b].astype(np.int64)))
                           for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a])

        for batch in batches:
            for tokens, _ in _tokens(batch.column(0)):
                held.append(tokens)
                total += len(tokens)
                if total >= BATCH:
                    yield flush()
                    held, total = [], 0
        if held:
            yield flush()

    return texts.mapInArrow(rows, _PACKED)


def _counted(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [], []
    for n, blob in zip(group.column("size").to_pylist(), group.column("data").to_pylist()):
        raw = _expand(blob)
        keys.append(np.frombuffer(raw, np.uint64, n))
        counts.append(np.frombuffer(raw, np.int64, n, 8 * n))
    return _unique(np.concatenate(keys), np.concatenate(counts))


def _pairs(texts: DataFrame, ranges: int, frequent: np.ndarray) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, after, total = [], [], 0

        def flush() -> pa.RecordBatch:
            v, w = np.concatenate(before), np.concatenate(after)
            order = np.lexsort((w, v))
            v, w = v[order], w[order]
            first = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (w[1:] != w[:-1]))))
            n = np.diff(np.append(first, len(v)))
            v, w = v[first], w[first]
            bucket = pair_range(v, w, frequent, ranges)
            order = np.argsort(bucket, kind="stable")
            v, w, n = v[order], w[order], n[order].astype(np.uint32)
            cuts = np.searchsorted(bucket[order], np.arange(ranges + 1, dtype=np.uint64))
            out = []
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if b > a:
                    steps = v[a:b].copy()
                    steps[1:] -= v[a:b - 1]  # contexts rise, so most steps are 0
                    out.append((k, b - a, _squeeze(steps, w[a:b], n[a:b])))
            return _batch(out)

        for batch in batches:
            for tokens, at in _tokens(batch.column(0)):
                before.append(contexts(tokens, at))
                after.append(tokens)
                total += len(tokens)
                if total >= BATCH:
                    yield flush()
                    before, after, total = [], [], 0
        if after:
            yield flush()

    return texts.mapInArrow(rows, _PACKED)


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What is taken from counts of 1, 2 and 3 or more."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    found = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(d, 0.05 * (k + 1)), k + 0.95) for k, d in enumerate(found))


@dataclass
class Model:
    """Where the arrays are, and the totals; ``frequent`` has at most 1 / FREQUENT + 1 contexts."""

    folder: str
    ranges: int
    n_tokens: int = 0
    n_types: int = 0
    n_pairs: int = 0
    pair_discounts: tuple = (0.5, 1.0, 1.5)
    token_discounts: tuple = (0.5, 1.0, 1.5)
    token_classes: tuple = (0, 0, 0)
    frequent: dict = field(default_factory=dict)


def train(texts: DataFrame) -> Model:
    """Count the rows of a one-column table of texts (null: empty) into a model in the shared folder.

    Repeated rows count each.  Without rows the model is empty and every token
    is unknown to it.
    """
    spark = texts.sparkSession
    bounded_batches(spark)
    size = texts.agg(F.sum(F.octet_length(F.col(texts.columns[0])))).first()[0] or 0
    ranges = max(24, int(size // RANGE_BYTES))
    folder = scratch_path(spark, "lm")

    def tokens_of(group: pa.Table) -> pa.Table:
        keys, counts = _counted(group)
        k = group.column("bucket")[0].as_py()
        store = Store(folder)
        store.write(f"token-{k}", keys)
        store.write(f"count-{k}", counts.astype(np.uint64))
        top = np.argsort(-counts, kind="stable")[: int(1 / FREQUENT) + 1]
        return pa.table({"n": pa.array([int(counts.sum())] + [0] * len(top), pa.int64()), "types": pa.array([len(keys)] + [0] * len(top), pa.int64()),
                         "token": pa.array([None] + keys[top].view(np.int64).tolist(), pa.int64()),
                         "c": pa.array([0] + counts[top].tolist(), pa.int64())})

    told = materialize(_token_counts(texts, ranges).groupBy("bucket").applyInArrow(tokens_of, "n long, types long, token long, c long"), "lm-tokens")
    n, types = told.agg(F.sum("n"), F.sum("types")).first()
    if not n:
        return Model(folder, ranges)
    hot = [r[0] for r in told.filter((F.col("token").isNotNull()) & (F.col("c") > FREQUENT * n)).select("token").collect()]
    frequent = np.unique(np.append(np.array(hot, dtype=np.int64).view(np.uint64), START))

    def pairs_of(group: pa.Table) -> pa.Table:
        vs, ws, ns = [], [], []
        for m, blob in zip(group.column("size").to_pylist(), group.column("data").to_pylist()):
            raw = _expand(blob)
            vs.append(np.cumsum(np.frombuffer(raw, np.uint64, m), dtype=np.uint64))
            ws.append(np.frombuffer(raw, np.uint64, m, 8 * m))
            ns.append(np.frombuffer(raw, np.uint32, m, 16 * m))
        v, w, c = np.concatenate(vs), np.concatenate(ws), np.concatenate(ns).astype(np.int64)
        order = np.lexsort((w, v))
        v, w, c = v[order], w[order], c[order]
        first = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (w[1:] != w[:-1]))))
        v, w, c = v[first], w[first], np.add.reduceat(c, first)
        k = group.column("bucket")[0].as_py()
        store = Store(folder)
        keys = pair_keys(v, w)
        order = np.argsort(keys)
        kept = c[order]
        large = np.flatnonzero(kept >= 255)
        store.write(f"pair-{k}", keys[order])
        store.write(f"paircount-{k}", np.minimum(kept, 255).astype(np.uint8))
        store.write(f"pairlarge-{k}", np.stack([large, kept[large]]).astype(np.int64))
        # Contexts: their total and how many of their pairs were seen once, twice, more often.
        first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
        stats = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (c, c == 1, c == 2, c >= 3)])
        ctx = v[first]
        hot = np.isin(ctx, frequent)
        store.write(f"context-{k}", ctx[~hot])
        store.write(f"contextstats-{k}", np.ascontiguousarray(stats[:, ~hot].T))
        # Continuations: one for each different pair.
        token, contexts_of = np.unique(w, return_counts=True)
        cuts = np.searchsorted(range_of(token, ranges), np.arange(ranges + 1, dtype=np.uint64))
        rows = [("continuation", j, int(b - a), _squeeze(token[a:b], contexts_of[a:b].astype(np.int64)), [0] * 5)
                for j, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        rows += [("context", 0, int(x), b"", [int(y) for y in stats[:, i]] + [0])
                 for i, x in zip(np.flatnonzero(hot), ctx[hot].view(np.int64))]
        rows.append(("counts", 0, len(v), b"", _counts_of_counts(c) + [0]))
        return pa.Table.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                                     pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary()),
                                     pa.array([r[4] for r in rows], pa.list_(pa.int64()))], names=["kind", "bucket", "size", "data", "stats"])

    told = materialize(_pairs(texts, ranges, frequent).groupBy("bucket").applyInArrow(
        pairs_of, "kind string, bucket int, size long, data binary, stats array<long>"), "lm-pairs")

    def sums(rows: DataFrame, n_stats: int) -> list[Column]:
        return [F.sum(F.col("stats")[j]) for j in range(n_stats)]

    contexts_seen = {r[0]: [int(x) for x in r[1:]] for r in told.filter("kind = 'context'").groupBy("size").agg(*sums(told, 4)).collect()}
    n_pairs, *pair_classes = told.filter("kind = 'counts'").agg(F.sum("size"), *sums(told, 4)).first()

    def continuations_of(group: pa.Table) -> pa.Table:
        keys, counts = _counted(group)
        k = group.column("bucket")[0].as_py()
        store = Store(folder)
        seen = store.read(f"token-{k}")
        full = np.zeros(len(seen), dtype=np.uint64)  # every continued token is a token
        full[np.searchsorted(seen, keys)] = counts
        store.write(f"continuation-{k}", full)
        return pa.table({"stats": pa.array([_counts_of_counts(counts) + [int((counts >= 3).sum())]], pa.list_(pa.int64()))})

    cont = told.filter("kind = 'continuation'").select("bucket", "size", "data")
    told = materialize(cont.groupBy("bucket").applyInArrow(continuations_of, "stats array<long>"), "lm-continuations")
    classes = [int(x or 0) for x in told.agg(*sums(told, 5)).first()]
    return Model(folder, ranges, int(n), int(types), int(n_pairs), discounts(*map(int, pair_classes)), discounts(*classes[:4]),
                 (classes[0], classes[1], classes[4]), contexts_seen)


class Scorer:
    """Looks tokens up in the mapped arrays of a model."""

    def __init__(self, model: Model):
        self.m = model
        self.store = Store(model.folder)
        self.open: dict[str, np.ndarray | None] = {}
        self.hot = np.array(sorted(np.array(list(model.frequent), dtype=np.int64).view(np.uint64)), dtype=np.uint64)
        order = {int(np.array(k, dtype=np.int64).view(np.uint64)): s for k, s in model.frequent.items()}
        self.hot_stats = np.array([order[int(k)] for k in self.hot], dtype=np.int64).reshape(-1, 4)
        d, (one, two, more) = model.token_discounts, model.token_classes
        self.token_rest = (d[0] * one + d[1] * two + d[2] * more) / model.n_pairs if model.n_pairs else 1.0

    def _array(self, name: str) -> np.ndarray | None:
        if name not in self.open:
            try:
                self.open[name] = self.store.read(name)
            except FileNotFoundError:  # a range without rows has no file
                self.open[name] = None
        return self.open[name]

    def _found(self, name: str, k: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Place of each key of range ``k`` (sorted keys) and whether it is there."""
        there = self._array(f"{name}-{k}")
        if there is None or not len(there):
            return None
        at = np.minimum(np.searchsorted(there, keys), len(there) - 1)
        return at, there[at] == keys

    def _each_range(self, ranges: np.ndarray, keys: np.ndarray):
        order = np.lexsort((keys, ranges))
        cuts = np.searchsorted(ranges[order], np.arange(self.m.ranges + 1, dtype=np.uint64))
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                yield k, order[a:b]

    def tokens(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and continuation count of each different token."""
        count, cont = np.zeros(len(keys)), np.zeros(len(keys))
        for k, part in self._each_range(range_of(keys, self.m.ranges), keys):
            found = self._found("token", k, keys[part])
            if found:
                at, ok = found
                count[part] = np.where(ok, self._array(f"count-{k}")[at], 0)
                cont[part] = np.where(ok, self._array(f"continuation-{k}")[at], 0)
        return count, cont

    def stats(self, ctx: np.ndarray) -> np.ndarray:
        """Total and count classes of each different context."""
        out = np.zeros((len(ctx), 4))
        for k, part in self._each_range(range_of(ctx, self.m.ranges), ctx):
            found = self._found("context", k, ctx[part])
            if found:
                at, ok = found
                out[part] = np.where(ok[:, None], self._array(f"contextstats-{k}")[at], 0)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, ctx), len(self.hot) - 1)
            out = np.where((self.hot[at] == ctx)[:, None], self.hot_stats[at], out)
        return out

    def pairs(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        keys = pair_keys(v, w)
        out = np.zeros(len(keys))
        for k, part in self._each_range(pair_range(v, w, self.hot, self.m.ranges), keys):
            found = self._found("pair", k, keys[part])
            if found:
                at, ok = found
                c = self._array(f"paircount-{k}")[at].astype(np.float64)
                large = self._array(f"pairlarge-{k}")
                if large.shape[1]:
                    j = np.minimum(np.searchsorted(large[0], at), large.shape[1] - 1)
                    c = np.where(large[0][j] == at, large[1][j], c)
                out[part] = np.where(ok, c, 0)
        return out

    def score(self, tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Base score, model score (log10) and known tokens of each text."""
        m = self.m
        v = contexts(tokens, at)
        types, place = np.unique(tokens, return_inverse=True)
        count, cont = self.tokens(types)
        base = np.log10((count + 0.5) / (m.n_tokens + 0.5 * (m.n_types + 1)))[place]
        take = np.array((0.0, *m.token_discounts))[np.minimum(cont, 3).astype(int)]
        low = (cont - take) / max(m.n_pairs, 1) + self.token_rest / (m.n_types + 1)
        ctx, ctx_place = np.unique(v, return_inverse=True)
        total, one, two, more = self.stats(ctx).T
        d = m.pair_discounts
        rest = np.where(total > 0, (d[0] * one + d[1] * two + d[2] * more) / np.maximum(total, 1), 1.0)
        c = self.pairs(v, tokens)
        take = np.array((0.0, *d))[np.minimum(c, 3).astype(int)]
        p = (c - take) / np.maximum(total, 1)[ctx_place] + rest[ctx_place] * low[place]
        first = at[:-1]
        return (np.add.reduceat(base, first), np.add.reduceat(np.log10(p), first), np.add.reduceat((count > 0)[place].astype(np.int64), first))


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``lm_tokens``, ``lm_known``, ``lm_base`` and ``lm_score``.

    Null and empty texts are the end alone.  Unknown tokens share the mass that
    discounting leaves them.  Rows that repeat score alike; an empty table gives
    none; input columns named like an output are replaced.
    """
    bounded_batches(docs.sparkSession)
    kind = "struct<tokens: long, known: long, base: double, score: double>"

    @F.arrow_udf(kind)
    def scored(texts: pa.Array) -> pa.Array:
        scorer = scored.__dict__.get("scorer")
        if scorer is None:
            scorer = scored.__dict__["scorer"] = Scorer(model)
        n, known, base, score = [], [], [], []
        for tokens, at in _tokens(texts):
            b, s, k = scorer.score(tokens, at)
            n.append(np.diff(at))
            known.append(k)
            base.append(b)
            score.append(s)
        joined = [np.concatenate(x) if x else np.empty(0) for x in (n, known, base, score)]
        columns = [pa.array(joined[0].astype(np.int64)), pa.array(joined[1].astype(np.int64)), pa.array(joined[2]), pa.array(joined[3])]
        return pa.StructArray.from_arrays(columns, ["tokens", "known", "base", "score"])

    rows = docs.withColumn("_lm", scored(F.col(text_col)))
    return rows.withColumns({"lm_tokens": F.col("_lm.tokens"), "lm_known": F.col("_lm.known"), "lm_base": F.col("_lm.base"),
                             "lm_score": F.col("_lm.score")}).drop("_lm")


def held_out(id_col: Column) -> Column:
    """Rows that are not learned from; rows without an id are."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 1, F.lit(False))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs.filter(~held_out(F.col("doc_id"))).select("text"))
    return score_texts(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("lm_tokens").alias("n_tokens"), F.col("lm_known").alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), F.col("lm_base").alias("base_score"), F.col("lm_score").alias("score"),
        F.pow(F.lit(10.0), -F.col("lm_score") / F.col("lm_tokens")).alias("perplexity"))


QUERIES = {"op10_lm": op10_lm}
ORACLES: dict[str, str] = {}
