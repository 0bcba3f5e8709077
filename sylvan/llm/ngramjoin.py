"""Exact Jaccard self-join of word-shingle sets with set-relation skipping.

Equal sets are one class, known by a 128-bit signature; all work is on classes.

1. *Document frequencies.*  Tasks send their shingle hashes, packed as arrays,
   to hash ranges.  A hash that many sets of one batch share is sent once and
   marked frequent, so a shingle of a third of all texts costs a range one entry a
   batch.  Hashes of a single class never match and go no further.
2. *Index.*  Hashes go back to their class, rarest first.  A class with fewer
   shared hashes than the threshold asks of it cannot have a partner and is
   dropped.  Of the others, the prefix that every partner must meet is indexed.
3. *Answers from similar sets.*  Classes that share a min-hash are compared with
   one pivot of their list, a star rather than all pairs, and components are
   formed.  An index list whose members are connected needs no comparison.  In
   the others, each member is compared with the pivot of each larger component of
   the list.  Pivots are the sets that share most of their hashes.  For members that this does not connect, the distances to the
   pivot bound the distance of two members (triangle inequality of the Jaccard
   distance): pairs that the bound separates are skipped.
4. *Block skipping.*  Of the pairs that are left, those are compared exactly
   whose sizes and places of the hash in both sets leave enough overlap.

Links are exact: every pair at or above the threshold is compared or connected.
Components come from the links; a document's component is the smallest id in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylvan.llm.common import bounded_batches, by_value, materialize, table, word_count
from sylvan.llm.components import connected_components
from sylvan.llm.memory import released, released_group
from sylvan.llm.words import mix, shingle_set, text_bytes, word_hashes

by_value(__name__)

WIDTH = 5
#: Link if 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Shingles that a task packs at once, and that one hash range holds on average.
BATCH = 600_000
RANGE = 1_000_000
#: A hash in so many sets of one batch is frequent: it sorts last and is sent once.
FREQUENT = 16
LAST = 65535
#: Min-hashes of a class by which it meets its first pivots.
SKETCHES = 6


def _signature(s: np.ndarray) -> bytes:
    """128 bits of a sorted set of hashes."""
    one = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(one).to_bytes(8, "little") + int(two).to_bytes(8, "little")


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    raw, bounds = text_bytes(column)
    for lo in range(0, len(column), 256):
        part = bounds[lo: lo + 257]
        hashes, at = word_hashes(raw, part)
        for a, b in zip(at[:-1], at[1:]):
            yield shingle_set(hashes[a:b], width)


def shingle_classes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(id, k1, k2, n, sig)`` of rows ``(id, k1, k2, text)``: set size and signature (null for empty sets)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sig = [], []
            for s in _sets(batch.column(3), width):
                n.append(len(s))
                sig.append(_signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(sig, pa.binary())], ["id", "k1", "k2", "n", "sig"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "k1", "k2", "text").mapInArrow(released(rows), f"id {kind}, k1 long, k2 long, n long, sig binary")


_PACKED = "bucket int, direct boolean, h binary, d binary, marked binary, sig binary, n binary"


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte place, compressed."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _expand(blob: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind)[:, 0]


def _steps(h: np.ndarray) -> np.ndarray:
    """Differences of rising hashes; their sum gives them back."""
    out = h.copy()
    out[1:] -= h[:-1]
    return out


def _pack_row(bucket, direct, h, d, marked, sig, n):
    """A row of rising hashes ``h``, the places ``d`` of their classes in ``sig``, and places or weights ``marked``."""
    return (int(bucket), bool(direct), _squeeze(_steps(h)), _squeeze(d.astype(np.uint32)), _squeeze(marked), sig, n)


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int32(), pa.bool_()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "direct", "h", "d", "marked", "sig", "n"])


def _postings(docs: DataFrame, text_col: str, ranges: int, width: int) -> DataFrame:
    """Packed postings (hash, class) by hash range."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = TaskContext.get().partitionId() * 7919
        held: dict[bytes, np.ndarray] = {}
        total = turn = 0

        def flush() -> pa.RecordBatch:
            nonlocal turn
            turn += 1
            sets = list(held.values())
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            sig, n = np.frombuffer(b"".join(held), dtype="V16"), sizes.astype(np.uint32)
            h = np.concatenate(sets)
            order = np.argsort(h)
            h, d = h[order], np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)[order]
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            runs = np.diff(np.append(first, len(h)))
            frequent = np.repeat(runs >= FREQUENT, runs)
            out = []
            if frequent.any():
                used, local = np.unique(d[frequent], return_inverse=True)
                out.append(_pack_row((spread + turn) % ranges, True, h[frequent], local, first[:0].astype(np.uint32), sig[used].tobytes(), n[used].tobytes()))
            send = ~frequent
            send[first] = True
            mark = frequent[send]
            h, d = h[send], d[send]
            bucket = ((h >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)
            cuts = np.searchsorted(bucket, np.arange(ranges + 1, dtype=np.uint64))
            for k in range(ranges):
                a, b = cuts[k], cuts[k + 1]
                if b > a:
                    used, local = np.unique(d[a:b], return_inverse=True)
                    out.append(_pack_row(k, False, h[a:b], local, np.flatnonzero(mark[a:b]).astype(np.uint32), sig[used].tobytes(), n[used].tobytes()))
            return _packed_batch(out)

        for batch in batches:
            for s in _sets(batch.column(0), width):
                if not len(s):
                    continue
                key = _signature(s)
                if key not in held:
                    held[key] = s
                    total += len(s)
                if total >= BATCH:
                    yield flush()
                    held, total = {}, 0
        if held:
            yield flush()

    return docs.select(text_col).mapInArrow(released(rows), _PACKED)


def _unpack(group: pa.Table, k: int, marks=np.uint32):
    row = {c: group.column(c)[k].as_py() for c in ("h", "d", "marked", "sig", "n")}
    return (np.cumsum(_expand(row["h"], np.uint64), dtype=np.uint64), _expand(row["d"], np.uint32), _expand(row["marked"], marks),
            np.frombuffer(row["sig"], dtype="V16"), np.frombuffer(row["n"], dtype=np.uint32))


def _shared(postings: DataFrame, ranges: int) -> DataFrame:
    """Packed postings of hashes that two classes share, with their rank weight, by class range."""
    def reduce(group: pa.Table) -> pa.Table:
        out: list[tuple] = []

        def emit(h, w, d, sig, n):
            home = (np.ascontiguousarray(sig).view(np.uint64)[::2] % np.uint64(ranges)).astype(np.int64)[d]
            order = np.argsort(home, kind="stable")
            home, h, w, d = home[order], h[order], w[order], d[order]
            cuts = np.searchsorted(home, np.arange(ranges + 1))
            for k in range(ranges):
                a, b = cuts[k], cuts[k + 1]
                if b > a:
                    used, local = np.unique(d[a:b], return_inverse=True)
                    out.append(_pack_row(k, False, h[a:b], local, w[a:b].astype(np.uint16), sig[used].tobytes(), n[used].tobytes()))

        hs, ds, marks, sigs, ns, base = [], [], [], [], [], 0
        for k in range(group.num_rows):
            h, d, marked, sig, n = _unpack(group, k)
            if group.column("direct")[k].as_py():
                emit(h, np.full(len(h), LAST, dtype=np.uint16), d.astype(np.int64), sig, n)
                continue
            hs.append(h)
            ds.append((d + np.uint32(base)).astype(np.int32))
            mark = np.zeros(len(h), dtype=bool)
            mark[marked] = True
            marks.append(mark)
            sigs.append(sig)
            ns.append(n)
            base += len(sig)
        if hs:
            h, d, mark = np.concatenate(hs), np.concatenate(ds), np.concatenate(marks)
            sig, n = np.concatenate(sigs), np.concatenate(ns)
            del hs, ds, marks, sigs, ns
            order = np.argsort(h)
            h, d, mark = h[order], d[order], mark[order]
            del order
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            runs = np.diff(np.append(first, len(h)))
            frequent = np.logical_or.reduceat(mark, first)
            keep = np.repeat((runs > 1) | frequent, runs)
            h, d, frequent = h[keep], d[keep], np.repeat(frequent, runs)[keep]
            if len(h):
                low = np.ascontiguousarray(sig).view(np.uint64)[::2][d]
                order = np.lexsort((low, h))
                h, d, low, frequent = h[order], d[order], low[order], frequent[order]
                new_h = np.concatenate(([True], h[1:] != h[:-1]))
                new = new_h | np.concatenate(([True], low[1:] != low[:-1]))
                h, d, frequent, new_h = h[new], d[new], frequent[new], new_h[new]
                first = np.flatnonzero(new_h)
                df = np.diff(np.append(first, len(h)))
                df = np.repeat(df, df)
                w = np.where(frequent, LAST, np.minimum(df, LAST - 1)).astype(np.uint16)
                keep = (df > 1) | frequent
                emit(h[keep], w[keep], d[keep], sig, n)
        if not out:
            return pa.Table.from_batches([_packed_batch([(0, True, b"", b"", b"", b"", b"")])]).slice(0, 0)
        return pa.Table.from_batches([_packed_batch(out)])

    return postings.groupBy("bucket").applyInArrow(released_group(reduce), _PACKED)


def _candidates(shared: DataFrame, percent: int) -> DataFrame:
    """``(cid, sig, n, hs, sketch)``: classes with enough shared hashes, these rarest first, and their min-hashes."""
    names = ["cid", "sig", "n", "hs", "sketch"]

    def gather(group: pa.Table) -> pa.Table:
        index: dict[bytes, int] = {}
        sizes: list[int] = []
        hs, ws, ds = [], [], []
        for k in range(group.num_rows):
            h, d, w, sig, n = _unpack(group, k, np.uint16)
            number = np.empty(len(sig), dtype=np.int64)
            for j, (s, m) in enumerate(zip(sig, n)):
                key = s.tobytes()
                number[j] = index.setdefault(key, len(index))
                if number[j] == len(sizes):
                    sizes.append(int(m))
            hs.append(h)
            ws.append(w)
            ds.append(number[d])
        h, w, d = np.concatenate(hs), np.concatenate(ws), np.concatenate(ds)
        del hs, ws, ds
        n = np.array(sizes, dtype=np.int64)
        # Postings of a class that cannot have enough shared hashes, even with repeats, go before the sort.
        enough = 100 * np.bincount(d, minlength=len(n)) >= percent * n
        keep = enough[d]
        h, w, d = h[keep], w[keep], d[keep]
        order = np.lexsort((h, w, d))
        h, d = h[order], d[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))[: len(h)]
        h, d = h[new], d[new]
        count = np.bincount(d, minlength=len(n))
        enough = 100 * count >= percent * n
        enough &= count > 0
        keep = enough[d]
        kept = np.flatnonzero(enough)
        keys = list(index)
        h, sizes_kept = h[keep], count[kept]
        offsets = np.concatenate(([0], np.cumsum(sizes_kept)))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(h.view(np.int64)))
        seeds = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64))
        least = [np.minimum.reduceat(mix(h ^ seed), offsets[:-1]) + np.uint64(j) if len(kept) else h for j, seed in enumerate(seeds)]
        sketch = np.stack(least, axis=1).view(np.int64) if len(kept) else np.empty((0, SKETCHES), np.int64)
        first = group.column("bucket")[0].as_py() << 40
        return pa.Table.from_arrays([pa.array(first + np.arange(len(kept))), pa.array([keys[k] for k in kept], pa.binary()),
                                     pa.array(n[kept]), lists, pa.array(list(sketch), pa.list_(pa.int64()))], names=names)

    return shared.groupBy("bucket").applyInArrow(released_group(gather), "cid long, sig binary, n long, hs array<long>, sketch array<long>")


def _long_enough(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b, distance, linked)`` of pairs of classes, from their whole sets."""
    one = sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("hs").alias("hb"))
    two = sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("hs").alias("ha"))
    both = pairs.select("a", "b").join(one, "b").join(two, "a").withColumn("common", F.size(F.array_intersect("ha", "hb")))
    union = F.col("na") + F.col("nb") - F.col("common")
    return both.select("a", "b", (1 - F.col("common") / union).alias("distance"), (100 * F.col("common") >= percent * union).alias("linked"))


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _centre() -> Column:
    """Sorts the set first that shares most of its hashes, as the origin of a group of near copies does."""
    return F.struct((-F.size("hs") / F.col("n")).alias("rest"), F.xxhash64("cid").alias("r"), F.col("cid"), F.col("n"))


def _labelled(sets: DataFrame, label: DataFrame) -> DataFrame:
    """Sets with the label of their component (their own id without links), its size and its pivot."""
    found = sets.join(label.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    sizes = found.groupBy("label").agg(F.count(F.lit(1)).alias("members"), F.min(_centre())["cid"].alias("pivot"))
    return found.join(sizes, "label")


def _entries(sets: DataFrame, percent: int) -> DataFrame:
    """Index entries of labelled sets: the prefix that every partner must meet, with each hash's place in its set."""
    need = F.ceil(F.col("n") * percent / 100)
    skipped = F.col("n") - F.size("hs")
    prefix = F.slice("hs", F.lit(1), (F.size("hs") - need + 1).cast("int"))
    kept = ["cid", "n", "label", "members", "pivot", "skipped"]
    return sets.withColumn("skipped", skipped).select(*kept, F.posexplode(prefix).alias("i", "h")).select(
        *kept, "h", (F.col("skipped") + F.col("i")).alias("place"))


def _open_entries(sets: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Entries of the lists whose members are not all connected."""
    entries = _entries(_labelled(sets, label), percent)
    lists = entries.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("h")
    return materialize(entries.join(lists, "h"), "join-open")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between classes whose components are those of all links."""
    # Stars around one pivot of each min-hash.
    met = sets.select("cid", "n", _centre().alias("c"), F.explode("sketch").alias("k"))
    pivots = met.groupBy("k").agg(F.min("c").alias("p"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    pairs = met.join(pivots, "k").filter((F.col("cid") != F.col("p.cid")) & _long_enough(F.col("n"), F.col("p.n"), percent))
    pairs = pairs.select(*_pair(F.col("cid"), F.col("p.cid"))).distinct()
    compared = materialize(_compare(pairs, sets, percent), "join-stars")
    links = compared.filter("linked").select("a", "b")
    label = materialize(connected_components(links), "join-labels")

    # In open lists, each member and the pivot of each larger component.
    open_ = _open_entries(sets, label, percent)
    groups = open_.filter("members > 1").select("h", "label", "members", "pivot").distinct()
    x, y = open_.alias("x"), groups.alias("y")
    larger = (F.col("y.members") > F.col("x.members")) | ((F.col("y.members") == F.col("x.members")) & (F.col("y.label") < F.col("x.label")))
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.label") != F.col("y.label")) & larger).select(
        *_pair(F.col("x.cid"), F.col("y.pivot"))).distinct()
    pairs = pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti")
    found = materialize(_compare(pairs, sets, percent), "join-pivots")
    compared = compared.unionByName(found)
    links = compared.filter("linked").select("a", "b")
    label = materialize(connected_components(links), "join-labels")

    # What is left: pairs of a list that are not connected and that no known distance separates.
    open_ = _open_entries(sets, label, percent)
    known = compared.select(F.col("a").alias("cid"), F.col("b").alias("pivot"), "distance").unionByName(
        compared.select(F.col("b").alias("cid"), F.col("a").alias("pivot"), "distance"))
    shared = F.least(F.col("x.n") - F.col("x.skipped"), F.col("y.n") - F.col("y.skipped"))
    x, y = open_.alias("x"), open_.alias("y")
    overlap = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.cid") < F.col("y.cid")) & (F.col("x.label") != F.col("y.label"))
                   & _long_enough(F.col("x.n"), F.col("y.n"), percent)
                   & (F.least(overlap, shared) * (100 + percent) >= percent * (F.col("x.n") + F.col("y.n")))).select(
        F.col("x.cid").alias("a"), F.col("y.cid").alias("b"), F.col("x.pivot").alias("la"), F.col("y.pivot").alias("lb")).distinct()
    pairs = pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti")
    for pivot in ("la", "lb"):  # both to the pivot of either component
        for end in ("a", "b"):
            told = known.select(F.col("cid").alias(end), F.col("pivot").alias(pivot), F.col("distance").alias(f"d{end}"))
            pairs = pairs.join(told, [end, pivot], "left").withColumn(
                f"d{end}", F.when(F.col(end) == F.col(pivot), 0.0).otherwise(F.col(f"d{end}")))
        apart = F.abs(F.col("da") - F.col("db")) > (100 - percent) / 100 + 1e-9
        pairs = pairs.filter(~F.coalesce(apart, F.lit(False))).drop("da", "db")
    found = materialize(_compare(pairs, sets, percent), "join-pairs")
    return links.unionByName(found.filter("linked").select("a", "b"))


def _judged(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``(id, k1, k2, n, label)`` of rows ``(id, k1, k2, text)``; rows of one component share a label (null without shingles)."""
    bounded_batches(docs.sparkSession)
    classes = materialize(shingle_classes(docs, width), "join-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    ranges = max(24, int(total // RANGE))
    sets = materialize(_candidates(_shared(_postings(docs, "text", ranges, width), ranges), percent), "join-sets")
    label = connected_components(_links(sets, percent))
    # A component goes by the signature of its smallest class.
    label = label.join(sets.select(F.col("cid").alias("node"), "sig"), "node").join(
        sets.select(F.col("cid").alias("label"), F.col("sig").alias("component")), "label").select("sig", "component")
    judged = classes.join(label, "sig", "left").withColumn("label", F.coalesce("component", "sig"))
    return materialize(judged.select("id", "k1", "k2", "n", "label"), "join-labelled")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs``.

    Two rows are linked when the distinct ``width``-word shingles of their
    lower-cased (A-Z) texts meet the threshold; with fewer words the whole
    sequence is one shingle.  Null, empty and blank texts have no shingles, are
    linked with nothing and are their own component.  Rows with equal ids are
    judged each by its text.  Null ids do not count for the smallest id; a
    component of null ids only is null.  An empty table gives no rows; other
    columns are not read.
    """
    none = F.lit(0).cast("long")
    judged = _judged(docs.select(F.col(id_col).alias("id"), none.alias("k1"), none.alias("k2"), F.col(text_col).alias("text")), width, percent)
    least = judged.filter("label is not null").groupBy("label").agg(F.min("id").alias("least"))
    return judged.join(least, "label", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row with the smallest id; texts without words stay.

    Rows are matched with their decision by 128 bits of id and text, and of
    rows alike in both one stays.  Null ids come after all others.
    """
    keys = {"_k1": F.xxhash64("doc_id", "text"), "_k2": F.xxhash64(F.lit(1), "doc_id", "text")}
    judged = _judged(docs.select(F.col("doc_id").alias("id"), keys["_k1"].alias("k1"), keys["_k2"].alias("k2"), "text"), WIDTH, PERCENT)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2")).alias("first")
    stay = judged.filter("label is not null").groupBy("label").agg(first).select(F.col("first.k1").alias("_k1"), F.col("first.k2").alias("_k2"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    has_words = word_count(F.col("text")) > 0
    alike = Window.partitionBy("_k1", "_k2").orderBy("_k1")
    kept = docs.filter(has_words).withColumns(keys).join(stay, ["_k1", "_k2"]).withColumn("_n", F.row_number().over(alike)).filter("_n = 1")
    return kept.select(*names).unionByName(docs.filter(~has_words))


#: Counts every pair that shares a shingle, so it is for small tables.
ORACLE = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, w, list_distinct(list_transform(range(1, greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END)),
         lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM worded
), items AS (SELECT doc_id, unnest(s) AS h FROM sets
), sizes AS (SELECT doc_id, len(s) AS n FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM items a JOIN items b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
FROM sizes s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n
"""

QUERIES = {"op4_ngram_join": op4_ngram_join}
ORACLES = {"op4_ngram_join": ORACLE}
