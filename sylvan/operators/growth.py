"""Growing all trees of all grid keys from packed rows.

A training row is kept once, with the array of the trees that draw it (``drawn``,
numbers into a list of :class:`Tree`).  Nothing is copied per tree or per level: a
level is one scan that walks each row down every tree that drew it, through the splits
found so far, and counts histogram cells ``(t, node, f, v) -> n, sums`` in dense arrays
of its partition.  Only cells are shuffled.

From the first split on, only the child with fewer rows is counted.  Its sibling is the
parent's histogram minus the child's: the scan writes each of the child's cells a second
time, negative and under the sibling's number, the parent's cells (kept in the shared
folder) are added to them, and one aggregation gives both.  So a level counts at most
half of the rows that reach it.

Where the configuration bounds the rows of a tree (``max_rows``), :func:`grow_whole` sends
each tree's drawn rows to one task once, packed, and the tree is grown there without any
further shuffle; the nodes are the same.

The driver holds the trees' nodes, at most ``trees * 2 ** (depth + 1)`` rows: a bound of
the configuration, never of the data.  A lost task scans its rows again.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.operators.forest import CLASSES, VOTE_SCALE, best_splits, stat_columns
from sylvan.session import drop_path, materialize_at

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: Rows of a scan that are counted together, and (row, tree) pairs that end such a chunk early.
CHUNK_ROWS, CHUNK_PAIRS = 200_000, 4_000_000
#: Cells of one feature that a chunk counts in a dense array; above, its pairs are sorted instead.
DENSE_CELLS = 4_000_000
#: Rows of a tree up to which one task grows it, and bytes of drawn rows that a task packs together.
WHOLE_ROWS, PACKED_BYTES = 2_000_000, 32_000_000


@dataclass(frozen=True)
class Tree:
    k: str
    tree: int
    min_leaf: int
    max_depth: int
    mask: tuple[int, ...]


class Splits:
    """The nodes that rows are walked through: numbered slots, the roots first (slot t is tree t's root)."""

    def __init__(self, trees: list[Tree], n_features: int):
        n = len(trees)
        self.tree = np.arange(n)
        self.node = np.ones(n, dtype=np.int64)
        self.f = np.full(n, -1)
        self.v = np.zeros(n)
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        #: Nodes to count in the coming scan; whether a counted node, and its sibling, get a histogram.
        self.scan = np.ones(n, dtype=bool)
        self.own, self.sibling = np.ones(n, dtype=bool), np.zeros(n, dtype=bool)
        self.mask = np.zeros((n, n_features), dtype=bool)
        for t, spec in enumerate(trees):
            self.mask[t, list(spec.mask)] = True
        self.depth = 0
        self._slot = {(t, 1): t for t in range(n)}

    def split(self, found: list[dict]) -> list[tuple[int, int, int]]:
        """Add the children of the split nodes; returns ``(t, node, child)`` of those that parent minus child gives."""
        self.scan[:] = False
        new, larger = [], []
        for s in found:
            at = self._slot[s["t"], s["node"]]
            self.f[at], self.v[at] = s["f"], s["split_v"]
            if not (s["open_left"] or s["open_right"]):
                continue
            small_right = s["nr"] < s["nl"]
            for right, is_open, other in ((False, s["open_left"], s["open_right"]), (True, s["open_right"], s["open_left"])):
                counted = right == small_right
                if is_open or counted:
                    child = 2 * s["node"] + right
                    slot = len(self.f) + len(new)
                    new.append((s["t"], child, counted, is_open, other and counted))
                    self._slot[s["t"], child] = slot
                    (self.right if right else self.left)[at] = slot
                if is_open and not counted:
                    larger.append((s["t"], s["node"], 2 * s["node"] + right))
        t, node, scan, own, sibling = (np.array(c) for c in zip(*new)) if new else (np.zeros(0, dtype=np.int64),) * 5
        self.tree, self.node = np.append(self.tree, t), np.append(self.node, node)
        blank = np.full(len(new), -1)
        self.f, self.left, self.right = (np.append(a, blank) for a in (self.f, self.left, self.right))
        self.v = np.append(self.v, np.zeros(len(new)))
        self.scan, self.own, self.sibling = (np.append(a, b.astype(bool)) for a, b in
                                             ((self.scan, scan), (self.own, own), (self.sibling, sibling)))
        self.depth += 1
        return larger

    def walk(self, x: np.ndarray, row: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, slot)`` of the pairs that reach a node to count."""
        slot = tree
        for _ in range(self.depth):
            alive = self.f[slot] >= 0
            row, slot = row[alive], slot[alive]
            slot = np.where(x[row, self.f[slot]] > self.v[slot], self.right[slot], self.left[slot])
            alive = slot >= 0
            row, slot = row[alive], slot[alive]
        counted = self.scan[slot]
        return row[counted], slot[counted]


def _parts(y: np.ndarray, n_classes: int) -> list[np.ndarray]:
    """What :func:`_sums` adds up of each label: the class, or both halves of the number, whose sums are exact apart."""
    return [y] if n_classes else [(y & 0xFFFFF).astype(np.float64), (y >> 20).astype(np.float64)]


def _sums(key: np.ndarray, parts: list[np.ndarray], cells: int, n_classes: int) -> list[np.ndarray]:
    """Sums of the labels by cell, or the count of each class."""
    if n_classes:
        return list(np.bincount(key * n_classes + parts[0], minlength=cells * n_classes).reshape(cells, n_classes).T)
    low, high = (np.bincount(key, weights=p, minlength=cells).astype(np.int64) if p.any() else np.zeros(cells, dtype=np.int64) for p in parts)
    return [(high << 20) + low]


def count_cells(x: np.ndarray, y: np.ndarray, row: np.ndarray, tree: np.ndarray, splits: Splits, n_classes: int) -> list[np.ndarray]:
    """Columns ``t, node, f, v, n`` and the sums of one chunk's cells, the siblings' negative ones included."""
    row, slot = splits.walk(x, row, tree)
    place = np.cumsum(splits.scan) - 1  # of a counted slot among the counted ones
    slots = np.flatnonzero(splits.scan)
    out = []
    of_row, of_slot, of_y = row, place[slot], [p[row] for p in _parts(y, n_classes)]
    for f in range(x.shape[1]):
        tried = splits.mask[splits.tree[slots], f]
        r, s, parts = of_row, of_slot, of_y
        if not tried.all():
            masked = tried[of_slot]
            r, s, parts = r[masked], s[masked], [p[masked] for p in parts]
        if not len(r):
            continue
        values, code = np.unique(x[:, f], return_inverse=True)
        key = s * len(values) + code[r]
        cells, used = len(slots) * len(values), None
        if cells > DENSE_CELLS:
            used, key = np.unique(key, return_inverse=True)
            cells = len(used)
        n = np.bincount(key, minlength=cells)
        sums = _sums(key, parts, cells, n_classes)
        if used is None:
            used = np.flatnonzero(n)
            n, sums = n[used], [c[used] for c in sums]
        at, v = slots[used // len(values)], values[used % len(values)]
        for keep, sign, sibling in ((splits.own[at], 1, 0), (splits.sibling[at], -1, 1)):
            out.append([splits.tree[at[keep]], splits.node[at[keep]] ^ sibling, np.full(int(keep.sum()), f), v[keep],
                        sign * n[keep], *[sign * c[keep] for c in sums]])
    return [np.concatenate(c) for c in zip(*out)] if out else []


def _rows(df: DataFrame, n_features: int, splits: Splits, n_classes: int, edges: list[list[float]] | None) -> DataFrame:
    """Partial histogram cells of a level: one scan over ``x, y, drawn``."""
    stats = stat_columns(n_classes)
    schema = "t int, node long, f int, v double, n long, " + ", ".join(f"{s} long" for s in stats)
    known = df.sparkSession.sparkContext.broadcast(splits)
    cut = None if edges is None else [np.array(e) for e in edges]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.float64()] + [pa.int64()] * (1 + len(stats))
    names = ["t", "node", "f", "v", "n", *stats]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held):
            x = np.concatenate([b.column(0).flatten().to_numpy(zero_copy_only=False) for b in held]).reshape(-1, n_features)
            if cut is not None:
                x = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(cut)], axis=1).astype(float)
            y = np.concatenate([b.column(1).to_numpy() for b in held])
            size = np.concatenate([b.column(2).value_lengths().to_numpy() for b in held])
            tree = np.concatenate([b.column(2).flatten().to_numpy() for b in held]).astype(np.int64)
            columns = count_cells(x, y, np.repeat(np.arange(len(y)), size), tree, known.value, n_classes)
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        held, rows, pairs = [], 0, 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows, pairs = rows + batch.num_rows, pairs + len(batch.column(2).flatten())
            if rows >= CHUNK_ROWS or pairs >= CHUNK_PAIRS:
                yield from counted(held)
                held, rows, pairs = [], 0, 0
        if held:
            yield from counted(held)

    return df.select("x", "y", "drawn").mapInArrow(scan, schema)


def level_cells(rows: DataFrame, trees: list[Tree], n_features: int, splits: Splits, n_classes: int,
                edges: list[list[float]] | None, parents: DataFrame | None, larger: list[tuple[int, int, int]]) -> DataFrame:
    """The histograms of a level: counted nodes, and siblings as parent minus counted child."""
    stats = ["n", *stat_columns(n_classes)]
    cells = _rows(rows, n_features, splits, n_classes, edges)
    if larger:
        spark = rows.sparkSession
        t, node, child = (pa.array(c, k) for c, k in zip(zip(*larger), (pa.int32(), pa.int64(), pa.int64())))
        whose = spark.createDataFrame(pa.table({"t": t, "node": node, "child": child}))
        kept = parents.join(F.broadcast(whose), ["t", "node"])  # as many rows as split nodes, a bound of the configuration
        cells = cells.unionByName(kept.select("t", F.col("child").alias("node"), "f", "v", *stats))
    summed = cells.groupBy("t", "node", "f", "v").agg(*[F.sum(s).alias(s) for s in stats]).filter("n > 0")

    def of_tree(values: list[int]):
        return F.expr(f"array({', '.join(map(str, values))})[t]")

    return summed.withColumns({"min_leaf": of_tree([s.min_leaf for s in trees]), "max_depth": of_tree([s.max_depth for s in trees])})


def grow(rows: DataFrame, trees: list[Tree], n_features: int, task: str, n_classes: int = 0,
         edges: list[list[float]] | None = None) -> DataFrame:
    """Grow every tree to its own depth; returns the node table.

    ``rows`` has ``x`` (array of ``n_features`` doubles), ``y`` (long; the class's
    number for ``multi``) and ``drawn`` (numbers into ``trees``), none null.  With
    ``edges`` (sorted cut points of each feature) a feature's histogram value is its bin,
    found by binary search, and the threshold is the bin's upper edge.  Nodes are ``k, tree, node, depth, n,
    s, f, thr, is_leaf, vote``; for ``multi``, ``counts`` and ``votes`` are arrays
    over the classes in place of ``s`` and ``vote``.  Trees that draw no row have no nodes.
    """
    if task not in VOTE_SCALE:
        raise ValueError(f"task must be one of {sorted(VOTE_SCALE)}")
    if (task == CLASSES) != (n_classes > 0):
        raise ValueError("the number of classes belongs to the multi-class task")
    deepest = max(t.max_depth for t in trees)
    if not 1 <= deepest <= 29:
        raise ValueError("max_depth must be from 1 to 29: nodes are numbered by 32 bits")
    stats = stat_columns(n_classes)
    spark = rows.sparkSession
    splits, larger, parents, path = Splits(trees, n_features), [], None, None
    nodes: dict[tuple[int, int], list] = {}  # (t, node) -> depth, n, sums, f, thr
    for depth in range(deepest):
        cells = level_cells(rows, trees, n_features, splits, n_classes, edges, parents, larger)
        before = path
        path = None
        if depth + 1 < deepest:
            cells, path = materialize_at(cells, f"cells-{depth}")
        best = best_splits(cells, depth, task, keys=["t"], stats=stats).toArrow().to_pylist()
        if before:
            drop_path(spark, before)
        if depth == 0:
            for s in best:
                nodes[s["t"], 1] = [0, s["nt"], [s[f"{c}_t"] for c in stats], None, None]
        found = sorted((s for s in best if s["f"] is not None), key=lambda s: (s["t"], s["node"]))
        for s in found:
            thr = s["thr"] if edges is None else float(edges[s["f"]][int(s["split_v"])])
            nodes[s["t"], s["node"]][3:] = [s["f"], thr]
            for right, side in ((0, "l"), (1, "r")):
                nodes[s["t"], 2 * s["node"] + right] = [depth + 1, s[f"n{side}"], [s[f"{c}_{side}"] for c in stats], None, None]
        larger = splits.split(found)
        parents = cells
        if not splits.scan.any():
            break
    if path:
        drop_path(spark, path)
    return _node_table(spark, trees, nodes, VOTE_SCALE[task], n_classes)


def _code_type(edges: list[list[float]] | None) -> np.dtype:
    """Type of a packed feature: the value itself, or its bin."""
    return np.dtype(np.float64) if edges is None else np.min_scalar_type(max(map(len, edges), default=0))


def _dealt(rows: DataFrame, draws: Callable, n_trees: int, n_features: int, edges: list[list[float]] | None) -> DataFrame:
    """``(t, n, wide, x, y)``: parts of the rows ``rid, x, y`` that tree t draws, packed; labels are ``wide`` bytes each."""
    cut, kind = None if edges is None else [np.array(e) for e in edges], _code_type(edges)
    most = PACKED_BYTES // (n_features * kind.itemsize + 8)

    def packed(held: list[tuple]) -> pa.RecordBatch:
        first = np.cumsum([0] + [len(h[1]) for h in held[:-1]])
        x, y, tree = (np.concatenate([h[i] for h in held]) for i in (0, 1, 3))
        row = np.concatenate([h[2] + a for h, a in zip(held, first)])
        order = np.argsort(tree.astype(np.min_scalar_type(n_trees)), kind="stable")
        x, y = x[row[order]], y[row[order]]
        y = y.astype(np.min_scalar_type(-1 - max(y.max(), -1 - y.min())))  # the smallest signed type
        cuts = np.searchsorted(tree[order], np.arange(n_trees + 1))
        some = [(t, int(a), int(b)) for t, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        return pa.RecordBatch.from_arrays(
            [pa.array([t for t, _, _ in some], pa.int32()), pa.array([b - a for _, a, b in some], pa.int64()),
             pa.array([y.itemsize] * len(some), pa.int32()), *(pa.array([z[a:b].tobytes() for _, a, b in some], pa.binary()) for z in (x, y))],
            ["t", "n", "wide", "x", "y"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs = [], 0
        for batch in batches:
            row, tree = draws(batch.column(0))
            if not len(row):
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features)
            if cut is not None:
                x = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(cut)], axis=1).astype(kind)
            held.append((x, batch.column(2).to_numpy(), row, tree))
            pairs += len(row)
            if pairs >= most:
                yield packed(held)
                held, pairs = [], 0
        if held:
            yield packed(held)

    return rows.select("rid", "x", "y").mapInArrow(deal, "t int, n long, wide int, x binary, y binary")


def grown_tree(x: np.ndarray, y: np.ndarray, tree: Tree, task: str, n_classes: int, edges: list[list[float]] | None) -> list[tuple]:
    """``(node, depth, n, sums, f, thr)`` of one tree, from the rows it draws; ``x`` holds bins if there are ``edges``."""
    codes, values = [], []
    for f in range(x.shape[1]):
        if f not in tree.mask:
            known, code = np.zeros(1), np.zeros(0, np.int64)
        elif edges is None:
            known, code = np.unique(x[:, f], return_inverse=True)
        else:
            known, code = np.arange(len(edges[f]) + 1), np.ascontiguousarray(x[:, f])
        values.append(known)
        codes.append(code)
    parts = _parts(y.astype(np.int64), n_classes)
    # Rows of nodes that are searched, their node's place among these, and the nodes' numbers and totals.
    row, place, node = np.arange(len(y)), np.zeros(len(y), np.int64), np.ones(1, np.int64)
    n, sums = np.array([len(y)]), _sums(place, parts, 1, n_classes)
    found: dict[int, list] = {1: [0, len(y), [int(s[0]) for s in sums], None, None]} if len(y) and tree.mask else {}
    for depth in range(tree.max_depth if found else 0):
        pure = np.zeros(len(node), bool)
        if task != "reg":
            pure = np.any([s == n for s in sums] + ([] if n_classes else [sums[0] == 0]), axis=0)
        is_open = (n >= 2 * tree.min_leaf) & ~pure
        if not is_open.any():
            break
        kept = is_open[place]
        row, place = row[kept], (np.cumsum(is_open) - 1)[place[kept]]
        node, n, sums = node[is_open], n[is_open], [s[is_open] for s in sums]
        m = len(node)
        best, best_f, best_at, best_thr = np.full(m, -np.inf), np.full(m, -1), np.zeros(m, np.int64), np.zeros(m)
        left, left_sums = np.zeros(m, np.int64), [np.zeros(m, np.int64) for _ in sums]
        of_rows = [p[row] for p in parts]
        for f in tree.mask:
            many = len(values[f])
            key = place * many + codes[f][row]
            cells = np.bincount(key, minlength=m * many).reshape(m, many)
            nl = np.cumsum(cells, axis=1)
            sl = [np.cumsum(s.reshape(m, many), axis=1) for s in _sums(key, of_rows, m * many, n_classes)]
            nr = n[:, None] - nl
            valid = (cells > 0) & (nr > 0) & (nl >= tree.min_leaf) & (nr >= tree.min_leaf)

            def squares(side):
                out = 0.0
                for s in side:
                    out = out + s.astype(np.float64) * s.astype(np.float64)
                return out

            with np.errstate(divide="ignore", invalid="ignore"):
                score = np.where(valid, squares(sl) / nl + squares([t[:, None] - s for s, t in zip(sl, sums)]) / nr, -np.inf)
            at = np.argmax(score, axis=1)  # the first of equal ones has the smallest threshold
            i = np.flatnonzero(score[np.arange(m), at] > best)
            at = at[i]
            best[i], best_f[i], best_at[i], left[i] = score[i, at], f, at, nl[i, at]
            for s, of_left in zip(sl, left_sums):
                of_left[i] = s[i, at]
            if edges is None:
                after = np.argmax((cells[i] > 0) & (np.arange(many) > at[:, None]), axis=1)
                best_thr[i] = (values[f][at] + values[f][after]) / 2.0
            else:
                best_thr[i] = np.array(edges[f])[at] if len(i) else 0.0
        split = best_f >= 0
        if not split.any():
            break
        right, right_sums = n - left, [t - s for s, t in zip(left_sums, sums)]
        for j in np.flatnonzero(split):
            found[int(node[j])][3:] = [int(best_f[j]), float(best_thr[j])]
            for side, (size, of_side) in enumerate(((left, left_sums), (right, right_sums))):
                found[2 * int(node[j]) + side] = [depth + 1, int(size[j]), [int(s[j]) for s in of_side], None, None]
        kept = split[place]
        row, place = row[kept], place[kept]
        goes_right = np.zeros(len(row), np.int64)
        for f in np.unique(best_f[split]):
            of_f = np.flatnonzero(best_f[place] == f)
            goes_right[of_f] = codes[f][row[of_f]] > best_at[place[of_f]]
        place = 2 * (np.cumsum(split) - 1)[place] + goes_right
        node = np.stack([2 * node[split], 2 * node[split] + 1], axis=1).ravel()
        n = np.stack([left[split], right[split]], axis=1).ravel()
        sums = [np.stack([a[split], b[split]], axis=1).ravel() for a, b in zip(left_sums, right_sums)]
    return [(name, *about) for name, about in sorted(found.items())]


def grow_whole(rows: DataFrame, draws: Callable, trees: list[Tree], n_features: int, task: str, n_classes: int = 0,
               edges: list[list[float]] | None = None) -> DataFrame:
    """The node table of :func:`grow` from rows ``rid, x, y``, for trees whose rows the configuration bounds.

    ``draws`` gives ``(row, tree number)`` of an array of ids, as :func:`sylvan.operators.sampling.row_draws`.
    """
    kind = _code_type(edges)
    names = ["t", "node", "depth", "n", "sums", "f", "thr"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.float64()]

    def whole(group: pa.Table) -> pa.Table:
        t = group.column("t")[0].as_py()
        x = np.concatenate([np.frombuffer(b, kind) for b in group.column("x").to_pylist()]).reshape(-1, n_features)
        y = np.concatenate([np.frombuffer(b, f"i{w}").astype(np.int64) for b, w in zip(*(group.column(c).to_pylist() for c in ("y", "wide")))])
        nodes = [(t, *node) for node in grown_tree(x, y, trees[t], task, n_classes, edges)]
        columns = list(zip(*nodes)) or [[]] * len(names)
        return pa.table({name: pa.array(list(c), k) for name, c, k in zip(names, columns, kinds)})

    grown = _dealt(rows, draws, len(trees), n_features, edges).groupBy("t").applyInArrow(
        whole, "t int, node long, depth int, n long, sums array<long>, f int, thr double")
    nodes = {(r["t"], r["node"]): [r[c] for c in names[2:]] for r in grown.toArrow().to_pylist()}
    return _node_table(rows.sparkSession, trees, nodes, VOTE_SCALE[task], n_classes)


def _node_table(spark, trees: list[Tree], nodes: dict, scale: float, n_classes: int) -> DataFrame:
    told = []
    for (t, node), (depth, n, sums, f, thr) in sorted(nodes.items()):
        votes = [int(np.floor(float(s) * scale / n + 0.5)) for s in sums]
        told.append((trees[t].k, trees[t].tree, node, depth, n, sums if n_classes else sums[0], f, thr, f is None,
                     votes if n_classes else votes[0]))
    names = ["k", "tree", "node", "depth", "n", "counts" if n_classes else "s", "f", "thr", "is_leaf", "votes" if n_classes else "vote"]
    many = pa.list_(pa.int64()) if n_classes else pa.int64()
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), many, pa.int32(), pa.float64(), pa.bool_(), many]
    columns = list(zip(*told)) or [[]] * len(names)
    table = pa.table({name: pa.array(list(c), kind) for name, c, kind in zip(names, columns, kinds)})
    return spark.createDataFrame(table)
