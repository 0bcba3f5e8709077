"""Best-fit packing: exact pieces, the lower bound, and the local search against exhaustive packing."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylvan.llm import bestfit
from tests.llm.conftest import SMALL, nasty_rows


def fewest(lengths, size):
    """Sequences of an optimal packing, by trying every way."""
    best = len(lengths)

    def place(k, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if k == len(lengths):
            best = len(fills)
            return
        for b in range(len(fills)):
            if fills[b] + lengths[k] <= size:
                place(k + 1, fills[:b] + [fills[b] + lengths[k]] + fills[b + 1:])
        place(k + 1, [*fills, lengths[k]])

    place(0, [])
    return best


def test_small_packings_are_close_to_optimal_and_bounds_hold():
    rnd = random.Random(5)
    for _ in range(60):
        lengths = [rnd.randint(1, 20) for _ in range(rnd.randint(0, 9))]
        packed = bestfit.pack_lengths(lengths, 20)
        assert sorted(p for ps in packed for p in ps) == list(range(len(lengths)))
        assert all(0 < sum(lengths[p] for p in ps) <= 20 for ps in packed)
        optimal = fewest(lengths, 20)
        if lengths:
            assert bestfit.least_sequences(np.array(lengths), 20) <= optimal <= len(packed) <= optimal + 1


@pytest.mark.parametrize("low,high,within", [(400, 900, 1.01), (500, 1100, 1.06), (1, 2047, 1.003), (1, 60, 1.0)])
def test_search_empties_sequences_that_best_fit_leaves(low, high, within):
    rnd = random.Random(low)
    lengths = [rnd.randint(low, high) for _ in range(3000)]
    least = bestfit.least_sequences(np.array(lengths), 2048)
    packed = bestfit.pack_lengths(lengths)
    assert sorted(p for ps in packed for p in ps) == list(range(3000))
    assert all(sum(lengths[p] for p in ps) <= 2048 for ps in packed)
    assert len(packed) <= len(bestfit.best_fit(lengths, range(3000), 2048))
    assert len(packed) <= within * least


def test_every_step_grows_the_squared_fill():
    rnd = random.Random(3)
    lengths = [rnd.randint(500, 1100) for _ in range(400)]
    search = bestfit.Search(lengths, bestfit.best_fit(lengths, range(400), 2048), 2048)
    kinds = set()
    for _ in range(300):
        a = min(search.own, key=lambda b: (search.fill[b], b))
        before, pieces = sum(f * f for f in search.fill.values()), {b: len(p) for b, p in search.bins.items()}
        if not search.step(a):
            break
        assert sum(f * f for f in search.fill.values()) >= before + 2
        assert all(search.fill[b] == sum(lengths[p] for p in ps) <= 2048 for b, ps in search.bins.items())
        kinds.add(len(search.bins[a]) - pieces[a])
    assert {-1, 0} <= kinds  # moves (or two for one) and exchanges of one for one


def check_pieces(docs, rows, max_tokens, end_id):
    """Each document is cut and encoded as the tokenizer does; sequences are gapless and hold at most ``max_tokens``."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bestfit.tokenizer_file())
    tokenizer.encode_special_tokens = True
    want = []
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        first = len(ids) % max_tokens or max_tokens
        starts = [0, *range(first, len(ids), max_tokens)]
        for k, (a, b) in enumerate(itertools.pairwise([*starts, len(ids)])):
            want.append((str(doc_id), k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    assert sorted(want) == sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= max_tokens
    return len(by_sequence)


def test_query_packs_all_documents(spark):
    rows = bestfit.op11_bestfit(spark, SMALL).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    sequences = check_pieces(docs, rows, 2048, 0)
    lengths = np.array([r.length for r in rows])
    assert sequences <= bestfit.least_sequences(lengths, 2048) + 1


def test_edge_rows_several_groups_and_other_columns(spark, nasty, none):
    docs = [(r[0], r[1]) for r in nasty_rows()] + [(20, "<|endoftext|> a"), (21, "x" * 5000)]
    more = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("mine") for c in ("piece", "length", "sequence_id", "_group", "piece_row")})
    rows = bestfit.pack(more, bestfit.tokenizer_file(), max_tokens=64, end_id=7, group_pieces=5).collect()
    check_pieces(docs, rows, 64, 7)
    assert bestfit.pack(none, bestfit.tokenizer_file()).collect() == []
