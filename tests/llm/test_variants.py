"""Spelling variants: DuckDB on whole tables, brute force over all pairs of small alphabets, chains and edges."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from sylvan.llm import variants as va
from tests.llm.conftest import SMALL


def near(a, b):
    """One inserted, deleted or replaced code point, by trying each place."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(counts, factor):
    out = {}
    form = {}
    for w, n in counts.items():
        others = [v for v in counts if near(v, w)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * n else None
        out[w] = len(others)
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, out[w], counts.get(form[w])))
    return sorted(rows)


def texts_of(counts, rnd):
    words = [w for w, n in counts.items() for _ in range(n)]
    rnd.shuffle(words)
    return [(i, " ".join(words[i::50])) for i in range(50)]


@pytest.mark.parametrize("seed,letters,factor", [(1, "ab", 2), (2, "abc", 2), (3, "aéÿ×z", 5)])
def test_small_alphabets_equal_brute_force(spark, seed, letters, factor):
    rnd = random.Random(seed)
    counts = Counter()
    for _ in range(160):
        counts["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7)))] = rnd.choice([1, 1, 2, 3, 5, 10, 30])
    docs = spark.createDataFrame(texts_of(counts, rnd), "doc_id long, text string")
    got = va.variants(docs, min_letters=2, min_count=1, factor=factor, spoil=0).collect()
    assert sorted(map(tuple, got)) == brute(counts, factor)


def test_long_chains_end_at_their_root(spark):
    counts = {"abcdefg"[:k] + "zzzzzzz"[k:]: 2 ** k for k in range(8)}
    docs = spark.createDataFrame(texts_of(counts, random.Random(1)), "doc_id long, text string")
    got = sorted(map(tuple, va.variants(docs, min_letters=2, min_count=1, factor=2, spoil=0).collect()))
    assert got == brute(counts, 2) and {r[2] for r in got} == {"abcdefg"}


def test_query_equals_duckdb(spark):
    got = va.op13_variants(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    result = con.execute(va.SQL)
    assert [c[0] for c in result.description] == got.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(result.fetchall(), key=str)


def test_edges_and_small_tables(spark, nasty, none, monkeypatch):
    assert va.variants(none).collect() == []
    with pytest.raises(ValueError):
        va.variants(none, factor=1)
    monkeypatch.setattr(va, "TABLE_WORDS", 3)
    clash = nasty.withColumns({c: F.lit("x") for c in ("word", "n", "form", "prefix")})
    got = {r.word: r.n for r in va.variants(clash, min_letters=3, min_count=1, spoil=0).collect()}
    want = Counter(w for r in nasty.collect() for w in va.LETTERS.findall((r.text or "").encode().lower().decode()) if len(w) >= 3)
    assert got == dict(want)
