"""License scans: every column against brute force, and files that repeat a notice very often."""

from __future__ import annotations

import math
import random
import re
import time

import pytest

from sylvan.llm import licenses
from tests.llm.conftest import lower

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(texts):
    files = {i: WORDS.findall(lower(t or "")) for i, t in texts.items()}
    runs = [(p, p, label, True) for p, label in licenses.BASE_PHRASES] + [(n, k, label, False) for label, n, k in licenses.TEMPLATES]
    vocabulary = {w for n, k, _, _ in runs for w in f"{n} {k}".split()}
    df = {w: sum(w in f for f in map(set, files.values())) for w in vocabulary}
    idf = {w: math.log((len(files) + 1) / (df[w] + 0.5)) + 1e-6 for w in vocabulary}
    out = {}
    for i, f in files.items():
        places, base, labels, best = [], set(), set(), 0.0
        for notice, key, label, is_base in runs:
            notice, key = notice.split(), key.split()
            shift = next(j for j in range(len(notice)) if notice[j: j + len(key)] == key)
            total = sum(idf[w] for w in notice)
            for p in range(len(f)):
                if f[p: p + len(key)] != key:
                    continue
                if is_base:
                    places.append(p)
                    base.add(label)
                    continue
                at = p - shift
                score = round(sum(idf[w] / total for j, w in enumerate(notice) if 0 <= at + j < len(f) and f[at + j] == w), licenses.SCORE_DIGITS)
                if score >= licenses.MIN_SCORE:
                    labels.add(label)
                    best = max(best, score)
        out[i] = (len(f), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                  ",".join(sorted(base | labels)), 1.0 if places else best)
    return out


def scanned(rows):
    return {r["doc_id"]: tuple(r)[1:7] + (pytest.approx(r["score"], abs=2e-6),) for r in licenses.scan_licenses(rows).collect()}


def test_labels_and_score_equal_brute_force(spark):
    rng = random.Random(5)
    words = sorted({w for _, n, _ in licenses.TEMPLATES for w in n.split()}) + ["other", "text"]
    texts = {}
    for i in range(150):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            run = rng.choice(licenses.TEMPLATES)[1].split() if rng.random() < 0.8 else rng.choice(licenses.BASE_PHRASES)[0].split()
            # Words changed, lost or put in, so that shares lie on both sides of the least one.
            for _ in range(rng.randrange(0, 4)):
                j = rng.randrange(len(run))
                run[j: j + rng.randrange(0, 2)] = [rng.choice(words)] * rng.randrange(0, 2)
                run = run or ["text"]
            parts.append(" ".join(run))
        texts[i] = rng.choice([". ", " ", " filler "]).join(parts)
    texts |= {500: None, 501: "", 502: " \n", 503: "license", 504: "mit license", 505: "cc by cc by nc 4 0"}
    want = brute(texts)
    assert {r[5] for r in want.values()} != {r[4] for r in want.values()}
    assert scanned(spark.createDataFrame(list(texts.items()), "doc_id long, text string")) == want


def test_odd_rows(spark, nasty, none):
    rows = licenses.scan_licenses(nasty.withColumnRenamed("source", "words").withColumnRenamed("lang", "hits")).collect()
    assert len(rows) == nasty.count()
    last = next(r for r in rows if r["doc_id"] == 12)
    assert (last["base_labels"], last["labels"], last["first_word"]) == ("gpl,reserved", "gpl,gpl-3,reserved", 7)
    assert licenses.scan_licenses(none).count() == 0


def test_work_is_linear_in_repeats(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy. "

    def seconds(n):
        rows = spark.createDataFrame([(n, notice * n + "All rights reserved")], "doc_id long, text string")
        began = time.time()
        (r,) = licenses.scan_licenses(rows).collect()
        assert (r["n_words"], r["first_word"], r["labels"]) == (13 * n + 3, 13 * n, "mit,reserved")
        return time.time() - began

    seconds(10)
    few, many = seconds(2_500), seconds(20_000)
    assert many < 8 * few + 10  # eight times the text; the earlier work for each pair of repeats took 64 times as long
