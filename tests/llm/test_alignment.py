"""Cross-tokenizer alignment against a brute force over bytes."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sylvan.llm import alignment
from tests.llm.conftest import SMALL, nasty_rows


def token_bytes():
    from tokenizers import Tokenizer
    import sentencepiece

    a_path, b_path = alignment.tokenizer_files()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    letters = {}
    extra = 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            letters[chr(byte)] = byte
        else:
            letters[chr(extra)] = byte
            extra += 1
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)

    def a_tokens(text):
        return [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]

    def b_tokens(text):
        out = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            out.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return out

    return a_tokens, b_tokens


def brute(texts):
    """For each text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    a_tokens, b_tokens = token_bytes()
    docs, held = [], Counter()
    for text in texts:
        a, b = (a_tokens(text), b_tokens(text)) if text else ([], [])
        if text and not b"".join(x for _, x in a) == (" " + text).encode() == b"".join(x for _, x in b):
            a, b = [], []
        owner = [(k, i) for k, (i, x) in enumerate(b) for _ in x]
        links, at, cuts_a = set(), 0, []
        for k, (i, x) in enumerate(a):
            links |= {(k, i, *owner[p]) for p in range(at, at + len(x))}
            at += len(x)
            cuts_a.append(at)
        at, cuts_b = 0, []
        for _, x in b:
            at += len(x)
            cuts_b.append(at)
        groups, ia, ib = [], 0, 0
        for end in sorted(set(cuts_a) & set(cuts_b)):
            na, nb = cuts_a.index(end) + 1, cuts_b.index(end) + 1
            groups.append(",".join(str(i) for i, _ in a[ia:na]) + "|" + ",".join(str(i) for i, _ in b[ib:nb]))
            ia, ib = na, nb
        held.update({(i, j) for _, i, _, j in links})
        docs.append((len(a), len(b), len(groups), [(i, j) for _, i, _, j in links],
                     hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    return [(na, nb, ng, len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), sha)
            for na, nb, ng, links, sha in docs]


def results(df):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]


ODD = ["  two  spaces ", " ", "▁bar", "a▁b", "line\n\n next\t\ttab\r\n", "naïve 　 日本語 𝒳 \x00", "<s> </s> <0x41> <|endoftext|>",
       "x" * 3000, "é" * 700 + " a", "same text here", "same text here", None, ""]


@pytest.mark.parametrize("hot_pairs", [0, 40, 1_000_000])
def test_edges_equal_brute_force_with_any_share_of_hot_pairs(spark, none, hot_pairs):
    texts = ODD + [r[1] for r in nasty_rows() if not r[1] or len(r[1]) < 10_000]
    docs = spark.createDataFrame([(None if i % 3 else 7, t, "x", "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, pairs string, n_best string").repartition(3)
    got = alignment.align(docs, *alignment.tokenizer_files(), hot_pairs=hot_pairs)
    assert sorted(results(got)) == sorted(brute(texts))
    assert alignment.align(none, *alignment.tokenizer_files(), hot_pairs=hot_pairs).collect() == []


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id for r in docs if len(r.text) < 9_000}
    got = {r.doc_id: tuple(r)[1:] for r in alignment.op12_alignment(spark, SMALL).collect()}
    assert set(got) == {r.doc_id for r in docs}
    # The brute force is slow in long texts: those still take part in the counts.
    want = dict(zip([r.doc_id for r in docs], brute([r.text for r in docs])))
    columns = alignment.op12_alignment(spark, SMALL).columns[1:]
    order = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert columns == order and short
    assert got == want


def test_batches_end_with_a_document(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "the cat sat " * (i % 7)) for i in range(40)], "doc_id long, text string").coalesce(1)
    whole = sorted(alignment.align(docs, *alignment.tokenizer_files()).collect())
    monkeypatch.setattr(alignment, "BATCH_BYTES", 50)
    assert sorted(alignment.align(docs, *alignment.tokenizer_files()).collect()) == whole
    assert docs.agg(F.count("doc_id")).first()[0] == len(whole)
