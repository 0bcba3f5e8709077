"""Operators against brute force, exact round trips, oracle SQL and held-out accuracy."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sylvan.llm import language, licenses, lm, mixing, ngramjoin, nndescent, packing, toxicity, urlfilter, words
from tests.llm.conftest import SMALL, WORD, lower
from tests.oracle_compare import compare


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def texts_of(spark):
    return {r["doc_id"]: r["text"] for r in documents(spark).collect()}


@pytest.mark.parametrize("module", [licenses, mixing, ngramjoin, urlfilter])
def test_oracle_sql(spark, module):
    for name, query in module.QUERIES.items():
        assert compare(spark, name, query, module.ORACLES[name], SMALL)["status"] == "match"


def test_word_hashes_find_the_words(monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    texts = [None, "", "  ", "Abc abc ABC", "é É x"] + ["".join(rng.choice("ab AB\n\tcé") for _ in range(rng.randrange(60))) for _ in range(300)]
    for segment in (7, 64, 1 << 20):
        monkeypatch.setattr(words, "SEGMENT", segment)
        hashes, at = words.word_hashes(*words.text_bytes(pa.array(texts)))
        seen = {}
        for i, text in enumerate(texts):
            want = WORD.findall(lower(text or ""))
            assert at[i + 1] - at[i] == len(want)
            for w, h in zip(want, hashes[at[i]: at[i + 1]]):
                assert seen.setdefault(w, int(h)) == int(h)
        assert len(set(seen.values())) == len(seen)


def mutated(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def near_copies():
    """Chains and groups of near copies, shared passages and short texts, as (id, text)."""
    rng = random.Random(5)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for group in range(12):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(rng.choice([8, 40, 120, 200]))]
        for _ in range(rng.choice([1, 3, 25])):
            rows.append(" ".join(mutated(rng, base, rng.randrange(0, 4)) + (passage if rng.random() < 0.3 else [])))
    chain = [f"c{i}" for i in range(300)]
    for i in range(20):
        rows.append(" ".join(chain[i * 6: i * 6 + 150]))
    rows += rows[:30] + ["one two", "One TWO", "", "a", "a b c d e", "a b c d e f"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = WORD.findall(lower(text or ""))
        sets[i] = {tuple(w[k: k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b]) if a < b else 0
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_ngram_join_equals_brute_force(spark, monkeypatch):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = brute_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.similar_components(docs).collect()}
    assert got == want
    monkeypatch.setattr(ngramjoin, "FREQUENT", 3)  # with many frequent hashes and small batches
    monkeypatch.setattr(ngramjoin, "BATCH", 700)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.similar_components(docs).collect()}
    assert got == want


def test_ngram_join_of_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.op4_ngram_join(spark, SMALL).collect()}
    assert got == brute_components(rows)


def test_mixing_comes_near_its_targets(spark):
    rows = mixing.op5_mixing(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source"), "doc_id")
    for r in rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("largest")).collect():
        assert abs(r["taken"] - r["target"]) <= 1.5 * r["largest"]
    total = rows.groupBy("source").agg(F.max("target").alias("t"), F.max("source_size").alias("s")).agg(F.sum("t"), F.sum("s")).first()
    assert total[0] == pytest.approx(1.5 * total[1])


def test_url_filters_with_nested_rules(spark):
    rng = random.Random(9)
    labels = ["a", "b", "com", "net", "x-y"]
    rules = list({(".".join(rng.choice(labels) for _ in range(rng.randint(1, 3))), "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 4)))):
                  rng.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [(i, "http://" + ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) + "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 6))))
            for i in range(600)]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urlfilter.judge_urls(
        spark.createDataFrame(urls, "page_id long, url string"), urlfilter.rules_table(spark, rules)).collect()}
    for i, url in urls:
        host, path = re.fullmatch("http://([^/]*)(.*)", url).groups()
        fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = max(fits)[2:] if fits else (None, "allow")
        assert got[i] == want, url


LICENCE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_licences_equal_brute_force(spark):
    rng = random.Random(2)
    pieces = ["released under the MIT License", "cc by", "CC-BY-NC 4.0", "all rights", "all rights reserved", "general public license", "license",
              "gnu", "text", "über", "mit", "by", "general public", "This work is licensed under the GNU General Public License, version 3."]
    texts = dict(enumerate(". ".join(rng.choice(pieces) for _ in range(rng.randrange(0, 30))) for _ in range(120)))
    texts |= {1000 + i: t for i, t in texts_of(spark).items()}
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for i, text in texts.items():
        w = LICENCE_WORD.findall(lower(text or ""))
        places, labels, own = [], set(), set()
        for phrase, label in licenses.BASE_PHRASES:
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k: k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        for label, notice, key in licenses.TEMPLATES:
            n = notice.split()
            own |= {label} if any(w[k: k + len(n)] == n for k in range(len(w))) else set()
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(places), ",".join(sorted(labels)))
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert labels | own <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_packing_is_an_exact_partition(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_file())
    tokenizer.encode_special_tokens = True
    rows = collections.defaultdict(list)
    sequences = collections.defaultdict(list)
    for r in packing.op9_packing(spark, SMALL).collect():
        rows[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    texts = texts_of(spark)
    assert set(rows) == set(texts)
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for r in sorted(rows[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]: at].tobytes())
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096 and at & (at - 1) == 0  # nothing is padded
        assert {r["sequence_length"] for r in pieces} == {at}


def test_word_encoder_equals_the_tokenizer():
    encoder = packing.WordEncoder(packing.tokenizer_file(), cache_words=3)
    for text in ["áb é", "x don't I'm\x1c!? ...\x85 ok", "<|endoftext|> a", "İstanbul ΣΑΣ. Straße ﬁ Å", "12 345 a1b2", "a　b 'S 'T", "ÀÉ. Öß, x!!", ""]:
        got = np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist()
        assert got == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 3000, 1500)
    _, sizes, costs = packing.pack_lengths(lengths)
    full = [c for s, c in zip(sizes, costs) if s == 4096]
    assert sum(sizes) == lengths.sum() and np.std(full) < 0.2 * np.mean(full)


def test_language_model_equals_brute_force(spark):
    tokens = {i: [*WORD.findall(lower(t or "")), None] for i, t in texts_of(spark).items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    one, two = collections.Counter(), collections.Counter()
    for i, w in tokens.items():
        if not held[i]:
            one.update(w)
            two.update(zip(["<s>", *w[:-1]], w))
    n, types, pairs = sum(one.values()), len(one), len(two)
    ctx, cont = collections.defaultdict(lambda: [0, 0, 0, 0]), collections.Counter()
    for (v, w), c in two.items():
        ctx[v][0] += c
        ctx[v][min(c, 3)] += 1
        cont[w] += 1

    def discounted(counts):
        seen = collections.Counter(counts)
        return (0.0, *lm.discounts(seen[1], seen[2], seen[3], seen[4]))

    d, e = discounted(two.values()), discounted(cont.values())
    rest = sum(e[min(c, 3)] for c in cont.values()) / pairs

    def low(w):
        return (cont[w] - e[min(cont[w], 3)]) / pairs + rest / (types + 1)

    def p(v, w):
        if v not in ctx:
            return low(w)
        c, (total, *classes) = two.get((v, w), 0), ctx[v]
        return (c - d[min(c, 3)]) / total + sum(x * y for x, y in zip(d[1:], classes)) / total * low(w)

    # Probabilities of all tokens after a context, and of an unknown one, add up.
    some = next(v for v in ctx if v and ctx[v][0] > 3)
    assert sum(p(some, w) for w in one) + p(some, "unknown word") == pytest.approx(1)
    better = 0.0
    for r in lm.op10_lm(spark, SMALL).collect():
        w = tokens[r["doc_id"]]
        base = sum(math.log10((one[x] + 0.5) / (n + 0.5 * (types + 1))) for x in w)
        score = sum(math.log10(p(v, x)) for v, x in zip(["<s>", *w[:-1]], w))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(w), sum(one[x] > 0 for x in w), n, held[r["doc_id"]])
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)
        better += (r["score"] - r["base_score"]) * held[r["doc_id"]]
    assert better > 0


def test_neighbours_recall(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = collections.defaultdict(list)
    for r in nndescent.op8_neighbours(spark, sf_dir).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q]
        found = got[ids[q]]
        assert len(found) == 5 and [b for _, b in found] == sorted((b for _, b in found), reverse=True)
        for i, score in found:
            assert score == pytest.approx(s[ids == i][0], abs=1e-12)
        s[q] = -2
        hits += len(set(ids[np.lexsort((ids, -s))[:5]]) & {i for i, _ in found})
        total += 5
    assert hits / total >= 0.95


@pytest.mark.parametrize("noise", [0.03, 0.0003])
def test_neighbours_among_near_copies(spark, noise):
    """A third of the vectors are near copies of one."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 64))
    x[::3] = x[0] + noise * rng.normal(size=(1000, 64))
    x = x.astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = collections.defaultdict(set)
    for r in nndescent.nearest(rows, F.col("id") % 30 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    hits = 0
    for q in range(0, 3000, 30):
        s = unit @ unit[q]
        s[q] = -2
        hits += len(set(np.argsort(-s)[:5].tolist()) & got[q])
    assert hits / 500 >= 0.95, hits


def test_automaton_equals_edit_distance():
    terms, stems = ("idiot", "moron", "loser", "ass"), ("xyz",)
    automaton = toxicity.Automaton(terms, stems)

    def near(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    rng = random.Random(4)
    for _ in range(4000):
        word = list(rng.choice(terms))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(word) + 1)
            word[at: at + rng.randrange(2)] = rng.choice(["", "a", "o", "x"])
        word = "".join(word)
        want = "term" if word in terms else "fuzzy" if any(len(t) >= 5 and near(word, t) for t in terms) else ""
        assert automaton.kind(word) == want, word
    assert automaton.kind("xyzabc") == "stem" and automaton.kind("xy") == ""


def test_quotation_counts_less_than_abuse():
    scorer = toxicity.Scorer(toxicity.Model())
    abuse, plain, quoted = (scorer.score(t)[0] for t in ("you are an idiot", "what an idiot", 'he wrote the word "idiot" there'))
    assert abuse >= plain > quoted and plain >= toxicity.THRESHOLD > quoted


def test_toxicity_of_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = toxicity.op1_toxicity(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in rows.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.85 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.01 * n[0, 0]


def test_language_of_documents_and_pages(spark):
    rows = language.op3_language(spark, "/root/testdata/sf0.01")
    right, kept, all_ = rows.agg(F.sum((F.col("declared") == F.col("language")).cast("int")), F.sum(F.col("kept").cast("int")), F.count("*")).first()
    assert right >= 0.99 * all_ and kept >= 0.99 * all_
    rows = language.language_of_pages(spark, "/root/testdata/sf0.01")
    right, all_ = rows.agg(F.sum((F.col("declared") == F.col("language")).cast("int")), F.count("*")).first()
    assert all_ == 250 and right >= 0.97 * all_


def test_pipeline_equals_its_parts(spark):
    """Each stage's decisions, made again from the operators' own results, lead to the same documents."""
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, SMALL)
        ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
        if name == "language":
            want = {r["doc_id"] for r in language.identify(docs).filter("lid_kept").collect()}
        elif name == "toxicity":
            model = toxicity.learn_from_tables(spark, docs, SMALL)
            want = {r["doc_id"] for r in toxicity.score_texts(docs, model).collect() if r["tox_score"] < toxicity.THRESHOLD}
        else:
            found = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])
            want = {i for i, (_, c) in found.items() if i == c}
        assert ids == want and kept.columns == docs.columns
        docs = kept.checkpoint()
    sized = mixing.mix(docs.withColumn("size", mixing.word_count(F.col("text"))))
    mixed = mixing.take_copies(spark, docs, SMALL)
    copies = {r["doc_id"]: r["copies"] for r in sized.collect() if r["copies"]}
    assert collections.Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == collections.Counter(copies)
    packed = corpus_pipeline.run(spark, SMALL)
    ends = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert {r["doc_id"]: r["n"] // r["t"] for r in ends} == copies
