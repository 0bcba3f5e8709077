"""Toxicity scores from a lexicon trie that is intersected with Levenshtein automata.

The lexicon holds whole words and word stems.  Stems match any ending; words and
stems of at least ``MIN_FUZZY`` letters also match with one edit.  The automaton is the
set of (trie node, edits so far) pairs that the letters read so far allow; such
sets and their moves are kept as they turn up, so most words die after two or
three letters, and each worker looks at a word only once.

Words and stems beyond a short seed list are learned from labelled rows: those
whose rate in toxic rows exceeds their rate in clean rows by far more than
chance allows.  Each hit counts by its context window: little inside quotation
marks, also those around whole phrases and sentences, less near a reporting
word, more near a second person outside the quotation.  A logistic
model over the counted hits of each kind and the length of the text gives the
score.

Learning uses at most ``SAMPLE_ROWS`` labelled rows (smallest id hashes first);
scoring reads every whole text, row by row in scan order, without a shuffle.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm.common import bounded_batches, by_value, materialize, table
from sylvan.llm.memory import give_back, released

by_value(__name__)

#: Labelled rows used for learning, toxic-side candidates and lexicon entries, at most.
SAMPLE_ROWS = 20_000
CANDIDATES = 50_000
LEXICON_TERMS = 2_000
STEM_LENGTHS = (3, 4, 5, 6, 7, 8)
MIN_FUZZY = 5
#: Evidence (nats) and excess rate that a learned entry needs.
MIN_EVIDENCE, MIN_EXCESS = 18.0, 6.0
#: Words on each side of a hit that speak about its use.
WINDOW = 5
THRESHOLD = 0.7

#: Words that count as abuse before any row is labelled.
SEED_TERMS = ("idiot", "moron", "stupid", "loser", "scum", "pathetic", "worthless", "disgusting", "imbecile", "bastard", "dumbass")
REPORTING = frozenset("said says called wrote quoted quote word term insult dit écrit sagte schrieb dijo escribió".split())
SECOND_PERSON = frozenset("you your youre du dich dein tu toi vous votre tú usted".split())
#: What a hit counts in such a window; factors multiply.
QUOTED, REPORTED, ADDRESSED = 0.1, 0.5, 1.5

#: Weights before any row is labelled, in the order of Scorer.features, and the intercept.
SEED_WEIGHTS = (3.0, 2.0, 0.0, 0.0, 1.0, 0.0)
SEED_INTERCEPT = -3.0

TOKEN = re.compile(r"[^\W_]+")


#: Quotation marks that open, with those that close them (German “ and » also close, and « and » stand either way).
CLOSING = {"\"": "\"", "“": "”", "”": "”", "„": "“”", "«": "»", "»": "«", "‘": "’", "’": "’"}
#: Where a quotation ends at the latest: a line, or so many characters.
LONGEST_QUOTATION = 1_000


def quotations(text: str) -> list[tuple[int, int]]:
    """Spans from an opening mark to its closing one, in order and without overlap, within a line.

    A mark opens unless a letter or digit stands before it (else it is an
    apostrophe), and closes unless one stands after it.  An open mark without
    a closing one quotes nothing.
    """
    out, at = [], 0
    for mark in OPENING.finditer(text):
        a = mark.start()
        if a < at or (a and text[a - 1].isalnum()):
            continue
        for close in CLOSERS[text[a]].finditer(text, a + 1, a + LONGEST_QUOTATION):
            b = close.start()
            if close[0] == "\n":
                break
            if b > a + 1 and not text[b + 1: b + 2].isalnum():
                out.append((a, b))
                at = b + 1
                break
    return out


OPENING = re.compile("[" + "".join(CLOSING) + "]")
CLOSERS = {o: re.compile(f"[{c}\n]") for o, c in CLOSING.items()}


class Automaton:
    """Lexicon trie times Levenshtein automaton of at most one edit, made deterministic as words need it."""

    def __init__(self, terms, stems, min_fuzzy: int = MIN_FUZZY, keep: int = 20_000):
        self.children: list[dict[str, int]] = [{}]
        self.term = [0]
        self.stem = [0]
        for entry, is_stem in [(t, False) for t in terms] + [(s, True) for s in stems]:
            node = 0
            for letter in entry:
                nxt = self.children[node].get(letter)
                if nxt is None:
                    nxt = self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(0)
                    self.stem.append(0)
                node = nxt
            if is_stem:
                self.stem[node] = len(entry)
            else:
                self.term[node] = len(entry)
        self.min_fuzzy, self.keep = min_fuzzy, keep
        self.moves: dict[tuple[frozenset, str], frozenset] = {}
        self.start = self._closed({(0, 0)})

    def _closed(self, state: set) -> frozenset:
        """With a letter of the term left out."""
        return frozenset(state | {(c, 1) for node, edits in state if edits == 0 for c in self.children[node].values()})

    def _move(self, state: frozenset, letter: str) -> frozenset:
        key = (state, letter)
        found = self.moves.get(key)
        if found is None:
            nxt = set()
            for node, edits in state:
                same = self.children[node].get(letter)
                if same is not None:
                    nxt.add((same, edits))
                if edits == 0:
                    nxt.add((node, 1))
                    nxt.update((c, 1) for c in self.children[node].values())
            found = self._closed(nxt)
            if len(self.moves) >= self.keep:
                self.moves.clear()
            self.moves[key] = found
        return found

    def kind(self, word: str) -> str:
        """``term``, ``stem``, ``fuzzy`` or the empty string."""
        state, stem, near = self.start, False, False
        for letter in word:
            state = self._move(state, letter)
            if not state:
                return "stem" if stem else "fuzzy" if near else ""
            stem = stem or any(edits == 0 and self.stem[node] for node, edits in state)
            near = near or any(edits == 1 and self.stem[node] >= self.min_fuzzy for node, edits in state)
        if any(edits == 0 and self.term[node] for node, edits in state):
            return "term"
        if stem:
            return "stem"
        return "fuzzy" if near or any(edits == 1 and self.term[node] >= self.min_fuzzy for node, edits in state) else ""


@dataclass
class Model:
    """Lexicon and weights; small enough (see the bounds above) to be sent with each task."""

    terms: tuple[str, ...] = SEED_TERMS
    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = SEED_WEIGHTS
    intercept: float = SEED_INTERCEPT
    #: Distinct labelled texts that it was learned from.
    learned_from: int = 0


class Scorer:
    """Scores texts with a model; keeps the kind of each word it has seen."""

    def __init__(self, model: Model, keep: int = 50_000):
        self.automaton = Automaton(model.terms, model.stems)
        self.kinds: dict[str, str] = {}
        self.keep = keep
        self.model = model

    def hits(self, text: str) -> tuple[list[tuple[str, str, float]], int]:
        """(kind, word, what it counts in its window) of every hit in order, and the number of words."""
        low = text.lower()
        words = TOKEN.findall(low)
        kinds = self.kinds
        fresh = {w for w in words if w not in kinds}
        if fresh:
            if len(kinds) > self.keep:
                kinds.clear()
                fresh = set(words)
            kinds.update((w, self.automaton.kind(w)) for w in fresh)
        at = [i for i, w in enumerate(words) if kinds[w]]
        if not at:
            return [], len(words)
        spans = [m.span() for m in TOKEN.finditer(low)]
        quoted = [False] * len(words)
        starts = [a for a, _ in spans]
        for a, b in quotations(low):
            i, j = bisect_left(starts, a), bisect_left(starts, b)
            quoted[i:j] = [True] * (j - i)
        out = []
        for i in at:
            near = words[max(0, i - WINDOW): i] + words[i + 1: i + 1 + WINDOW]
            counts = QUOTED if quoted[i] else 1.0
            counts *= REPORTED if any(w in REPORTING for w in near) else 1.0
            about = range(max(0, i - WINDOW), min(len(words), i + 1 + WINDOW))
            counts *= ADDRESSED if any(words[k] in SECOND_PERSON and k != i and not quoted[k] for k in about) else 1.0
            out.append((kinds[words[i]], words[i], counts))
        return out, len(words)

    def features(self, text: str) -> tuple[list[float], int]:
        """What the logistic model sees, and the number of hits."""
        hits, n_words = self.hits(text)
        term = sum(c for kind, _, c in hits if kind == "term")
        fuzzy = sum(c for kind, _, c in hits if kind == "fuzzy")
        stemmed: dict[str, float] = {}
        for kind, word, c in hits:
            if kind == "stem":
                weight = max(self.model.stems.get(word[:n], 0.0) for n in STEM_LENGTHS)
                stemmed[word] = max(stemmed.get(word, 0.0), c * weight)
        stem = sum(stemmed.values())
        length = math.log1p(n_words)
        return [min(term, 1.0), math.log1p(term), math.log1p(stem), stem / (1.0 + length * math.sqrt(n_words) / 10),
                math.log1p(fuzzy) / (1.0 + length), length / 10], len(hits)

    def score(self, text: str) -> tuple[float, int]:
        found, hits = self.features(text)
        odds = self.model.intercept + sum(w * x for w, x in zip(self.model.weights, found))
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, odds)))), hits


def _entries(text: str) -> list[str]:
    """The distinct words of a text, and for each its stems with a star."""
    words = set(TOKEN.findall(text.lower()))
    return [*words, *(f"{w[:n]}*" for w in words for n in STEM_LENGTHS if len(w) > n)]


def _counted(rows: DataFrame, only: frozenset | None = None) -> DataFrame:
    """``(entry, n)``: rows with each word, and distinct words of rows with each stem, counted per task first.

    ``only``: these entries.  The empty entry counts all distinct words.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _entries(text or "")
                seen[""] += sum(not e.endswith("*") for e in found)
                seen.update(found if only is None else [e for e in found if e in only])
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["entry", "n"])

    return rows.select("text").mapInArrow(released(count), "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))


def _word_sequence() -> Column:
    """A 128-bit hash of the whole text's words in order, which only copies share."""
    words = F.array_join(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != ""), " ")
    return F.md5(words)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    """A model from labelled rows; without any (or without both classes) the seed model."""
    bounded_batches(docs.sparkSession)
    chosen = (labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
              .orderBy(F.md5(F.col(id_col).cast("string")), id_col).limit(sample_rows))
    # At most sample_rows rows of two numbers are broadcast.
    rows = (docs.select(F.col(id_col), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
            .join(F.broadcast(chosen), id_col).select("text", "toxic"))
    rows = materialize(rows, "toxic-sample")
    # Copies of one text are one piece of evidence.
    single = rows.withColumn("words", _word_sequence()).dropDuplicates(["words", "toxic"])
    single = materialize(single.select("text", "toxic"), "toxic-single")
    n = dict(single.groupBy("toxic").count().collect())
    if not n.get(1) or not n.get(0):
        return Model()
    toxic, clean = single.filter("toxic = 1"), single.filter("toxic = 0")
    pos = dict(_counted(toxic).filter(F.col("n") >= 5).orderBy(F.desc("n"), "entry").limit(CANDIDATES).collect())
    neg = dict(_counted(clean, frozenset(pos)).collect())
    share = pos.get("", 0) / max(1, pos.get("", 0) + neg.get("", 0))
    found = []
    for entry, p in pos.items():
        q = neg.get(entry, 0)
        got = p / (p + q)
        evidence = p * math.log(got / share) + (q * math.log((1 - got) / (1 - share)) if q else 0.0)
        excess = (p / share) / ((q + 0.5) / (1 - share))
        if entry and got > share and excess >= MIN_EXCESS and evidence >= MIN_EVIDENCE:
            found.append((evidence, len(entry), entry, math.log(excess)))
    found = sorted(found, reverse=True)[:LEXICON_TERMS]
    # Of nested stems the one with most evidence stays.
    stems: dict[str, float] = {}
    for _, _, entry, weight in found:
        stem = entry[:-1]
        if entry.endswith("*") and not any(stem.startswith(s) or s.startswith(stem) for s in stems):
            stems[stem] = weight
    terms = {e for _, _, e, _ in found if not e.endswith("*")}
    # A word that its stem explains is left to the stem, and a stem of one term only to the term.
    alone = {s for s in stems if any(t.startswith(s) and pos[t] >= 0.9 * pos[s + "*"] for t in terms)}
    stems = {s: w for s, w in stems.items() if s not in alone}
    terms = {t for t in terms if not any(t.startswith(s) for s in stems)} | set(SEED_TERMS)
    return replace(_fitted(Model(tuple(sorted(terms)), stems), single), learned_from=n[0] + n[1])


def _fitted(model: Model, rows: DataFrame) -> Model:
    """Weights of the logistic model from the sample's rows."""
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = [scorer.features(t)[0] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1).cast(pa.float64())], ["x", "label"])

    given = rows.select("text", "toxic").mapInArrow(released(features), "x array<double>, label double")
    given = materialize(given, "toxic-features").withColumn("features", array_to_vector("x"))
    fit = LogisticRegression(regParam=1e-3, maxIter=50, standardization=True).fit(given)
    return Model(model.terms, model.stems, tuple(float(w) for w in fit.coefficients), float(fit.intercept))


def score_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``tox_score`` (0 to 1) and ``tox_hits``.

    Null and empty texts have no hits and score like any text without one.
    Repeated rows score alike.  An empty table gives none.  Columns named like
    an output are replaced.
    """
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("struct<score: double, hits: long>")
    def scored(texts: pa.Array) -> pa.Array:
        scorer = scored.__dict__.get("scorer")
        if scorer is None:
            give_back()  # what earlier tasks of this worker left
            scorer = scored.__dict__["scorer"] = Scorer(model)
        out = [scorer.score(t) for t in texts.fill_null("").to_pylist()]
        return pa.StructArray.from_arrays([pa.array([s for s, _ in out], pa.float64()), pa.array([h for _, h in out], pa.int64())], ["score", "hits"])

    rows = docs.withColumn("_tox", scored(F.col(text_col)))
    return rows.withColumn("tox_score", F.col("_tox.score")).withColumn("tox_hits", F.col("_tox.hits")).drop("_tox")


def held_out(id_col: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def learn_from_tables(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    return learn(docs, labels)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, learn_from_tables(spark, docs, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("tox_score").alias("score"),
                         F.when(F.col("tox_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), F.col("tox_hits").alias("hits"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose text scores below the threshold, with their columns."""
    scored = score_texts(docs, learn_from_tables(spark, docs, sf_dir))
    return scored.filter(F.col("tox_score") < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLES: dict[str, str] = {}
