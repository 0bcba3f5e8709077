"""Cost-balanced packing of tokenized documents into training sequences.

A sequence costs ``linear * tokens + quadratic * sum(piece length ** 2)`` (each
piece attends to itself).  Within a chunk of documents the number and the
capacities of the sequences are planned from the token total: full sequences of
``max_tokens`` and, for the rest, the powers of two that add up to it, so
nothing has to be padded.  Documents are assigned by descending cost to the
lowest-cost sequence with enough capacity left; one that fits nowhere whole is
cut over the roomiest sequences.  Documents longer than a sequence first give
whole sequences of their own.

A chunk is a run of rows of one scan partition with about ``chunk_tokens``
tokens: nothing is shuffled or collected, a task holds one chunk at a time, and a
lost task gives the same pieces again.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm.common import bounded_batches, by_value, table
from sylvan.llm.memory import released

by_value(__name__)

MAX_TOKENS = 4096
END_ID = 2
CHUNK_TOKENS = 2_000_000
#: Cost of a token, and of a pair of tokens of one piece.
LINEAR, QUADRATIC = 1.0, 1.0 / 6144
#: Words whose ids a worker keeps.
CACHE_WORDS = 600_000

SCHEMA = ("{id} {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_length long, sequence_cost double")


def byte_letters() -> dict[int, str]:
    """The printable letter that a byte-level vocabulary writes for each byte: itself, or the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


#: A word of Western letters and at most one closing mark: lower-casing and splitting it need no tokenizer.
SIMPLE_WORD = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]?)")


class Cache(dict):
    """A dict that computes missing values and starts anew when it holds ``limit`` of them."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class WordEncoder:
    """Ids of texts, from the ids of their words between ASCII white space.

    The tokenizer drops white space and never joins characters across it, so the
    ids of a text are those of its words one after the other.  Words and their
    letter runs are kept in two bounded caches; of a word of Western letters
    only the run goes through the vocabulary's merges.
    """

    def __init__(self, tokenizer_path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.words = Cache(self._word, cache_words)
        self.runs = Cache(self._run, cache_words)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _run(self, run: str) -> bytes:
        written = run if run.isascii() else "".join([self.letters[b] for b in run.encode("utf-8")])
        return self._packed([t.id for t in self.model.tokenize(written)] if written else [])

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        simple = SIMPLE_WORD.fullmatch(text)
        if simple:
            return self.runs[simple[1].lower()] + self.runs[simple[2]]
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids_of = self.words.__getitem__
        return [b"".join(map(ids_of, text.split())) for text in texts]


def capacities(total: int, max_tokens: int) -> np.ndarray:
    """Full sequences, then the powers of two of what remains, adding up to ``total``."""
    full, rest = divmod(total, max_tokens)
    tail = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    return np.array([max_tokens] * full + tail, dtype=np.int64)


def pack_lengths(lengths, max_tokens: int = MAX_TOKENS, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Pieces ``(document, start, length, sequence, offset)``, sequence lengths and costs of one chunk."""
    lengths = np.asarray(lengths, dtype=np.int64)
    pieces: list[tuple[int, int, int, int, int]] = []
    whole = lengths // max_tokens
    seq_len: list[int] = []
    for d in np.flatnonzero(whole):
        for k in range(whole[d]):
            pieces.append((int(d), k * max_tokens, max_tokens, len(seq_len), 0))
            seq_len.append(max_tokens)
    base = len(seq_len)
    rest = lengths - whole * max_tokens
    room = capacities(int(rest.sum()), max_tokens)
    size = room.copy()
    cost = np.zeros(len(room))
    weight = linear * rest + quadratic * rest.astype(float) ** 2
    for d in np.lexsort((np.arange(len(rest)), -weight)):
        left, at = int(rest[d]), int(whole[d]) * max_tokens
        while left:
            fits = np.flatnonzero(room >= left)
            if len(fits):
                s, n = int(fits[np.argmin(cost[fits])]), left
            else:
                s = int(np.argmax(room))
                n = int(room[s])
            pieces.append((int(d), at, n, base + s, int(size[s] - room[s])))
            room[s] -= n
            cost[s] += linear * n + quadratic * n * n
            at += n
            left -= n
    full_cost = linear * max_tokens + quadratic * max_tokens * max_tokens
    return pieces, seq_len + size.tolist(), [full_cost] * base + cost.tolist()


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         max_tokens: int = MAX_TOKENS, end_id: int = END_ID, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per piece: id, start, length, crc of its ids, document tokens, sequence, offset, its length and cost.

    Null and empty texts are the end id alone.  Null and repeated ids are
    carried along; each input row is its own document.  Documents of equal cost
    keep the order of the scan.  An empty table gives no rows; other columns of
    ``docs`` are not read.
    """
    bounded_batches(docs.sparkSession)
    schema = SCHEMA.format(id=f"`{id_col}`", id_type=docs.schema[id_col].dataType.simpleString())
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        first = TaskContext.get().partitionId() << 40
        ids, data, tokens, done = [], [], 0, 0

        def flush():
            nonlocal done
            lengths = [len(b) // 4 for b in data]
            pieces, seq_len, seq_cost = pack_lengths(lengths, max_tokens)
            doc, start, length, seq, offset = (np.array(c, dtype=np.int64) for c in zip(*pieces))
            crc = [zlib.crc32(memoryview(data[d])[4 * a: 4 * (a + n)]) for d, a, n, _, _ in pieces]
            columns = [pa.chunked_array(ids).combine_chunks().take(pa.array(doc)), start, length,
                       np.array(crc, dtype=np.int64), np.array(lengths, dtype=np.int64)[doc], first + done + seq, offset,
                       np.array(seq_len, dtype=np.int64)[seq], np.array(seq_cost, dtype=float)[seq]]
            done += len(seq_len)
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                     "sequence_length", "sequence_cost"]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.large_binary())
            at, n = 0, batch.num_rows
            step = 256
            while at < n:
                part = texts.slice(at, step)
                data += [b + end for b in encoder.encode(part.to_pylist())]
                ids.append(batch.column(0).slice(at, step))
                tokens += sum(len(b) for b in data[-len(part):]) // 4
                at += step
                if tokens >= chunk_tokens:
                    yield flush()
                    ids, data, tokens = [], [], 0
        if data:
            yield flush()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(released(rows), schema)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_file())


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents that came this far."""
    return pack(docs, tokenizer_file())


QUERIES = {"op9_packing": op9_packing}
ORACLES: dict[str, str] = {}
