"""Best-fit packing with a swap-based local search: whole documents in as few sequences as possible.

1. One scan encodes every whole text and writes its pieces (id, place, length, crc
   of the token ids; the ids themselves are not kept).  Only a document longer than
   a sequence is cut, into full pieces behind a first one that may be shorter.
2. A full piece is a sequence.  All others are dealt by a hash over groups of about
   ``GROUP_PIECES``; the number of groups comes from a count over the written pieces.
3. Each group is packed best-fit.  While it needs more sequences than its lower
   bound, the local search takes the least filled sequence and hands length to other
   underfull ones: it moves a piece, exchanges one for one, two for one or one for
   two, always so that the sum of squared fills grows, until that sequence is empty
   or nothing improves.

A sequence that stays underfull costs at most one in a group, and a group holds
thousands, so the total stays within a few of the lower bound at any scale.  A group
is a fixed number of small rows whatever the table's size; texts are never shuffled.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm.common import bounded_batches, by_value, materialize, table
from sylvan.llm.packing import byte_letters

by_value(__name__)

MAX_TOKENS = 2048
END_ID = 0
#: Pieces that are packed together, about.  It sets the tasks' size, and a group wastes at most about one sequence.
GROUP_PIECES = 20_000
#: Two-piece exchanges look at pairs of this many longest pieces of a sequence (single ones at all pieces).
PAIRED = 8

PIECE_SCHEMA = "{id} {id_type}, piece int, start long, length long, ids_crc32 long, doc_tokens long, piece_row long"
OUT_SCHEMA = "{id} {id_type}, piece int, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

class ByteEncoder:
    """Ids of whole texts by the byte-level BPE of a tokenizer file: its vocabulary as ranks, its words cut by the public pattern."""

    def __init__(self, tokenizer_path: str):
        import public_tokenizers
        import tiktoken

        with open(tokenizer_path, encoding="utf-8") as f:
            told = json.load(f)
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        special = {t["content"] for t in told["added_tokens"]}
        self.byte_of, self.vocabulary = byte_of, told["model"]["vocab"]
        ranks = {self._bytes(entry): n for entry, n in self.vocabulary.items() if entry not in special}
        self.model = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _bytes(self, entry: str) -> bytes:
        return bytes([self.byte_of[c] for c in entry])

    def bytes(self) -> list[bytes]:
        """Bytes of each id."""
        return [self._bytes(entry) for entry, _ in sorted(self.vocabulary.items(), key=lambda e: e[1])]

    def ids(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit numbers; strings of special tokens are ordinary text."""
        return np.array(self.model.encode_ordinary(text), dtype="<u4")


def cut_lengths(n: int, max_tokens: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: full ones behind a first that may be shorter."""
    first = (n - 1) % max_tokens + 1
    return [(0, first)] + [(a, max_tokens) for a in range(first, n, max_tokens)]


def pieces_of(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, max_tokens: int, end_id: int) -> DataFrame:
    schema = PIECE_SCHEMA.format(id=f"`{id_col}`", id_type=docs.schema[id_col].dataType.simpleString())
    end = np.array([end_id], dtype="<u4")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(tokenizer_path)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cut = []
                for d, text in enumerate(part.column(1).fill_null("").to_pylist()):
                    ids = np.concatenate([encoder.ids(text), end])
                    cut += [(d, k, a, n, zlib.crc32(ids[a: a + n].tobytes()), len(ids))
                            for k, (a, n) in enumerate(cut_lengths(len(ids), max_tokens))]
                doc, piece, start, length, crc, tokens = (np.array(c, dtype=np.int64) for c in zip(*cut))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                     pa.array(crc), pa.array(tokens), pa.array(row + np.arange(len(doc)))],
                    [id_col, "piece", "start", "length", "ids_crc32", "doc_tokens", "piece_row"])
                row += len(doc)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(rows, schema)


def least_sequences(lengths: np.ndarray, max_tokens: int) -> int:
    """A lower bound: total length, and for each threshold the pieces too large to share with what must lie elsewhere."""
    lengths = np.sort(np.asarray(lengths, dtype=np.int64))[::-1]
    total = -(-int(lengths.sum()) // max_tokens)
    half = lengths[lengths <= max_tokens // 2]
    best = total
    for low in np.unique(half):
        sure = int((lengths > max_tokens - low).sum())
        mid = lengths[(lengths <= max_tokens - low) & (2 * lengths > max_tokens)]
        small = lengths[(2 * lengths <= max_tokens) & (lengths >= low)]
        more = -(-(int(small.sum()) - (len(mid) * max_tokens - int(mid.sum()))) // max_tokens)
        best = max(best, sure + len(mid) + max(0, more))
    return best


def best_fit(lengths: list[int], order: Iterable[int], max_tokens: int) -> list[list[int]]:
    """The pieces in an order, each into the fullest sequence that has room."""
    with_room: list[list[int]] = [[] for _ in range(max_tokens + 1)]
    rooms = 0  # bit r: some sequence has room r
    bins: list[list[int]] = []
    for p in order:
        n = lengths[p]
        found = rooms >> n
        if found:
            room = n + (found & -found).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = max_tokens, len(bins)
            bins.append([])
        bins[b].append(p)
        with_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins


class Search:
    """Local search over the underfull sequences of one group.

    A sequence offers to hand back nothing, one piece or two, and then has room for
    its *reach*: what it hands back and its room together.  Offers are kept by reach,
    those that hand back least first.  A step gives one or two pieces of the least
    filled sequence for an offer of the smallest reach that holds them (never two for
    two), so length moves to a fuller sequence, the sum of squared fills grows by two
    at least, and the search ends.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], max_tokens: int):
        self.lengths, self.max_tokens = lengths, max_tokens
        self.bins, self.fill = {}, {}
        # By number of pieces handed back, then by reach: sorted (length handed back, sequence, pieces).
        self.offers: list[list[list[tuple]]] = [[[] for _ in range(max_tokens + 1)] for _ in range(3)]
        self.reaches = [0, 0, 0]  # bit r: there are offers of reach r
        self.own: dict[int, list[tuple]] = {}
        for b, ps in enumerate(bins):
            fill = sum(lengths[p] for p in ps)
            if fill < max_tokens:
                self._put(b, list(ps), fill)

    def _put(self, b: int, pieces: list[int], fill: int) -> None:
        """Sequence ``b`` now holds ``pieces``; empty and full sequences make no offers."""
        for kind, reach, offer in self.own.pop(b, ()):
            at = self.offers[kind][reach]
            del at[bisect_left(at, offer)]
            if not at:
                self.reaches[kind] &= ~(1 << reach)
        self.bins[b], self.fill[b] = pieces, fill
        if not pieces or fill == self.max_tokens:
            return
        one = {self.lengths[p]: (p,) for p in pieces}
        two: dict[int, tuple] = {}
        longest = sorted(pieces, key=lambda p: -self.lengths[p])[:PAIRED]
        for i, p in enumerate(longest):
            for q in longest[:i]:
                two.setdefault(self.lengths[p] + self.lengths[q], (p, q))
        own = self.own[b] = []
        room = self.max_tokens - fill
        for kind, back in enumerate(({0: ()}, one, two)):
            for n, ps in back.items():
                offer = (n, b, ps)
                insort(self.offers[kind][n + room], offer)
                self.reaches[kind] |= 1 << (n + room)
                own.append((kind, n + room, offer))

    def _taker(self, kind: int, length: int, giver: int) -> tuple | None:
        """The offer of the smallest reach that holds ``length`` and hands back less."""
        reach, reaches = length, self.reaches[kind] >> length
        while reaches:
            skip = (reaches & -reaches).bit_length() - 1
            for offer in self.offers[kind][reach + skip]:
                if offer[0] >= length:
                    break
                if offer[1] != giver and self.fill[offer[1]] >= self.fill[giver]:
                    return offer
            reach += skip + 1
            reaches >>= skip + 1
        return None

    def step(self, a: int) -> bool:
        """The exchange that gains most among the best-fitting ones of sequence ``a``; False if there is none."""
        best = None
        for gives_kind, _, (given, _, go) in self.own[a]:
            for kind in range(3) if gives_kind == 1 else range(2 * (gives_kind == 2)):
                offer = self._taker(kind, given, a)
                if offer:
                    more = given - offer[0]
                    gain = more * (self.fill[offer[1]] - self.fill[a] + more)
                    if best is None or gain > best[0]:
                        best = (gain, more, go, offer)
        if best is None:
            return False
        _, more, go, (_, b, back) = best
        at_a = [p for p in self.bins[a] if p not in go] + list(back)
        at_b = [p for p in self.bins[b] if p not in back] + list(go)
        fill_a, fill_b = self.fill[a] - more, self.fill[b] + more
        self._put(a, at_a, fill_a)
        self._put(b, at_b, fill_b)
        return True

    def empty_sequences(self, wanted: int) -> None:
        """Empty up to ``wanted`` sequences, the least filled first; passes go on while they empty any."""
        before = -1
        while wanted > 0 and wanted != before:
            before = wanted
            tried: set[int] = set()
            order = [(self.fill[b], b) for b in self.own]
            heapify(order)
            while wanted > 0 and order:
                fill, a = heappop(order)
                if a in tried or a not in self.own or fill != self.fill[a]:
                    if a in self.own and a not in tried:
                        heappush(order, (self.fill[a], a))
                    continue
                tried.add(a)
                while a in self.own and self.step(a):
                    pass
                wanted -= not self.bins[a]


def pack_lengths(lengths, max_tokens: int = MAX_TOKENS) -> list[list[int]]:
    """Sequences as lists of piece numbers.

    Best-fit and the local search start from the longest piece; where that ends above
    the lower bound they start again from the given order, and the better result stays.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    each = lengths.tolist()
    least = least_sequences(lengths, max_tokens) if each else 0
    best = None
    for order in (sorted(range(len(each)), key=lambda p: -each[p]), range(len(each))):
        bins = best_fit(each, order, max_tokens)
        if len(bins) > least:
            search = Search(each, bins, max_tokens)
            search.empty_sequences(len(bins) - least)
            for b, ps in search.bins.items():
                bins[b] = ps
        bins = [ps for ps in bins if ps]
        if best is None or len(bins) < len(best):
            best = bins
        if len(best) <= least:
            break
    return best


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         max_tokens: int = MAX_TOKENS, end_id: int = END_ID, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: id, piece, start, length, crc of its ids, document tokens, sequence and offset there.

    Null and empty texts are the end id alone.  Null and repeated ids are carried
    along; each input row is its own document.  Pieces of equal length are taken in
    scan order.  An empty table gives no rows; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    pieces = materialize(pieces_of(docs, tokenizer_path, id_col, text_col, max_tokens, end_id), "pieces")
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = OUT_SCHEMA.format(id=f"`{id_col}`", id_type=id_type)
    names = [id_col, "piece", "start", "length", "ids_crc32", "doc_tokens"]
    short = F.col("length") < F.lit(max_tokens)
    groups = -(-pieces.filter(short).count() // group_pieces) or 1

    def packed(key, part):
        part = part.combine_chunks().sort_by("piece_row")
        sequences = pack_lengths(part["length"].to_numpy(), max_tokens)
        order = np.array([p for ps in sequences for p in ps], dtype=np.int64)
        length = part["length"].to_numpy()[order]
        size = np.array([len(ps) for ps in sequences])
        first = np.concatenate([[0], np.cumsum(length)[:-1]])
        offset = first - np.repeat(first[np.cumsum(size) - size], size)
        # Full pieces keep their row number, which is below 2 ** 62.
        number = (1 << 62) + (key[0].as_py() << 32) + np.repeat(np.arange(len(size)), size)
        out = part.take(pa.array(order)).select(names)
        return out.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    dealt = pieces.filter(short).withColumn("_group", F.pmod(F.xxhash64("piece_row"), F.lit(groups)))
    shared = dealt.groupBy("_group").applyInArrow(packed, schema)
    alone = pieces.filter(~short).select(*[F.col(f"`{c}`") for c in names], F.col("piece_row").alias("sequence_id"),
                                         F.lit(0).cast("long").alias("offset"))
    return shared.unionByName(alone)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_file())


QUERIES = {"op11_bestfit": op11_bestfit}
ORACLES: dict[str, str] = {}
