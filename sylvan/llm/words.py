"""Word and shingle hashes of whole Arrow batches, by numpy over the text bytes.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  All separators are ASCII,
so bytes of UTF-8 text can be used as they are.  Texts are worked on in
segments of a few MB that end at a separator, so memory does not grow with the
length of a text beyond 8 bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from sylvan.llm.common import by_value

by_value(__name__)

SEGMENT = 500_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SEP = np.zeros(256, dtype=bool)
SEP[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C55 | 1)
_POW = np.ones(64, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POW
    if n > len(_POW):
        grown = np.full(max(n, 2 * len(_POW)), _BASE, dtype=np.uint64)
        grown[0] = 1
        _POW = np.cumprod(grown, dtype=np.uint64)
    return _POW


_POW[1:] = _BASE
_POW = np.cumprod(_POW, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix (splitmix64); ``x`` is not changed."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string column; null texts are empty."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw, bounds


def _segment_hashes(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and word starts of one segment; ``breaks``: places where a new text begins."""
    low = LOWER[data]
    word = ~SEP[low]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    before[breaks] = False
    starts = np.flatnonzero(word & ~before)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    after[breaks[breaks > 0] - 1] = False
    ends = np.flatnonzero(word & ~after)
    lengths = ends - starts + 1
    at = np.flatnonzero(word)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(first, lengths)
    terms = _powers(int(lengths.max()))[place]
    terms *= low[at].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(terms, first)
    return mix(sums + lengths.astype(np.uint64)), starts


def word_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the word offsets of each text (one more than texts)."""
    out, places = [], []
    a, last = int(bounds[0]), int(bounds[-1])
    while a < last:
        b = min(a + SEGMENT, last)
        while b < last and not SEP[raw[b - 1]]:
            gap = np.flatnonzero(SEP[raw[b: b + 65536]])
            nxt = b + (int(gap[0]) + 1 if len(gap) else min(65536, last - b))
            cut = np.searchsorted(bounds, b, "left")
            b = min(nxt, int(bounds[cut])) if bounds[cut] >= b else nxt
            if bounds[np.searchsorted(bounds, b, "left")] == b:
                break
        lo, hi = np.searchsorted(bounds, a, "left"), np.searchsorted(bounds, b, "left")
        hashes, starts = _segment_hashes(raw[a:b], np.unique(bounds[lo:hi] - a))
        out.append(hashes)
        places.append(starts + a)
        a = b
    hashes = np.concatenate(out) if out else np.empty(0, dtype=np.uint64)
    starts = np.concatenate(places) if places else np.empty(0, dtype=np.int64)
    return hashes, np.searchsorted(starts, bounds, "left")


_SHINGLE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                     0x589965CC75374CC3], dtype=np.uint64)


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; fewer words: the whole sequence as one."""
    n = len(words)
    if n == 0:
        return words
    take = min(width, n)
    keys = np.resize(_SHINGLE, take) if take <= len(_SHINGLE) else mix(np.arange(1, take + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.full(n - take + 1, np.uint64(take), dtype=np.uint64)
    for j in range(take):
        total += words[j: n - take + 1 + j] * keys[j]
    return np.unique(mix(total))
