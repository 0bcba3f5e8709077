"""md5 of many short texts at once, by numpy on 32-bit words.

The same digests as Spark's ``md5``.  Texts that begin alike (a row's id under many
keys) share the work up to the first word in which they differ.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: Texts that are hashed together: a few arrays of their words stay in a core's cache.
TOGETHER = 16_384

_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_ADDED = [int(abs(np.sin(np.float64(i + 1))) * 2.0**32) for i in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_WORD = [[i, (5 * i + 1) % 16, (3 * i + 5) % 16, 7 * i % 16][i // 16] for i in range(64)]


def _steps(state: list[np.ndarray], words: list, first: int, last: int) -> list[np.ndarray]:
    """Steps ``first`` to ``last`` of a block; ``state`` is overwritten.  A word is a number or an array that spreads over the state."""
    a, b, c, d = state
    new, turned = np.empty_like(a), np.empty_like(a)
    for i in range(first, last):
        kind = i // 16
        if kind == 0:
            np.bitwise_xor(c, d, out=new)
            new &= b
            new ^= d
        elif kind == 1:
            np.bitwise_xor(b, c, out=new)
            new &= d
            new ^= c
        elif kind == 2:
            np.bitwise_xor(b, c, out=new)
            new ^= d
        else:
            np.invert(d, out=new)
            new |= b
            new ^= c
        new += a
        word = words[_WORD[i]]
        new += np.uint32((word + _ADDED[i]) & 0xFFFFFFFF) if isinstance(word, int) else word + np.uint32(_ADDED[i])
        turn = _TURNS[kind][i % 4]
        np.left_shift(new, turn, out=turned)
        new >>= 32 - turn
        new |= turned
        new += b
        a, b, c, d, new = d, new, b, c, a
    return [a, b, c, d]


def _block(state: list, words: list, shape: tuple[int, int]) -> list[np.ndarray]:
    """The state after a block; ``words`` and ``state`` spread over ``shape``, whose first axis is that of the text's ends."""
    shared = 0
    if shape[0] > 1 and all(np.shape(s) != shape for s in state):
        # Until a word differs between the ends, they are one.
        while shared < 16 and not (isinstance(words[shared], np.ndarray) and words[shared].shape[0] > 1):
            shared += 1
    if shared:
        now = _steps([np.array(np.broadcast_to(np.uint32(s), (1, shape[1]))) for s in state], words, 0, shared)
        now = [np.array(np.broadcast_to(s, shape)) for s in now]
    else:
        now = [np.array(np.broadcast_to(np.uint32(s), shape)) for s in state]
    now = _steps(now, words, shared, 64)
    for s, before in zip(now, state):
        s += np.uint32(before) if np.isscalar(before) else before
    return now


def digests(begins: np.ndarray, ends: list[bytes]) -> list[np.ndarray]:
    """The four words of the md5 of each row of bytes ``begins`` with each of ``ends`` (of one length) after it, by end and row.

    A word's bytes are the digest's from last to first.
    """
    n, length = begins.shape
    whole = length + len(ends[0])
    blocks = (whole + 9 + 63) // 64
    common = length // 4  # words without a byte of an end
    filled = np.zeros((n, 4 * -(-length // 4)), np.uint8)
    filled[:, :length] = begins
    from_rows = np.ascontiguousarray(filled.view("<u4").T)
    tails = np.zeros((len(ends), 64 * blocks), np.uint8)
    tails[:, length:whole] = np.frombuffer(b"".join(ends), np.uint8).reshape(len(ends), -1)
    tails[:, whole] = 0x80
    tails[:, -8:] = np.frombuffer((8 * whole).to_bytes(8, "little"), np.uint8)
    from_ends = np.ascontiguousarray(tails.view("<u4").T)
    words: list = []
    for i in range(16 * blocks):
        end = from_ends[i][:, None]
        end = int(end[0, 0]) if (end == end[0]).all() else end
        row = None if i >= len(from_rows) else from_rows[i][None, :]
        if row is not None and (row == row[0, 0]).all():
            row = int(row[0, 0])
        if i < common:
            words.append(row)
        elif row is None or isinstance(row, int) and isinstance(end, int):
            words.append(end if row is None else row | end)
        else:
            words.append(np.uint32(row) | np.uint32(end))
    state: list = [np.uint32(s) for s in _START]
    for k in range(blocks):
        block = words[16 * k: 16 * k + 16]
        wide = k * 64 + 64 > length or any(np.shape(s)[:1] == (len(ends),) for s in state)
        state = _block(state, block, (len(ends) if wide else 1, n))
    return [np.broadcast_to(s, (len(ends), n)) for s in state]
