"""Freed memory of a Python worker goes back to the system.

Workers serve task after task, and what a task frees stays with the process
(in the C library's heap and in Arrow's pool) unless it is given back.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

from sylvan.llm.common import by_value

by_value(__name__)


def give_back() -> None:
    """Return free pages to the system; without effect where the C library cannot."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(rows: Callable) -> Callable:
    """``rows`` over a task's batches; before it what earlier tasks left is given back, after it what it left itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from rows(batches)
        give_back()

    return run


def released_group(reduce: Callable) -> Callable:
    """``reduce`` over a group; after each what it freed is given back."""
    def run(group: pa.Table) -> pa.Table:
        out = reduce(group)
        give_back()
        return out

    return run
