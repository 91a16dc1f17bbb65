"""Workers of Python that give memory back: allocators keep what they freed, and idle workers live on beside the JVM."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Hand freed memory of Arrow's pool and, where the C library can, of the heap to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Run) -> Run:
    """`run` for mapInArrow; freed memory goes back before each further batch and at the end of the task."""

    def fed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            give_back()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(fed(batches))
        finally:
            give_back()

    return whole
