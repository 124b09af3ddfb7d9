"""Memory of Python workers, which outlive their tasks.

A worker waits for its next task beside the executor that it belongs to. Freed memory stays with the allocators and tables stay
cached meanwhile, and count as the executor's while a stage without Python needs the room. Functions for `mapInArrow` go through
`settled`, which gives both back when a task ends.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa

from lakekit.llm import arrays

_TABLES: list = []  # the cached functions of this process


def table(make):
    """`make` cached: its results serve the tasks that keep them, and go when the worker turns to other work."""
    cached = lru_cache(maxsize=2)(make)
    _TABLES.append(cached)
    return cached


@lru_cache(maxsize=1)
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone


def begin(keep=None) -> None:
    for cached in _TABLES:
        if cached is not keep:
            cached.cache_clear()


def end() -> None:
    arrays.forget_powers()
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim is not None:
        trim(0)


def settled(run, keep=None):
    """`run` with what it freed given back at its end; of the tables only those of `keep` outlast its beginning."""
    def settling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(keep)
        try:
            yield from run(batches)
        finally:
            end()

    return settling
