"""Array helpers for Arrow batches of texts: byte views, word spans and rolling hashes.

A chunk is a run of whole rows seen as one byte array plus row offsets. Chunks are
cut at CHUNK bytes, so the arrays derived from one stay small; only a single text
longer than that makes a larger chunk. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=4)
def _powers_of(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def powers(size: int, inverse: bool = False) -> np.ndarray:
    """The first `size` powers of the hash base, or of its inverse, modulo 2**64."""
    room = 1 << max(16, int(size).bit_length())
    return _powers_of(_INVERSE if inverse else _BASE, room)[:size]


def forget_powers() -> None:
    _powers_of.cache_clear()


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running polynomial hash: entry i covers values[:i]."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span [start, end), the same wherever the span stands."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), inverse=True)[start])


class Chunk:
    """Rows lo..hi of a batch: `data` holds their bytes, `offsets` where each row begins and the last ends."""

    __slots__ = ("lo", "hi", "data", "offsets")

    def __init__(self, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray):
        self.lo, self.hi, self.data, self.offsets = lo, hi, data, offsets

    @property
    def rows(self) -> int:
        return self.hi - self.lo

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array and its row offsets, without copying them."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, values = column.buffers()
    if len(column) == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """The rows of `column` in order, in chunks of about `limit` bytes."""
    data, offsets = byte_view(column)
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield Chunk(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def fold_case(data: np.ndarray) -> np.ndarray:
    """A copy with the bytes A-Z lower-cased."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def byte_class(keep) -> np.ndarray:
    """A table of 256 flags: which bytes satisfy `keep`."""
    return np.array([bool(keep(b)) for b in range(256)])


def word_spans(chunk: Chunk, data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in `data`, and where each row's words begin among them."""
    inside = is_word[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[chunk.offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, chunk.offsets)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + lengths[i] - 1 of all i, one after another."""
    total = int(lengths.sum())
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(shift, lengths)
