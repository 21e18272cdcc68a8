"""Text columns as flat byte arrays: words, their hashes and positions for a whole Arrow batch at once.

Everything here works on rows that Spark has dealt to a task. Texts are never cut: a batch is split
between rows only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows one after another, and where each row begins; null reads as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, so that working arrays stay small.

    Behind the last one, memory that the worker has freed goes back to the system.
    """
    for batch in batches:
        _, offsets = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end
        del batch, offsets
    give_back()


def give_back() -> None:
    """Return freed memory to the system. A Python worker outlives its task, and so would what it has held."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes within rows, and the first run of each row."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[edges < len(inside)]
    first[edges] = inside[edges]
    before = edges[edges > 0] - 1
    last[before] = inside[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n-1, modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHasher:
    """64-bit hashes of byte ranges: a prefix sum of weighted bytes, so a range costs one subtraction."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            self.up = powers(self.BASE, len(data) + 1)
            self.down = powers(pow(self.BASE, -1, 1 << 64), len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.up[: len(data)], out=total[1:])
        length = (ends - starts).astype(np.uint64)
        return mix((total[ends] - total[starts]) * self.down[starts] + length)


def ragged(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of different length as an Arrow list column."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def kept_by_worker(name: str, make):
    """A value that a Python worker builds once and keeps for its later tasks."""
    import sys
    import types

    shelf = sys.modules.setdefault("taskspark_worker_shelf", types.ModuleType("taskspark_worker_shelf"))
    if not hasattr(shelf, name):
        setattr(shelf, name, make())
    return getattr(shelf, name)
