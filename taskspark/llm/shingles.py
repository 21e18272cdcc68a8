"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from taskspark.llm.arrays import LOWER, WHITE, WordHasher, flat, mix, runs

WIDTH = 5


def shingle_sets(texts: pa.Array, hasher: WordHasher, width: int = WIDTH) -> list[np.ndarray]:
    """The distinct ``width``-word shingles of each text, ascending by hash.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A text with fewer words is one
    shingle as a whole; a text without words (or null) has none.
    """
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, bounds = runs(~WHITE[data], offsets)
    words = hasher(data, starts, ends)
    counts = np.diff(bounds)
    total = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        total = total * np.uint64(0xA24BAED4963EE407) + words[k : k + len(total)]
    total = mix(total)
    out = []
    for row in np.arange(len(counts)):
        n, at = counts[row], bounds[row]
        if n >= width:
            values = np.sort(total[at : at + n - width + 1])
            fresh = np.ones(len(values), bool)
            fresh[1:] = values[1:] != values[:-1]
            out.append(values[fresh])
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for word in words[at : at + n]:
                    whole = whole * np.uint64(0x9FB21C651E98DF25) + word
            out.append(mix(np.array([whole])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def common(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    both = np.sort(np.concatenate([left, right]), kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def bitmap(values: np.ndarray) -> np.ndarray:
    """A set as bits: value v sets bit v mod m, where m is a power of two of at least twice the set's size."""
    size = max(64, 1 << int(2 * len(values) - 1).bit_length()) if len(values) else 64
    bits = np.zeros(size, bool)
    bits[(values & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """The bitmap of the same set with ``size`` bytes, a smaller power of two."""
    return np.bitwise_or.reduce(bits.reshape(-1, size), axis=0) if len(bits) > size else bits


def missing(query: np.ndarray, union: np.ndarray) -> int:
    """A lower bound of how many values of the query's set are not in the union."""
    size = min(len(query), len(union))
    return int(np.bitwise_count(fold(query, size) & ~fold(union, size)).sum())
