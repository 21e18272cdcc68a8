"""Suffixes of word sequences: reading them from texts, and counting their beginnings by multikey quicksort."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa

from taskspark.llm.arrays import LOWER, WordHasher, flat, mix, runs

#: Bytes that end a piece, and bytes that only end a word.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)] = 1
KIND[list(BREAKS)] = 2
#: Stands where a suffix has no further word.
END = 0


def words_of(texts: pa.Array, langs: pa.Array, hasher: WordHasher):
    """Words of all rows: lower-cased bytes, starts, ends, row, 64-bit id, and whether the next word goes on with
    the same piece. Ids differ between languages and are never ``END``."""
    data, offsets = flat(texts)
    data = LOWER[data]
    kind = KIND[data]
    starts, ends, bounds = runs(kind == 0, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    names, edges = flat(langs)
    tongues = hasher(names, edges[:-1], edges[1:])
    with np.errstate(over="ignore"):
        ids = mix(hasher(data, starts, ends) + tongues[row] * np.uint64(0x9FB21C651E98DF25)).view(np.int64)
    ids[ids == END] = 1
    breaks = np.cumsum(kind == 2, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
    goes_on = np.zeros(len(starts), bool)
    goes_on[:-1] = (breaks[1:] == breaks[:-1]) & (row[1:] == row[:-1])
    return data, starts, ends, row, ids, goes_on


def combined(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of ``keys`` with equal ones put together and their weights added up.

    Equal columns may stay apart where two different ones share a hash, so the result is a pre-aggregation.
    """
    if not keys.shape[1]:
        return keys, weights
    with np.errstate(over="ignore"):
        total = np.zeros(keys.shape[1], np.uint64)
        for part in keys:
            total = mix(total + part.view(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    order = np.argsort(total)
    keys = keys[:, order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    at = np.flatnonzero(fresh)
    return keys[:, at], np.add.reduceat(weights[order], at)


def frequent_prefixes(
    keys: np.ndarray, weights: np.ndarray, least: Sequence[int]
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length d the beginnings of d words whose weight is at least ``least[d - 1]``: (a suffix that begins
    so, weight), by three-way quicksort of suffix pointers.

    ``keys[d]`` holds word d of every suffix, ``END`` behind the last. Each open partition of pointers is split by
    a pivot word into less, equal and greater. The equal ones share one more word: their weight is the count of
    that beginning, and they go on with the next word until the last. A partition below ``least`` is abandoned,
    as no beginning inside it can reach it. All open partitions are split in one sweep over the arrays.
    """
    depths = len(keys)
    found = [([], []) for _ in range(depths)]
    least = np.asarray(least, np.int64)
    rows = np.flatnonzero(keys[0] != END)
    sizes, depth = np.array([len(rows)]), np.zeros(1, np.int64)
    while len(rows):
        seg = np.repeat(np.arange(len(sizes)), sizes)
        key = keys[depth[seg], rows]
        pivot = key[np.cumsum(sizes) - sizes + sizes // 2][seg]
        part = (key > pivot).astype(np.int8) + (key >= pivot)
        slot = 3 * seg + part
        weight = np.bincount(slot, weights[rows], 3 * len(sizes)).astype(np.int64)
        open_ = weight >= np.repeat(least[depth], 3)

        same = np.flatnonzero(part == 1)
        first = same[np.cumsum(np.bincount(seg[same], minlength=len(sizes))) - np.bincount(seg[same], minlength=len(sizes))]
        hits = open_[1::3]
        for d in range(depths):
            here = hits & (depth == d)
            if here.any():
                found[d][0].append(rows[first[here]])
                found[d][1].append(weight[1::3][here])

        deeper = np.repeat(depth, 3)
        deeper[1::3] += 1
        open_ &= deeper < depths
        keep = open_[slot]
        keep[same] &= keys[np.minimum(deeper[slot[same]], depths - 1), rows[same]] != END
        rows, slot, seg, part = rows[keep], slot[keep], seg[keep], part[keep]
        counts = np.bincount(slot, minlength=len(deeper))
        begin = np.cumsum(counts) - counts
        moved = np.empty_like(rows)
        for c in range(3):
            own = np.flatnonzero(part == c)
            before = np.cumsum(counts[c::3]) - counts[c::3]
            moved[(begin[c::3] - before)[seg[own]] + np.arange(len(own))] = rows[own]
        used = counts > 0
        rows, sizes, depth = moved, counts[used], deeper[used]
    none = np.zeros(0, np.int64)
    return [(np.concatenate([none, *a]), np.concatenate([none, *b])) for a, b in found]
