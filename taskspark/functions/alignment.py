"""Sequence alignment as Arrow UDFs over two ``array<string>`` columns.

A dynamic-programming cell needs its left neighbour. Spark's array functions can only thread that
through ``aggregate``, which copies the row for every cell. Spark splits the pairs over the tasks,
the functions below see one pair at a time.

Short pairs use plain lists. For long ones numpy fills a whole matrix row at once, only checkpoint
rows of the matrix are kept, and the trace refills one block of rows between two checkpoints when it
gets there: memory for about ``2 * sqrt(n)`` rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

GAP = "-"
SMALL_CELLS = 1 << 11
BLOCK_CELLS = 1 << 22

ALIGNED = "align1 array<string>, align2 array<string>"
SCORED = "align1 array<string>, align2 array<string>, score double"


def _matrix(seq1, seq2, reward=1, gap=-1, local=False):
    """Score matrix. ``local`` starts the edges at 0 and lifts every cell to at least 0."""
    small = len(seq1) * len(seq2) <= SMALL_CELLS
    return (_Whole if small else _Blocks)(seq1, seq2, reward, gap, local)


class _Whole:
    """Score matrix as a list of rows."""

    def __init__(self, seq1, seq2, reward, gap, local):
        row = [0] * (len(seq2) + 1) if local else [gap * j for j in range(len(seq2) + 1)]
        self.rows, best, self.best_at = [row], -1, (0, 0)
        for i, symbol in enumerate(seq1, 1):
            above, row = row, [0 if local else gap * i]
            left, corner = row[0], above[0]
            for j, other in enumerate(seq2, 1):
                value = corner + (reward if symbol == other else gap)
                corner = above[j]
                if corner + gap > value:
                    value = corner + gap
                if left + gap > value:
                    value = left + gap
                if local:
                    if value < 0:
                        value = 0
                    if value >= best:
                        best, self.best_at = value, (i, j)
                row.append(value)
                left = value
            self.rows.append(row)

    def row(self, i):
        return self.rows[i]

    def above(self, i):
        return self.rows[i - 1]


class _Blocks:
    """Score matrix by blocks of rows.

    With a fixed gap cost, ``row[j] = max(t[j], row[j-1] + gap)`` is a running maximum of
    ``t[j] - gap * j``.
    """

    def __init__(self, seq1, seq2, reward, gap, local):
        a, b = _codes(seq1, seq2)
        self.a, self.b, self.reward, self.gap, self.local = a, b, reward, gap, local
        n, m = len(a), len(b)
        self.slope = gap * np.arange(m + 1, dtype=np.int64)
        self.block = max(math.isqrt(n) + 1, BLOCK_CELLS // (m + 1))
        self.best, self.best_at = -1, (0, 0)
        top = np.zeros(m + 1, dtype=np.int64) if local else self.slope.copy()
        self.tops = []
        for start in range(0, max(n, 1), self.block):
            self.tops.append(top)
            rows = self._fill(start, top)
            if local and m and len(rows) > 1:
                self._note_last_maximum(rows, start)
            top = rows[-1].copy()
        self.loaded, self.rows = len(self.tops) - 1, rows

    def _fill(self, start, top):
        stop = min(start + self.block, len(self.a))
        rows = np.empty((stop - start + 1, len(top)), dtype=np.int64)
        rows[0] = top
        for k in range(1, len(rows)):
            above, row, i = rows[k - 1], rows[k], start + k
            row[0] = 0 if self.local else self.gap * i
            match = np.where(self.b == self.a[i - 1], self.reward, self.gap)
            np.maximum(above[:-1] + match, above[1:] + self.gap, out=row[1:])
            if self.local:
                np.maximum(row, 0, out=row)
            row -= self.slope
            np.maximum.accumulate(row, out=row)
            row += self.slope
        return rows

    def _note_last_maximum(self, rows, start):
        cells = rows[1:, 1:]
        top = cells.max()
        if top >= self.best:
            last = cells.size - 1 - int(cells.ravel()[::-1].argmax())
            self.best = top
            self.best_at = (start + 1 + last // cells.shape[1], 1 + last % cells.shape[1])

    def row(self, i):
        """Row ``i``, refilling its block if another one is loaded."""
        at = max(i - 1, 0) // self.block
        if at != self.loaded:
            self.loaded, self.rows = at, self._fill(at * self.block, self.tops[at])
        return self.rows[i - at * self.block]

    def above(self, i):
        """Row ``i - 1``, from the block of row ``i``: a block starts with the last row before it."""
        self.row(i)
        return self.rows[i - 1 - self.loaded * self.block]


def _codes(*sequences):
    """Integer codes: equal symbols, equal numbers."""
    seen: dict = {}
    return [
        np.array([seen.setdefault(s, len(seen)) for s in seq], dtype=np.int64) for seq in sequences
    ]


def global_pair(seq1, seq2, reward=1, gap=-1):
    """Whole-length alignment. Unequal symbols never share a column: each stands against a gap."""
    scores = _matrix(seq1, seq2, reward, gap)
    i, j, out1, out2 = len(seq1), len(seq2), [], []
    while i or j:
        if i and j and seq1[i - 1] == seq2[j - 1]:
            i, j = i - 1, j - 1
            out1.append(seq1[i])
            out2.append(seq2[j])
        elif i and scores.row(i)[j] == scores.above(i)[j] + gap:
            i -= 1
            out1.append(seq1[i])
            out2.append(GAP)
        else:
            j -= 1
            out1.append(GAP)
            out2.append(seq2[j])
    return out1[::-1], out2[::-1]


def local_pair(seq1, seq2):
    """Best common stretch, ending at the last of the best cells, and the share of ``seq2`` in it."""
    scores = _matrix(seq1, seq2, local=True)
    (i, j), out1, out2 = scores.best_at, [], []
    while i and j:
        row = scores.row(i)
        if row[j] == 0:
            break
        step1, step2 = seq1[i - 1], seq2[j - 1]
        if row[j] == row[j - 1] - 1:
            step1, j = GAP, j - 1
        elif row[j] == scores.above(i)[j] - 1:
            step2, i = GAP, i - 1
        else:
            i, j = i - 1, j - 1
        if step1:
            out1.append(step1)
        if step2:
            out2.append(step2)
    out1.reverse()
    out2.reverse()
    score = (len(out2) - out2.count(GAP)) / len(seq2) if len(out2) >= 2 else 0.0
    return out1, out2, score


def hybrid_pair(seq1, seq2):
    """Local alignment of the two gapped sides of the global one."""
    return local_pair(*global_pair(seq1, seq2))


def align_global(seq1: Column, seq2: Column, reward: int = 1, penalty: int = -1) -> Column:
    """Struct of both sides of the global alignment."""

    @F.pandas_udf(ALIGNED)
    def run(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        pairs = [global_pair(list(x), list(y), reward, penalty) for x, y in zip(left, right)]
        return pd.DataFrame(pairs, columns=["align1", "align2"])

    return run(seq1, seq2)


def align_local(seq1: Column, seq2: Column) -> Column:
    """Struct of both sides of the local alignment and its score."""
    return _scored(local_pair)(seq1, seq2)


def align_hybrid(seq1: Column, seq2: Column) -> Column:
    """Struct of both sides of the global-then-local alignment and its score."""
    return _scored(hybrid_pair)(seq1, seq2)


def _scored(pair):
    @F.pandas_udf(SCORED)
    def run(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        rows = [pair(list(x), list(y)) for x, y in zip(left, right)]
        return pd.DataFrame(rows, columns=["align1", "align2", "score"])

    return run
