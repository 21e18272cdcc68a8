import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taskspark.functions import alignment as al

GOLDEN = [
    ("A B C D", "A B C D", "A B C D", "A B C D", "A B C D", "A B C D", 1.0),
    ("A B C D", "A B X D", "A B C - D", "A B - X D", "A B C - - D", "A B - - X D", 0.8),
    ("A B C", "X Y Z", "A - B - C -", "- X - Y - Z", "-", "-", 0.0),
    ("A B", "A B C D E F", "A B - - - -", "A B C D E F", "A B", "A B", 2 / 6),
    ("A", "A", "A", "A", "A", "A", 0.0),
    ("A B C A B C", "A B C", "A B C A B C", "- - - A B C", "A B C", "A B C", 0.5),
    ("RECEIVE EVAL SHIP", "RECEIVE SHIP", "RECEIVE EVAL SHIP", "RECEIVE - SHIP", "SHIP", "SHIP", 0.0),
]


def by_cells(a, b, local):
    """Score matrix by definition."""
    m = [[0 if local else -(i + j) for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i][j] = max(
                m[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), m[i - 1][j] - 1, m[i][j - 1] - 1
            )
            if local:
                m[i][j] = max(m[i][j], 0)
    return m


def slow_global(a, b):
    m, i, j, x, y = by_cells(a, b, False), len(a), len(b), [], []
    while (i, j) != (0, 0):
        if i and j and a[i - 1] == b[j - 1]:
            i, j, s, t = i - 1, j - 1, a[i - 1], b[j - 1]
        elif i and m[i][j] == m[i - 1][j] - 1:
            i, s, t = i - 1, a[i - 1], "-"
        else:
            j, s, t = j - 1, "-", b[j - 1]
        x, y = [s, *x], [t, *y]
    return x, y


def slow_local(a, b):
    m, best, (i, j) = by_cells(a, b, True), -1, (0, 0)
    for r in range(1, len(a) + 1):
        for c in range(1, len(b) + 1):
            if m[r][c] >= best:
                best, (i, j) = m[r][c], (r, c)
    x, y = [], []
    while m[i][j]:
        if m[i][j] == m[i][j - 1] - 1:
            j, s, t = j - 1, "-", b[j - 1]
        elif m[i][j] == m[i - 1][j] - 1:
            i, s, t = i - 1, a[i - 1], "-"
        else:
            i, j, s, t = i - 1, j - 1, a[i - 1], b[j - 1]
        x, y = ([s, *x] if s else x), ([t, *y] if t else y)
    return x, y, (len(y) - y.count("-")) / len(b) if len(y) > 1 else 0.0


@pytest.mark.parametrize("row", GOLDEN)
def test_goldens(row):
    a, b, g1, g2, l1, l2, score = [v.split() if isinstance(v, str) else v for v in row]
    assert al.global_pair(a, b) == (g1, g2)
    assert al.hybrid_pair(a, b) == (l1, l2, pytest.approx(score))


symbols = st.lists(st.sampled_from(["A", "B", "C", ""]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(symbols, symbols, st.sampled_from([(1 << 20, 1 << 22), (-1, 1 << 22), (-1, 1)]))
def test_same_as_by_definition(a, b, sizes):
    al.SMALL_CELLS, al.BLOCK_CELLS = sizes
    try:
        g1, g2 = al.global_pair(a, b)
        assert (g1, g2) == slow_global(a, b)
        assert [s for s in g1 if s != "-"] == a and [s for s in g2 if s != "-"] == b
        assert len(g1) == len(g2) and ("-", "-") not in zip(g1, g2)
        assert al.local_pair(a, b) == slow_local(a, b)
        assert al.hybrid_pair(a, b) == slow_local(g1, g2)
        assert 0 <= al.hybrid_pair(a, b)[2] <= 1
    finally:
        al.SMALL_CELLS, al.BLOCK_CELLS = 1 << 11, 1 << 22


def test_long_pair_by_blocks():
    draw = random.Random(5)
    a, b = ([draw.choice("ABCDE") for _ in range(n)] for n in (700, 500))
    whole = al.hybrid_pair(a, b)
    al.BLOCK_CELLS = 1
    try:
        assert al.hybrid_pair(a, b) == whole == slow_local(*slow_global(a, b))
    finally:
        al.BLOCK_CELLS = 1 << 22


def test_columns(spark):
    pairs = [(r[0].split(), r[1].split()) for r in GOLDEN] + [([], []), (["A"], [])]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    rows = df.select(
        "a", "b",
        al.align_global(F.col("a"), F.col("b")).alias("g"),
        al.align_local(F.col("a"), F.col("b")).alias("l"),
        al.align_hybrid(F.col("a"), F.col("b")).alias("h"),
    ).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        assert tuple(r["g"]) == slow_global(r["a"], r["b"])
        assert tuple(r["l"]) == slow_local(r["a"], r["b"])
        assert tuple(r["h"]) == slow_local(*slow_global(r["a"], r["b"]))


def test_penalty_and_reward_are_parameters(spark):
    df = spark.createDataFrame([(["A", "B"], ["B", "A"])], "a array<string>, b array<string>")
    got = df.select(al.align_global(F.col("a"), F.col("b"), reward=3, penalty=-2).alias("g")).first()["g"]
    assert tuple(got) == al.global_pair(["A", "B"], ["B", "A"], 3, -2)
