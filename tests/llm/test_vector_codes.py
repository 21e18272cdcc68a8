"""Ball k-means against plain nearest-entry search, and vectors that do not fit."""

import hashlib

import numpy as np
import pytest

from taskspark.llm.vector_codes import compress, decode, nearest, nearest_from, neighbours, report, _root_above

SCHEMA = "vec_id long, embedding array<float>, label int, code int, error string"


def plain(rows, parts, entries, rounds, scale=256):
    """Codes, errors and codebooks of (vec_id, vector) rows, everything compared with everything."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r))
    x = np.floor(np.array([r[1] for r in rows], np.float64) * scale).astype(np.int64).reshape(len(rows), parts, -1)
    lead = [i for i, r in enumerate(rows) if r[0] is not None][:entries]
    books = x[lead].transpose(1, 0, 2).copy()
    for step in range(rounds + 1):
        apart = np.array([[((x[i, p] - books[p]) ** 2).sum(axis=1) for p in range(parts)] for i in range(len(x))])
        codes, error = apart.argmin(axis=2), apart.min(axis=2).sum(axis=1)
        if step < rounds:
            for p in range(parts):
                for e in range(len(lead)):
                    own = x[codes[:, p] == e, p]
                    if len(own):
                        books[p, e] = own.sum(axis=0) // len(own)
    return rows, codes, error, books


@pytest.mark.parametrize("seed", range(6))
def test_balls_lose_nothing(seed):
    rng = np.random.default_rng(seed)
    spread = (3, 3, 20, 20, 400, 400)[seed]
    rows = rng.integers(-spread, spread, (700, 3))
    old, new = rng.integers(-spread, spread, (2, 24, 3))
    new[5] = new[3]  # entries that coincide
    own, apart = nearest(rows, old)
    radii = [0] * 24
    for i, d in zip(own, apart, strict=True):
        radii[i] = max(radii[i], _root_above(int(d)))
    bounds = [r + _root_above(int(((a - b) ** 2).sum())) for r, a, b in zip(radii, old, new, strict=True)]
    index, best, asked = nearest_from(rows, own, new, *neighbours(new, bounds))
    want, least = nearest(rows, new)
    assert (index == want).all() and (best == least).all() and asked <= len(rows)


def test_settled_parts_are_not_asked():
    rng = np.random.default_rng(1)
    entries = np.array([[1000 * i, 0] for i in range(20)])
    rows = entries[rng.integers(0, 20, 500)] + rng.integers(-9, 9, (500, 2))
    own, _ = nearest(rows, entries)
    order, gaps = neighbours(entries, [13] * 20)
    assert (gaps == np.iinfo(np.int64).max).all()  # no ball reaches another entry
    assert nearest_from(rows, own, entries, order, gaps)[2] == 0


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 8, 2), (2, 3, 5), (8, 64, 0)])
def test_codes_equal_plain_ones(spark, parts, entries, rounds):
    rng = np.random.default_rng(parts)
    rows = [(int(i), [float(np.float32(v)) for v in rng.normal(0, 0.2, 8)]) for i in rng.permutation(60)]
    rows += [(7, rows[3][1]), (None, rows[5][1]), (None, rows[5][1])]
    df = spark.createDataFrame([(i, v, (i or 0) % 3 or None, 0, "") for i, v in rows], SCHEMA).repartition(3)
    coded, books = compress(df, parts, entries, rounds)
    ordered, codes, error, want = plain(rows, parts, entries, rounds)
    assert (books == want).all()
    got = sorted((str(r["vec_id"]), bytes(r["code"]), r["error"]) for r in coded.collect())
    assert got == sorted((str(r[0]), bytes(c.tolist()), int(e)) for r, c, e in zip(ordered, codes, error, strict=True))
    told = report(coded, books).collect()
    sums = {}
    for r in coded.collect():
        sums[r["label"]] = sums.get(r["label"], 0) + r["error"]
    assert {r["label_error"] for r in told} == set(sums.values())
    text = ",".join(str(v) for v in want.ravel())
    assert {r["codebooks_sha256"] for r in told} == {hashlib.sha256(text.encode()).hexdigest()}
    near = {r["vec_id"]: r["approximation"] for r in decode(coded, books).collect()}
    assert all(len(v) == 8 for v in near.values()) and len(near) == 61


def test_vectors_that_do_not_fit(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 1.0], None), (2, None, 1), (3, [], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [-inf, 1.0], 1),
        (7, [None, 1.0], 1), (8, [1.0], 1), (9, [0.0, -0.001], None), (9, [0.0, -0.001], None),
    ]
    df = spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)
    coded, books = compress(df, 2, 64, 1)
    assert sorted(r["vec_id"] for r in coded.collect()) == [1, 9, 9]
    assert books[1].tolist() == [[256], [-1], [-1]]
    assert {r["label_error"] for r in report(coded, books).collect()} == {0}
    assert compress(df.where("vec_id = 2"), 2)[0].count() == 0
    assert report(*compress(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        compress(df.where("vec_id = 8"), 2)
    with pytest.raises(Exception, match="lies beyond"):
        compress(spark.createDataFrame([(1, [1e9, 0.0], 1, 0, "")], SCHEMA), 2)[0].collect()
