"""Product quantisation of vectors with codebooks from ball k-means, in exact integer arithmetic.

A vector is cut into equal parts; each part position has a codebook of entries. The members of an entry lie in a
ball around it, whose radius is known from the last assignment and the way the entry has moved since. In the next
round

- only entries that a ball of twice that radius reaches are neighbours of the entry;
- a part nearer than half the way to the nearest neighbour is in the stable core and keeps its entry;
- the others lie in rings, bounded by half the way to each neighbour in order of distance: a part in ring k is
  compared with the k nearest neighbours only, exactly.

All comparisons are of squared integer distances, so skipped ones cannot change a result, ties included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.session import store_and_reload

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Scaled components must stay below this, so that sums of squares fit 64 bits.
LARGEST = 1 << 24
#: Cells of the table of differences that is held at once.
CELLS = 1 << 20
FAR = np.iinfo(np.int64).max


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, parts): rows whose vector has only finite components, as floor(scale * x).

    Rows with a null vector, a null component or one that is not finite are dropped, as are empty vectors.
    """
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    broad = F.raise_error(F.lit(f"a component lies beyond {LARGEST // scale}"))

    def floored(v):
        return F.when(F.abs(v.cast("double") * scale) < LARGEST, F.floor(v.cast("double") * scale)).otherwise(broad)

    kept = vectors.where(x.isNotNull() & (F.size(x) > 0) & F.coalesce(fine, F.lit(False)))
    return kept.select("vec_id", "label", F.transform(x, lambda v: floored(v).cast("int")).alias("parts"))


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """The vectors of a batch as rows x parts x components."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, -1)


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each row, the lower index on ties; all are compared."""
    index, best = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    step = max(1, CELLS // max(1, entries.size))
    for start in range(0, len(rows), step):
        block = slice(start, start + step)
        apart = ((rows[block, None, :] - entries[None]) ** 2).sum(axis=2)
        index[block] = apart.argmin(axis=1)
        best[block] = apart.min(axis=1)
    return index, best


def neighbours(entries: np.ndarray, radii: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The entries that each entry's ball reaches, nearest first, and their squared distances; padded with FAR."""
    apart = ((entries[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for i, radius in enumerate(radii):
        apart[i, apart[i] > 4 * radius * radius] = FAR
        apart[i, i] = FAR
    order = np.argsort(apart, axis=1, kind="stable")
    gaps = np.take_along_axis(apart, order, axis=1)
    width = max(1, int((gaps < FAR).sum(axis=1).max(initial=0)))
    return order[:, :width], gaps[:, :width]


def nearest_from(
    rows: np.ndarray, own: np.ndarray, entries: np.ndarray, order: np.ndarray, gaps: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """As ``nearest``, starting from the entry that each row had before; also the number of rows compared."""
    start = ((rows - entries[own]) ** 2).sum(axis=1)
    best, index = start.copy(), own.copy()
    at = np.flatnonzero(4 * start >= gaps[own, 0])  # outside the stable core
    asked, ring = len(at), 0
    while len(at):
        other = order[own[at], ring]
        apart = ((rows[at] - entries[other]) ** 2).sum(axis=1)
        wins = (apart < best[at]) | ((apart == best[at]) & (other < index[at]))
        best[at[wins]], index[at[wins]] = apart[wins], other[wins]
        ring += 1
        if ring == gaps.shape[1]:
            break
        at = at[4 * start[at] >= gaps[own[at], ring]]  # rings that reach the next neighbour
    return index, best, asked


def assign(rows: DataFrame, books: np.ndarray, radii: list[list[int]] | None) -> DataFrame:
    """(vec_id, label, parts, code, error): every part with its nearest entry. ``radii`` (per part and entry) are
    needed if ``rows`` has codes to start from."""
    parts = len(books)
    balls = None if radii is None else [neighbours(book, r) for book, r in zip(books, radii, strict=True)]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("parts"), parts)
            codes, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            if balls is not None:
                old = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(x), parts)
            for p in range(parts):
                if balls is None:
                    index, apart = nearest(x[:, p], books[p])
                else:
                    index, apart, _ = nearest_from(x[:, p], old[:, p].astype(np.int64), books[p], *balls[p])
                codes[:, p] = index
                error += apart
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("vec_id", "label", "parts")),
                    pa.array([row.tobytes() for row in codes], pa.binary()),
                    pa.array(error),
                ],
                names=["vec_id", "label", "parts", "code", "error"],
            )

    kept = rows.select("vec_id", "label", "parts", *([] if balls is None else ["code"]))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return kept.mapInArrow(code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, parts array<int>, code binary, error long")


def moved_books(coded: DataFrame, books: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Each entry at the floor of its parts' mean (unused ones stay), and a bound of its ball's radius there.

    Sums are formed within every partition first; one row per component of every entry reaches the driver, as many
    as the codebooks have, whatever the number of vectors.
    """
    parts, entries, width = books.shape

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), np.int64)
        counts, far = np.zeros(parts * entries, np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("parts"), parts)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(x), parts)
            for p in range(parts):
                own = codes[:, p].astype(np.int64)
                np.add.at(sums, p * entries + own, x[:, p])
                np.add.at(counts, p * entries + own, 1)
                np.maximum.at(far, p * entries + own, ((x[:, p] - books[p][own]) ** 2).sum(axis=1))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, width)),
                pa.array(np.tile(np.arange(width), len(used))),
                pa.array(sums[used].ravel()),
                pa.array(np.repeat(counts[used], width)),
                pa.array(np.repeat(far[used], width)),
            ],
            names=["entry", "place", "s", "n", "far"],
        )

    sums = coded.select("parts", "code").mapInArrow(total, "entry long, place long, s long, n long, far long")
    found = sums.groupBy("entry", "place").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("far").alias("far")).toArrow()
    new, radii = books.reshape(parts * entries, width).copy(), np.zeros(parts * entries, np.int64)
    entry = found["entry"].to_numpy()
    new[entry, found["place"].to_numpy()] = found["s"].to_numpy() // found["n"].to_numpy()
    radii[entry] = found["far"].to_numpy()
    new = new.reshape(books.shape)
    shift = ((new - books) ** 2).sum(axis=2)
    bounds = [
        [_root_above(int(r)) + _root_above(int(s)) for r, s in zip(rs, ss, strict=True)]
        for rs, ss in zip(radii.reshape(parts, entries), shift, strict=True)
    ]
    return new, bounds


def _root_above(square: int) -> int:
    root = isqrt(square)
    return root if root * root == square else root + 1


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, parts, code, error) of every kept vector, and the codebooks (parts x entries x components).

    ``vectors`` has vec_id, embedding and label; other columns are ignored. Codebooks start as the parts of the
    ``entries`` smallest vec_ids among the kept vectors (fewer if there are fewer); of rows with the same vec_id the
    smaller vector comes first; a null vec_id is coded but starts no entry. ``rounds`` times every part goes to its
    nearest entry and entries move; then parts are assigned once more. At most 256 entries, as a code is a byte.

    Vectors that are null, empty, or hold null or non-finite components are dropped, and so are those of another
    length than the vector with the smallest vec_id; that length must be a multiple of ``parts``, else ValueError.
    A component of 2**24 / ``scale`` or more ends the job with an error. Repeated rows are kept and count as often
    as they stand. A table without a kept vector that has a vec_id gives no rows and empty codebooks.

    Each round is written to the shared folder. The driver holds the codebooks only.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    rows = store_and_reload(whole_vectors(vectors, scale), "vectors")
    first = rows.where("vec_id IS NOT NULL").orderBy("vec_id", "parts").limit(entries)
    lead = first.select("vec_id", "parts").collect()
    width = len(lead[0]["parts"]) if lead else 0
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    same = rows.where(F.size("parts") == width)
    if any(len(r["parts"]) != width for r in lead):
        lead = same.where("vec_id IS NOT NULL").orderBy("vec_id", "parts").limit(entries).collect()
    books = np.array([r["parts"] for r in lead], np.int64).reshape(len(lead), parts, -1 if lead else 0).transpose(1, 0, 2)
    coded, radii = same, None
    if not lead:
        return same.select("vec_id", "label", "parts", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), books
    for _ in range(rounds):
        coded = store_and_reload(assign(coded, books, radii), "coded")
        books, radii = moved_books(coded, books)
    return store_and_reload(assign(coded, books, radii), "coded"), books


def decode(coded: DataFrame, books: np.ndarray, scale: int = SCALE, into: str = "approximation") -> DataFrame:
    """``coded`` with the vector that its code stands for, as doubles in ``into``."""
    parts = len(books)

    def look_up(codes: pa.Array) -> pa.Array:
        rows = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(codes), parts)
        values = books[np.arange(parts), rows].reshape(len(codes), -1) / scale
        return pa.FixedSizeListArray.from_arrays(values.ravel(), values.shape[1]).cast(pa.list_(pa.float64()))

    return coded.withColumn(into, F.arrow_udf(look_up, "array<double>")("code"))


def report(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): codes in hex, the errors of a label added up (null
    labels together), and a digest of all entries."""
    text = ",".join(str(x) for x in books.ravel().tolist())
    digest = hashlib.sha256(text.encode()).hexdigest()
    sums = coded.groupBy(F.col("label").alias("own")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("own")), "left").select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
