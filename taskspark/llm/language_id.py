"""Language identification with a string kernel.

A text is the set of its character n-grams (blended spectrum, presence only) within words. The kernel of two
texts is the number of common grams over the root of the product of their set sizes. Landmark texts give the
Nystrom features, and one ridge regression per language against the rest is fitted on them. Both are linear in
the grams, so they fold into one weight per gram of a landmark and language: a batch is scored as the product
of its sparse presence matrix with that weight matrix.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from taskspark.llm.arrays import mix, ragged, slices
from taskspark.llm.samples import by_hash

#: Expected size of the labelled sample that is learned from, and bound of the landmarks in it, both per language.
LEARNED_PER_LANGUAGE = 500
LANDMARKS_PER_LANGUAGE = 60
RIDGE = 0.1
LONGEST_GRAM = 4
GRAM_BITS = 24
UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Languages, and the weight of every known gram for each."""

    languages: list[str]
    grams: np.ndarray
    weights: np.ndarray


def grams(text: str | None, longest: int = LONGEST_GRAM) -> np.ndarray:
    """The distinct n-grams, n from 1 to ``longest``, of the words of a text as ascending hashes.

    Words are runs of letters with a blank on either side; no gram spans two words, so each distinct word
    needs to be read once.
    """
    words = set(LETTERS.findall(text.lower())) if text else set()
    odd = [w for w in words if not w.isalpha()]  # signs such as a half are no letters
    words = words.difference(odd).union(*(("".join(c if c.isalpha() else " " for c in w)).split() for w in odd))
    if not words:
        return np.zeros(0, np.int32)
    signs = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    blank = signs == 32
    found = []
    value = np.zeros(len(signs), np.uint64)
    for n in range(1, longest + 1):
        value = value[: len(signs) - n + 1] * np.uint64(0x100000001B3) + signs[n - 1 :]
        inside = np.ones(len(value), bool)
        for k in range(1, n - 1):
            inside &= ~blank[k : k + len(value)]
        if n == 1:
            inside = ~blank
        elif n == 2:
            inside = ~(blank[:-1] & blank[1:])
        found.append(mix(value[inside] + np.uint64(n)) >> np.uint64(64 - GRAM_BITS))
    return np.unique(np.concatenate(found)).astype(np.int32)


def held_out(doc_id, parts: int, rest: int):
    """Whether crc32 of the id as text leaves ``rest``; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == rest, F.lit(False))


def fit(docs: DataFrame, per_language: int = LEARNED_PER_LANGUAGE, landmarks: int = LANDMARKS_PER_LANGUAGE) -> Model:
    """Learn from the labelled rows of ``docs`` (doc_id, text, lang): of every language about ``per_language``
    rows, those whose hash of the id is low. Rows without a language, an id or a letter teach nothing; of rows
    that repeat an id and a language, one does."""
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang", "text")
    totals = {row.lang: row["count"] for row in known.groupBy("lang").count().collect()}
    chosen = known.where(by_hash("doc_id", "lang", totals, dict.fromkeys(totals, per_language)))
    rows = chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [grams(t) for t in batch.column("text").to_pylist()]
            values = ragged(np.concatenate([np.zeros(0, np.int32), *sets]), np.cumsum([0, *map(len, sets)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), values], names=["doc_id", "lang", "grams"]
            )

    found = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").mapInArrow(
        read, "doc_id long, lang string, grams array<int>"
    )
    table = found.withColumn("_order", F.xxhash64("doc_id")).toArrow().sort_by(
        [("lang", "ascending"), ("_order", "ascending"), ("doc_id", "ascending")]
    )
    taught = [
        (lang, g.values.to_numpy()) for lang, g in zip(table["lang"].to_pylist(), table["grams"], strict=True) if len(g)
    ]
    languages = sorted({lang for lang, _ in taught})
    if not languages:
        return Model([], np.zeros(0, np.int32), np.zeros((0, 0)))
    marks = [g for name in languages for g in [g for lang, g in taught if lang == name][:landmarks]]
    vocabulary = np.unique(np.concatenate(marks))
    presence = np.zeros((len(vocabulary), len(marks)), np.float32)
    for k, g in enumerate(marks):
        presence[np.searchsorted(vocabulary, g), k] = 1 / np.sqrt(len(g))
    kernel = np.array([_sum_of(presence, vocabulary, g) for _, g in taught])
    among = np.array([_sum_of(presence, vocabulary, g) for g in marks])
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    large = values > 1e-6 * values[-1]
    root = vectors[:, large] / np.sqrt(values[large])
    features = np.hstack([kernel @ root, np.ones((len(taught), 1))])
    targets = np.array([[1.0 if lang == name else -1.0 for name in languages] for lang, _ in taught])
    penalty = RIDGE * np.eye(features.shape[1])
    penalty[-1, -1] = 1e-9
    solved = np.linalg.solve(features.T @ features + penalty, features.T @ targets)
    weights = presence.astype(float) @ (root @ solved[:-1])
    return Model(languages, np.append(vocabulary, -1), np.vstack([weights, solved[-1]]))


def _sum_of(rows: np.ndarray, vocabulary: np.ndarray, g: np.ndarray) -> np.ndarray:
    at = np.searchsorted(vocabulary, g)
    at[at == len(vocabulary)] = 0
    return rows[at[vocabulary[at] == g]].sum(axis=0, dtype=float) / np.sqrt(max(len(g), 1))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) of every whole text; nothing but the text is used.

    A text that is null or has no letter is ``und`` with score 0, as is every text if nothing was learned.
    Columns lang_pred and score that ``docs`` may have are replaced; other columns and repeated rows stay.
    """
    docs = docs.drop("lang_pred", "score")
    # Plain arrays: a broadcast of our own class would ask every worker for an installed copy.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.grams[:-1], model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, vocabulary, weights = shared.value
        for batch in slices(batches, "text", 1 << 18):
            sets = [grams(t) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(g) for g in sets])
            values = np.concatenate([np.zeros(0, np.int32), *sets])
            rows = np.repeat(np.arange(len(sets)), sizes)
            names, scores = [], []
            if languages:
                flat = np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)
                there = vocabulary[flat] == values
                rows, flat = rows[there], flat[there]
                product = np.zeros((len(sets), len(languages)))
                for c in range(len(languages)):
                    product[:, c] = np.bincount(rows, weights[:-1, c][flat], minlength=len(sets))
                product = product / np.sqrt(np.maximum(sizes, 1))[:, None] + weights[-1]
                best = product.argmax(axis=1)
                top = np.clip((product.max(axis=1) + 1) / 2, 0, 1)
            for k, size in enumerate(sizes):
                sure = bool(size) and bool(languages)
                names.append(languages[best[k]] if sure else UNDETERMINED)
                scores.append(float(top[k]) if sure else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added]))
