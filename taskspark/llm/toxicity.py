"""Toxicity of texts: boosted trees over dense features, calibrated by isotonic regression.

The labelled rows that may be learned from are split by a hash of their id into three: one gives the lexicon
(words that toxic documents have far more often), one the trees, one the calibration, so no step is judged on
what it has seen. Only the text is an input of a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.llm.arrays import ragged, slices
from taskspark.llm.samples import by_hash
from taskspark.session import store_and_reload

#: Expected size of the labelled sample that is learned from, per class, and bound of the lexicon.
TOXIC_ROWS, CLEAN_ROWS = 5_000, 10_000
LEXICON_WORDS = 3_000
SEEN_IN, WEAK, STRONG = 3, 1.5, 3.0
THRESHOLD = 0.7
#: Insults that count whatever the sample holds.
INSULTS = frozenset(
    """
    idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting clown
    filth vermin imbecile cretin bastard jerk coward liar pig
    idiota imbecil estupido estúpido tonto basura asqueroso inutil inútil cerdo payaso cobarde
    idiote imbécile crétin débile ordure pourri salaud minable dégoûtant clown lâche
    dumm dummkopf trottel abschaum müll ekelhaft wertlos versager schwein feigling blöd
    """.split()
)
#: Words for the one who is spoken to.
SECOND_PERSON = frozenset(
    """
    you your yours yourself u ur
    tú tu tus ti te usted ustedes vosotros vuestro
    toi vous votre vos ton tes
    du dich dir dein deine ihr euch euer eure
    """.split()
)
#: Signs that stand for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
WORDS = re.compile(r"[^\W\d_]+")
#: Begins with a run of letters and never gives any back, so long runs are read once.
DISGUISED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[0-9@$!*.\-_]++[^\W\d_]++)+")
SYMBOLS = re.compile(r"[#*$%&|<>@]")
CAPS_WORD = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
DRAWN_OUT = re.compile(r"([^\W\d_])\1\1")
REACH = 8
FEATURES = (
    "log_words", "strong_density", "weak_density", "insult_density", "log_strong", "log_weak", "heaviest", "log_weight",
    "second_person", "proximity", "capitals", "caps_words", "exclamations", "questions", "symbols", "disguised",
    "disguised_hits", "drawn_out", "distinct",
)


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    share: float


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The dense features of one whole text, in the order of FEATURES."""
    text = text or ""
    words = WORDS.findall(text.lower())
    n, chars = max(len(words), 1), max(len(text), 1)
    weights = [(k, lexicon[w]) for k, w in enumerate(words) if w in lexicon]
    strong = [k for k, weight in weights if weight >= STRONG]
    weak = len(weights) - len(strong)
    insults = [k for k, w in enumerate(words) if w in INSULTS]
    addressed = [k for k, w in enumerate(words) if w in SECOND_PERSON]
    near = 0.0
    if addressed and (strong or insults):
        spots = np.array(addressed)
        for k in {*strong, *insults}:
            at = np.searchsorted(spots, k)
            gap = min(abs(int(spots[i]) - k) for i in (at - 1, at) if 0 <= i < len(spots))
            near = max(near, 1 / (1 + gap)) if gap <= REACH else near
    disguised = DISGUISED.findall(text)
    uncovered = sum(
        1
        for word in disguised
        for plain in {re.sub(r"[^\w]|_", "", word.lower()), word.lower().translate(LEET)}
        if plain in INSULTS or lexicon.get(plain, 0.0) >= STRONG
    )
    return [
        math.log1p(len(words)), len(strong) / n, weak / n, len(insults) / n, math.log1p(len(strong)), math.log1p(weak),
        max((w for _, w in weights), default=0.0), math.log1p(sum(w for _, w in weights)), len(addressed) / n, near,
        len(CAPITALS.findall(text)) / chars, len(CAPS_WORD.findall(text)) / n, text.count("!") / n, text.count("?") / n,
        len(SYMBOLS.findall(text)) / n, len(disguised) / n, float(uncovered), len(DRAWN_OUT.findall(text)) / n,
        len(set(words)) / n,
    ]


def with_features(docs: DataFrame, lexicon: dict[str, float], keys: list[str]) -> DataFrame:
    """``keys`` of ``docs`` and a vector column ``features`` of the column text."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, "text"):
            rows = [features(text, known) for text in batch.column("text").to_pylist()]
            values = ragged(np.array(rows).ravel(), np.arange(len(rows) + 1) * len(FEATURES), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), values], names=[*keys, "values"]
            )

    kinds = ", ".join(f"{name} {docs.schema[name].dataType.simpleString()}" for name in keys)
    rows = docs.select(*keys, "text").mapInArrow(run, f"{kinds}, values array<double>")
    return rows.select(*keys, array_to_vector("values").alias("features"))


def _learned_words(rows: DataFrame) -> dict[str, float]:
    """Words with the log-odds of the documents that have them, from (text, toxic)."""
    known = rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    toxic, clean = (known[0] or 0) + 1, (known[1] or 0) + 1
    words = rows.select("toxic", F.explode(F.array_distinct(F.expr(r"regexp_extract_all(lower(text), r'(\p{L}+)', 1)"))).alias("w"))
    counts = words.groupBy("w").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    odds = F.log((F.col("a") + 0.5) / toxic) - F.log((F.col("b") + 0.5) / clean)
    chosen = counts.where(F.col("a") >= SEEN_IN).withColumn("odds", odds).where(F.col("odds") >= WEAK)
    best = chosen.orderBy(F.desc(F.col("odds") * F.log1p("a")), "w").limit(LEXICON_WORDS)
    return {row.w: float(row.odds) for row in best.collect()}


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) covers.

    About ``toxic_rows`` and ``clean_rows`` of them, those whose hash of the id is low; the
    calibration weighs them back to the shares of all labelled rows. A document with two labels is toxic if one
    says so; null labels and ids teach nothing. If a class is missing, every score is the toxic share.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {row.toxic: row["count"] for row in known.groupBy("toxic").count().collect()}
    bounds = {kind: toxic_rows if kind == 1 else clean_rows for kind in totals}
    chosen = known.where(by_hash("doc_id", "toxic", totals, bounds))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)))
    rows = store_and_reload(rows.withColumn("toxic", F.col("toxic").cast("double")), "labelled")
    taken = {row.toxic: row["count"] for row in rows.groupBy("toxic").count().collect()}
    share = totals.get(1, 0) / max(sum(totals.values()), 1)
    if len(taken) < 2:
        return Model({}, None, None, share)
    lexicon = _learned_words(rows.where("fold < 2"))
    weight = F.when(F.col("toxic") == 1, totals[1] / taken[1]).otherwise(totals[0] / taken[0])
    ready = with_features(rows, lexicon, ["toxic", "fold"]).withColumn("weight", weight).coalesce(4)
    ready = store_and_reload(ready.select("toxic", "fold", "weight", vector_to_array("features").alias("values")), "features")
    ready = ready.withColumn("features", array_to_vector("values")).coalesce(4)
    grown, held = ready.where("fold = 2"), ready.where("fold = 3")
    if min(part.select("toxic").distinct().count() for part in (grown, held)) < 2:
        grown = held = ready.where("fold >= 2")
        if ready.where("fold >= 2").select("toxic").distinct().count() < 2:
            grown = held = ready
    trees = GBTClassifier(labelCol="toxic", maxIter=30, maxDepth=3, stepSize=0.2, checkpointInterval=-1, seed=1).fit(grown)
    curve = IsotonicRegression(labelCol="toxic", weightCol="weight", featuresCol="raw").fit(_raw(trees, held))
    return Model(lexicon, trees, curve, share)


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("raw", vector_to_array("probability")[1]).drop(
        "rawPrediction", "probability", "prediction"
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs`` (doc_id, text, any other columns).

    Null and empty texts are scored like any other, by features that are all nought. Repeated rows stay
    repeated; an empty table gives no rows.
    """
    if model.trees is None:
        rows = docs.select("doc_id", F.lit(model.share).alias("score"))
    else:
        rows = model.curve.setFeaturesCol("raw").setPredictionCol("score").transform(
            _raw(model.trees, with_features(docs, model.lexicon, ["doc_id"]))
        )
    chance = F.greatest(F.least(F.col("score"), F.lit(1.0)), F.lit(0.0))
    return rows.select("doc_id", chance.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
