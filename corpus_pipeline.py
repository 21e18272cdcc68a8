"""A corpus in five stages, each one operator; every stage is written and read again before the next.

Language identification drops texts without a language, the Jaccard join keeps one document of each group of
near copies, decontamination drops documents with copies of benchmark items, the secret scan masks secrets,
and SentencePiece turns the texts into piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taskspark.llm import decontamination, jaccard_join, language_id, pieces, secrets
from taskspark.llm.queries import PIECES
from taskspark.session import bound_buffers, store_and_reload


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a model is fitted on the rows of ``docs`` that are not held out."""
    bound_buffers(spark)  # for this stage and those behind it: all of them move whole texts
    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"), 4, 2)))
    told = language_id.predict(docs, model)
    return told.where(F.col("lang_pred") != language_id.UNDETERMINED).select(*docs.columns)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.keep_one(docs).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with their secrets masked."""
    return secrets.redact(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the piece ids of their text."""
    return pieces.encode(docs, PIECES)


STAGES = [
    ("language_id", language_stage),
    ("jaccard_join", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("sentencepiece", pieces_stage),
]

#: The first and third stage learn and align; SQL cannot state their rows, so tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store_and_reload(stage(spark, docs, sf_dir), name)
    return docs
