"""The queries of these operators over the given tables, and SQL where it can state the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taskspark.llm import licenses, secrets, sql, toxicity
from taskspark.llm.attribution import attribute
from taskspark.llm.chat import format_conversations, read_back
from taskspark.llm.collocations import collocations
from taskspark.llm.decontamination import leaks
from taskspark.llm.jaccard_join import near_duplicates
from taskspark.llm.language_id import fit, held_out, predict
from taskspark.llm.pieces import round_trip
from taskspark.llm.quality_rules import ablations, ledger, verdict
from taskspark.llm.vector_codes import compress, report
from taskspark.llm.warc import converted_pages

#: Folder of the public vocabulary files, the same on every machine.
VOCABULARIES = "/opt/tokenizers"
PIECES = f"{VOCABULARIES}/piece_bpe_32k.model"
BYTEPAIRS = f"{VOCABULARIES}/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that goes with the byte-level vocabulary.
BYTEPAIR_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of those that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    away = held_out(F.col("doc_id"), 3, 1)
    model = toxicity.fit(docs, labels.where(~away))
    return toxicity.score(docs, model).select("doc_id", away.alias("held_out"), "score", "predicted")


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate documents: component of every document."""
    return near_duplicates(table(spark, folder, "documents"))


def op1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every whole text, decoded again and compared with it."""
    return round_trip(table(spark, folder, "documents"), PIECES)


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements, failed rules and verdict of every document under policy 2."""
    return verdict(ledger(table(spark, folder, "documents")), 2)


def rule_ablations(spark: SparkSession, folder: str) -> DataFrame:
    """What each rule of policy 2 does to all documents, and what would be kept without it."""
    return ablations(ledger(table(spark, folder, "documents")), 2)


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every field and line of every document."""
    return attribute(table(spark, folder, "documents"), BYTEPAIRS, BYTEPAIR_PATTERN)


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of documents that are copies of benchmark items."""
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted and read back, and one whose texts hold control strings."""
    tricky = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)]
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(turns.union(spark.createDataFrame(rows, turns.schema))))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    away = held_out(F.col("doc_id"), 4, 2)
    model = fit(docs.where(~away))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", away.alias("held_out"), "lang_pred", "score")


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.digest(secrets.scan(table(spark, folder, "documents")))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License notices of every document."""
    return licenses.scan(table(spark, folder, "documents"))


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page in a WARC archive that was converted from ARC archives, as read back."""
    return converted_pages(table(spark, folder, "pages"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Code and error of every vector, with codebooks from ball k-means over all of them."""
    return report(*compress(table(spark, folder, "embeddings")))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 strongest phrases of each language."""
    return collocations(table(spark, folder, "documents"))


QUERIES = {
    "op1_pieces": op1_pieces,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontamination": op5_decontamination,
    "op6_chat": op6_chat,
    "op7_language_id": op7_language_id,
    "op8_secrets": op8_secrets,
    "op9_licenses": op9_licenses,
    "op10_token_counts": op10_token_counts,
    "op11_warc": op11_warc,
    "op12_vector_codes": op12_vector_codes,
    "op13_collocations": op13_collocations,
    "rule_ablations": rule_ablations,
}
ORACLE = {
    "op3_jaccard_join": sql.JACCARD,
    "op4_quality_rules": sql.QUALITY,
    "rule_ablations": sql.ABLATIONS,
    "op6_chat": sql.CHAT,
    "op11_warc": sql.WARC,
    "op12_vector_codes": sql.VECTOR_CODES,
    "op13_collocations": sql.COLLOCATIONS,
}
