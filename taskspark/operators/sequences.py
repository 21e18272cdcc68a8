"""Task sequences of items, pairs of them within a notification, and their similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskspark.functions.alignment import align_hybrid
from taskspark.session import store_and_reload

RESULT = (
    "Notification", "db_layout_id_ref", "layout_ref", "db_layout_id_test", "layout_test",
    "Seq1", "Seq2", "Align_Seq1", "Align_Seq2", "Score",
)


def with_code_names(tasks: DataFrame, codes: DataFrame) -> DataFrame:
    """Tasks with the name of their code; an unknown code stands as ``nan``."""
    names = codes.select("TaskCodeId", F.col("TaskCodeName").alias("TaskCode"))
    joined = tasks.join(names, "TaskCodeId", "left")
    return joined.withColumn("TaskCode", F.coalesce("TaskCode", F.lit("nan")))


def item_sequences(tasks: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per item: its codes in order, and the layout id of its first task.

    Item keys are text. The codes of one item are one value by definition, so they come together;
    the rows are cut to order, code and layout id before they move.
    """
    step = F.struct(*order, F.coalesce("TaskCode", F.lit("nan")).alias("TaskCode"), "LayoutId")
    return (
        tasks.groupBy("Notification", F.col("Item").cast("string").alias("Item"))
        .agg(F.array_sort(F.collect_list(step)).alias("steps"))
        .select(
            "Notification",
            "Item",
            F.col("steps")[0]["LayoutId"].alias("LayoutId"),
            F.col("steps")["TaskCode"].alias("Seq"),
        )
    )


def sequence_id(seq: Column) -> Column:
    """128 bits that stand for a sequence wherever it would be a key; two of 10^12 share them once in 10^15 runs."""
    return F.unhex(F.substring(F.sha2(F.to_json(seq), 256), 1, 32))


def coded_sequences(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with ``SeqId`` for their ``Seq``, and the dictionary of both: each sequence once.

    The items are stored, so the tasks are read and gathered once. What pairs, counts and joins items
    afterwards moves ids of one size, whatever the sequences are.
    """
    stored = store_and_reload(sequences.withColumn("SeqId", sequence_id(F.col("Seq"))), "sequences")
    dictionary = stored.select("SeqId", "Seq").dropDuplicates(["SeqId"])
    return stored.drop("Seq"), store_and_reload(dictionary, "dictionary")


def sequence_pairs(sequences: DataFrame, value: str = "Seq") -> DataFrame:
    """Every item (ref) with the item of the greatest key in its notification (test).

    A notification of one item has no pair. One pair per item, so nothing grows by the square.
    ``value`` names the column that stands for the sequence, ``Seq`` or ``SeqId``.
    """
    last = sequences.groupBy(F.col("Notification").alias("__notification")).agg(
        F.max(F.struct("Item", "LayoutId", value)).alias("last")
    )
    # Null-safe, so that both sides are shuffled for the join and a hot notification is split.
    return (
        sequences.join(last, F.col("Notification").eqNullSafe(F.col("__notification")))
        .where(F.col("Item") < F.col("last.Item"))
        .select(
            "Notification",
            F.col("LayoutId").alias("db_layout_id_ref"),
            F.col("Item").alias("layout_ref"),
            F.col("last.LayoutId").alias("db_layout_id_test"),
            F.col("last.Item").alias("layout_test"),
            F.col(value).alias(f"{value}1"),
            F.col(f"last.{value}").alias(f"{value}2"),
        )
    )


def aligned_ids(pairs: DataFrame, dictionary: DataFrame, align=align_hybrid) -> DataFrame:
    """The distinct pairs of ``SeqId1`` and ``SeqId2``, with both sequences and their alignment ``a``.

    The costly step gets a fixed number of tasks: adaptive execution would merge them by bytes, and
    a pair is small for the time it takes. They are dealt out without a key, so a sequence that is in
    many pairs does not bring them into one task.
    """
    spark = pairs.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism
    )
    distinct = pairs.select("SeqId1", "SeqId2").distinct()
    for side in ("1", "2"):
        names = dictionary.select(F.col("SeqId").alias(f"SeqId{side}"), F.col("Seq").alias(f"Seq{side}"))
        distinct = distinct.join(names, f"SeqId{side}")
    return distinct.repartition(tasks).withColumn("a", align(F.col("Seq1"), F.col("Seq2")))


def with_alignment(pairs: DataFrame, align=align_hybrid) -> DataFrame:
    """Pairs of ``Seq1`` and ``Seq2`` with the columns of their alignment. Equal pairs are aligned once.

    The pairs are stored with ids of their sequences; only ids are keys of the joins.
    """
    ids = {f"SeqId{side}": sequence_id(F.col(f"Seq{side}")) for side in ("1", "2")}
    stored = store_and_reload(pairs.withColumns(ids), "pairs")
    sides = [stored.select(F.col(f"SeqId{n}").alias("SeqId"), F.col(f"Seq{n}").alias("Seq")) for n in ("1", "2")]
    dictionary = store_and_reload(sides[0].union(sides[1]).dropDuplicates(["SeqId"]), "dictionary")
    narrow = stored.drop("Seq1", "Seq2")
    aligned = aligned_ids(narrow, dictionary, align)
    return narrow.join(aligned, ["SeqId1", "SeqId2"]).select(*pairs.columns, "a.*")


def similarity(tasks: DataFrame, order: Sequence[str]) -> DataFrame:
    """Similarity of every item to the last one of its notification."""
    items, dictionary = coded_sequences(item_sequences(tasks, order))
    pairs = sequence_pairs(items, "SeqId")
    scored = pairs.join(aligned_ids(pairs, dictionary), ["SeqId1", "SeqId2"]).select("*", "a.*")
    return scored.withColumnsRenamed(
        {"align1": "Align_Seq1", "align2": "Align_Seq2", "score": "Score"}
    ).select(*RESULT)


def similarity_by_ref(tasks: DataFrame, order: Sequence[str], notification) -> DataFrame:
    """Similarity within one notification, best first."""
    found = similarity(tasks.where(F.col("Notification") == notification), order)
    return found.orderBy(F.desc("Score"), F.desc("layout_ref"))
