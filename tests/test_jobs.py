"""Jobs from files to files: scratch tables go, results stay."""

import os

import pytest
from pyspark.sql import functions as F

from taskspark.operators import sequences
from taskspark.plans import jobs
from taskspark.session import job_scratch, scratch_path, scratch_root, store_and_reload

TASKS = "Notification long, Item string, LayoutId long, Id long, TaskCodeId long"


@pytest.fixture
def coded(spark):
    rows = [(1, "a", 10, 1, 1), (1, "a", 10, 2, 2), (1, "b", 11, 3, 1), (1, "b", 11, 4, 9), (2, "c", 12, 5, 1), (None, "d", 13, 6, 1),
            (None, "e", 14, 7, None)]
    codes = spark.createDataFrame([(1, "cut"), (2, "weld")], "TaskCodeId long, TaskCodeName string")
    return spark.createDataFrame(rows, TASKS), codes


def tables(spark):
    root = scratch_root(spark).removeprefix("file:")
    return {os.path.join(at, d) for at, folders, _ in os.walk(root) for d in folders}


def test_similarities_take_names_from_codes(spark, coded, tmp_path):
    tasks, codes = coded
    before = tables(spark)
    jobs.all_similarities(tasks, ["Id"], str(tmp_path / "out"), "day", codes)
    assert tables(spark) == before
    got = spark.read.parquet(str(tmp_path / "out"))
    rows = {(r["layout_ref"], r["layout_test"], tuple(r["TaskSequenceRef"]), tuple(r["TaskSequenceTest"])) for r in got.collect()}
    assert rows == {("a", "b", ("cut", "weld"), ("cut", "nan")), ("d", "e", ("cut",), ("nan",))}
    one = jobs.similarities_of(tasks, ["Id"], 1, codes).collect()
    assert [(r["layout_ref"], r["Seq1"], r["Seq2"]) for r in one] == [("a", ["cut", "weld"], ["cut", "nan"])]


def test_similarities_of_nothing(spark, coded, tmp_path):
    tasks, codes = coded
    jobs.all_similarities(tasks.limit(0), ["Id"], str(tmp_path / "out"), "day", codes)
    assert spark.read.schema("layout_ref string, run_date string").parquet(str(tmp_path / "out")).count() == 0


def test_sequences_of_other_cuts_have_other_ids(spark):
    texts = [["a", "b"], ["a b"], ["a,b"], ['a","b'], ["ab"], [""], [], ["", ""]]
    df = spark.createDataFrame([(t,) for t in texts], "Seq array<string>").withColumn("SeqId", sequences.sequence_id(F.col("Seq")))
    assert len({bytes(r["SeqId"]) for r in df.collect()}) == len(texts)
    items = df.select(F.lit(1).alias("Notification"), F.concat_ws("|", "Seq").alias("Item"), F.lit(1).alias("LayoutId"), "Seq")
    narrow, dictionary = sequences.coded_sequences(items.union(items))
    assert narrow.columns == ["Notification", "Item", "LayoutId", "SeqId"] and narrow.count() == 2 * len(texts)
    assert sorted(r["Seq"] for r in dictionary.collect()) == sorted(texts)


def test_equal_pairs_are_aligned_once(spark):
    pairs = spark.createDataFrame([(i, ["a", "b"], ["a"]) for i in range(20)], "k int, Seq1 array<string>, Seq2 array<string>")
    ids = pairs.withColumns({f"SeqId{n}": sequences.sequence_id(F.col(f"Seq{n}")) for n in (1, 2)})
    dictionary = spark.createDataFrame([(["a", "b"],), (["a"],)], "Seq array<string>").withColumn("SeqId", sequences.sequence_id(F.col("Seq")))
    assert sequences.aligned_ids(ids, dictionary).count() == 1
    assert sequences.with_alignment(pairs).count() == 20


def test_scratch_of_a_job_goes_and_that_of_others_stays(spark):
    mine = store_and_reload(spark.range(3), "outer")
    with pytest.raises(ZeroDivisionError), job_scratch(spark):
        inner = scratch_path(spark, "inner")
        spark.range(3).write.parquet(inner)
        with job_scratch(spark):
            store_and_reload(spark.range(3), "nested")
        assert spark.read.parquet(inner).count() == 3
        raise ZeroDivisionError
    assert mine.count() == 3
    assert not os.path.exists(inner.removeprefix("file:"))
