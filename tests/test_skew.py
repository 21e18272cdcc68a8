"""One key holds a third of all rows: the plans split it, and the results are whole."""


import pytest
from pyspark.sql import functions as F

from taskspark.operators import ids, sequences
from taskspark.operators.groups import with_group_values
from taskspark.operators.keys import Lookup, new_rows, resolve
from taskspark.sources.sinks import mark_rejects

LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def low(spark):
    before = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def facts(spark, n=30_000):
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        "id", F.when(hot, 0).otherwise(F.col("id") % 997 + 1).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )


def split_and_counted(df):
    """Rows of the executed plan, which must have split a skewed join."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    return rows


def test_group_values(low):
    df = facts(low)
    got = split_and_counted(with_group_values(df, ["k"], F.count("*").alias("n")))
    assert len(got) == 30_000 and {r["n"] for r in got if r["k"] == 0} == {10_000}


def test_new_rows(low):
    loaded = low.range(1, 500).select(F.col("id").alias("k"))
    got = split_and_counted(new_rows(facts(low), loaded, ["k"]))
    assert len(got) == facts(low).where((F.col("k") == 0) | (F.col("k") >= 500)).count()


def test_resolve(low):
    dim = low.range(0, 900).select(F.col("id").alias("code"), (F.col("id") + 5).alias("Id"))
    got = split_and_counted(resolve(facts(low), [(Lookup("K", {"k": "code"}, "kid"), dim)]))
    assert len(got) == 30_000 and sum(r["reject_reason"] is not None for r in got) == facts(low).where("k >= 900").count()


def test_rejects(low):
    got = split_and_counted(mark_rejects(facts(low).drop("id"), unique=("k",)))
    assert sum(r["copies"] for r in got) == 30_000
    assert sum(r["reject_reason"] is None for r in got) == facts(low).select("k").distinct().count()


def test_pairs_and_alignment(low):
    # Notification 0 holds a third of the items, and half of those have one and the same sequence.
    items = low.range(0, 6_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97 + 1).alias("Notification"),
        F.format_string("%06d", "id").alias("Item"), F.col("id").alias("LayoutId"),
        F.when(F.col("id") % 6 == 0, F.array(F.lit("A"), F.lit("B"))).otherwise(
            F.array(F.lit("A"), F.lit("B"), F.sha2(F.col("id").cast("string"), 256))).alias("Seq"),
    )
    pairs = sequences.sequence_pairs(items)
    assert len(split_and_counted(pairs)) == 6_000 - 98
    got = split_and_counted(sequences.with_alignment(pairs))
    assert len(got) == 6_000 - 98


def test_ids_of_a_hot_row(low, monkeypatch):
    monkeypatch.setattr(ids, "HOT_COPIES", 1_000)
    df = facts(low).select(F.when(F.col("k") == 0, "hot").otherwise(F.col("v")).alias("v"))
    got = [(r["Id"], r["v"]) for r in ids.dense_ids(df, ["v"], distinct=False).orderBy("Id").collect()]
    assert [i for i, _ in got] == list(range(1, 30_001))
    assert [v for _, v in got] == sorted(v for _, v in got) and sum(v == "hot" for _, v in got) == 10_000
