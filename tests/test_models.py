import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from taskspark.operators import outliers
from taskspark.plans import jobs, models
from taskspark.session import scratch_path
from workload import tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rules():
    return tables.model_rules(classifier_rounds=6, regressor_rounds=3, depth=4)


@pytest.fixture(scope="module")
def tasks(spark):
    path = scratch_path(spark, "tasks")
    tables.model_tasks(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def points(spark, n=600):
    rng = np.random.default_rng(1)
    rows = [(k, float(x), float(y)) for k, (x, y) in enumerate(rng.normal(size=(n, 2)))] + [(n, 60.0, -60.0)]
    return spark.createDataFrame(rows, "Id int, x double, y double")


def test_far_point_is_an_outlier_in_any_partitioning(spark):
    df = points(spark)
    scores = {}
    for parts in (1, 7):
        got = outliers.with_outlier_score(df.repartition(parts), ["x", "y"]).collect()
        scores[parts] = {r["Id"]: r["outlier_score"] for r in got}
    assert scores[1] == scores[7] and len(scores[1]) == 601
    assert max(scores[1], key=scores[1].get) == 600 and scores[1][600] > 0.7
    kept = {r["Id"] for r in outliers.drop_outliers(df, ["x", "y"]).collect()}
    assert kept == {k for k, s in scores[1].items() if s <= 0.5 + 1e-9}


def test_depths_equal_a_walk_of_each_tree(spark):
    forest = outliers.grow_forest(points(spark), ["x", "y"])
    rows = np.random.default_rng(2).normal(size=(50, 2))

    def walk(tree, row):
        at = 0
        while forest.feature[tree, at] >= 0:
            at = forest.low[tree, at] + (row[forest.feature[tree, at]] > forest.cut[tree, at])
        return forest.depth[tree, at]

    want = [np.mean([walk(t, row) for t in range(outliers.TREES)]) for row in rows]
    assert np.allclose(outliers.path_depths(forest.nodes, rows), want)


def test_equal_rows_are_no_outliers(spark):
    df = spark.range(300).select(F.col("id").alias("Id"), F.lit(1.0).alias("x"))
    assert outliers.drop_outliers(df, ["x"]).count() == 300


def test_missing_value_raises(spark):
    df = points(spark).withColumn("x", F.when(F.col("Id") != 3, F.col("x")))
    with pytest.raises(Exception, match="missing value"):
        outliers.drop_outliers(df, ["x", "y"]).count()


def test_train_save_load_predict(spark, tasks, rules, tmp_path):
    trained = jobs.train_model(tasks, str(tmp_path / "models"), rules)
    assert models.Models.load(spark, str(tmp_path / "models")).selected == list(rules.selected)
    want = {tuple(r) for r in models.predict(tasks, trained, rules).collect()}
    jobs.predict_model(tasks, str(tmp_path / "models"), str(tmp_path / "out"), "day", rules)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r["ModelDataInputId"], r["predictionResult"]) for r in got} == want
    open_tasks = models.inference_rows(rules.features(tasks))
    assert {i for i, _ in want} == {r["Id"] for r in open_tasks.select("Id").collect()}
    assert all(isinstance(days, int) for _, days in want)
    assert -1 in {days for _, days in want}


@pytest.mark.parametrize("name", ["train_classifier", "train_regressor", "predict_duration"])
def test_queries_train_with_the_full_number_of_rounds(spark, monkeypatch, name):
    seen = []

    def stop(task, rules):
        seen.append((rules.classifier_rounds, rules.regressor_rounds))
        raise InterruptedError

    monkeypatch.setattr(models, "training_matrix", stop)
    with pytest.raises(InterruptedError):
        entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert seen == [(100, 700)]
