"""Training and prediction of task durations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taskspark import vocab
from taskspark.operators.features import (
    as_vector,
    feature_matrix,
    features,
    number_features,
    source_columns,
    task_duration,
)
from taskspark.operators.impute import medians
from taskspark.operators.outliers import drop_outliers
from taskspark.session import enable_checkpoints, store_and_reload


@dataclass(frozen=True)
class ModelRules:
    """Words, bins and training settings."""

    text_flags: Mapping[str, str] | None = None
    kept: Mapping[str, Sequence[str]] | None = None
    selected: Sequence[str] = vocab.SELECTED_FEATURES
    first_year: int = vocab.FIRST_YEAR
    long_task_days: int = vocab.LONG_TASK_DAYS
    long_task_weight: float = 15.0
    depth: int = 6
    classifier_rounds: int = 100
    classifier_rate: float = 0.05
    regressor_rounds: int = 700
    regressor_rate: float = 0.001
    seed: int = vocab.SEED

    def features(self, task: DataFrame) -> DataFrame:
        return features(
            task,
            vocab.TEXT_FLAGS if self.text_flags is None else self.text_flags,
            vocab.KEPT_VALUES if self.kept is None else self.kept,
        )


@dataclass(frozen=True)
class Models:
    """Both models, the fill values of their features and the features' order."""

    classifier: GBTClassificationModel
    regressor: GBTRegressionModel
    fills: dict[str, float]
    selected: Sequence[str]

    def save(self, spark: SparkSession, path: str) -> None:
        self.classifier.write().overwrite().save(f"{path}/classifier")
        self.regressor.write().overwrite().save(f"{path}/regressor")
        rows = [(n, c, self.fills.get(c)) for n, c in enumerate(self.selected)]
        frame = spark.createDataFrame(rows, "place int, name string, fill double")
        frame.coalesce(1).write.mode("overwrite").json(f"{path}/features")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Models:
        rows = (
            spark.read.schema("place int, name string, fill double")
            .json(f"{path}/features")
            .orderBy("place")
            .collect()
        )
        return Models(
            GBTClassificationModel.load(f"{path}/classifier"),
            GBTRegressionModel.load(f"{path}/regressor"),
            {r["name"]: r["fill"] for r in rows if r["fill"] is not None},
            [r["name"] for r in rows],
        )


def training_rows(prepared: DataFrame, first_year: int = vocab.FIRST_YEAR) -> DataFrame:
    """Tasks of completed items that are no planning tasks, from ``first_year`` on, with duration."""
    rows = prepared.where(
        F.col("IsItemCompleted") & ~F.col("IsPlanning") & (F.year("Task_Created_On") >= first_year)
    )
    return task_duration(rows)


def inference_rows(prepared: DataFrame) -> DataFrame:
    """Open tasks of open items, with features computed on the whole set before."""
    return prepared.where(~F.col("IsItemCompleted") & ~F.col("IsTaskCompleted"))


def duration_label(rows: DataFrame, days: int = vocab.LONG_TASK_DAYS) -> DataFrame:
    """1 for tasks of more than ``days`` days."""
    return rows.withColumn("label", F.when(F.col("TaskDuration") <= days, 0).otherwise(1))


def training_matrix(task: DataFrame, rules: ModelRules) -> tuple[DataFrame, dict[str, float]]:
    """Feature vectors, duration and label of the inliers, and the fill values learned from them.

    Both row sets are read several times, so they are stored with just the columns the forest and the
    features need.
    """
    rows = training_rows(rules.features(task), rules.first_year)
    needed = {"Id", *vocab.OUTLIER_COLUMNS, *source_columns(rows, rules.selected)}
    rows = store_and_reload(rows.select(*[c for c in rows.columns if c in needed]), "training")
    inliers = store_and_reload(drop_outliers(rows, seed=rules.seed), "inliers")
    fills = medians(inliers, number_features(inliers, rules.selected))
    matrix = feature_matrix(inliers, fills, rules.selected, keep=["TaskDuration"])
    return duration_label(as_vector(matrix, rules.selected), rules.long_task_days), fills


def train_classifier(matrix: DataFrame, rules: ModelRules) -> GBTClassificationModel:
    """Long task or not; long tasks weigh more."""
    enable_checkpoints(matrix.sparkSession)
    weight = F.when(F.col("label") == 1, rules.long_task_weight).otherwise(1.0)
    return GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=rules.classifier_rounds,
        stepSize=rules.classifier_rate, maxDepth=rules.depth, seed=rules.seed,
    ).fit(matrix.withColumn("weight", weight))


def train_regressor(
    matrix: DataFrame, classifier: GBTClassificationModel, rules: ModelRules
) -> GBTRegressionModel:
    """Duration of the tasks the classifier calls short and that took more than a day."""
    enable_checkpoints(matrix.sparkSession)
    short = classifier.transform(matrix).where(F.col("prediction") == 0)
    rows = short.where(F.col("TaskDuration") > 1).select("features", "TaskDuration")
    if rows.isEmpty():
        raise ValueError("the classifier calls no task of more than a day short")
    return GBTRegressor(
        featuresCol="features", labelCol="TaskDuration", maxIter=rules.regressor_rounds,
        stepSize=rules.regressor_rate, maxDepth=rules.depth, seed=rules.seed,
    ).fit(rows)


def train(task: DataFrame, rules: ModelRules = ModelRules()) -> Models:
    """Both models from a cleaned task set."""
    matrix, fills = training_matrix(task, rules)
    classifier = train_classifier(matrix, rules)
    regressor = train_regressor(matrix, classifier, rules)
    return Models(classifier, regressor, fills, rules.selected)


def predict(task: DataFrame, models: Models, rules: ModelRules = ModelRules()) -> DataFrame:
    """-1 for open tasks that will take long, whole days for the others, by task id."""
    open_tasks = inference_rows(rules.features(task))
    matrix = feature_matrix(open_tasks, models.fills, models.selected, keep=["Id"])
    rows = as_vector(matrix, models.selected)
    classified = models.classifier.transform(rows).select("Id", "features", F.col("prediction").alias("long"))
    days = models.regressor.setPredictionCol("days").transform(classified)
    result = F.when(F.col("long") == 1, -1).otherwise(F.ceil("days").cast("int"))
    return days.select(F.col("Id").alias("ModelDataInputId"), result.alias("predictionResult"))
