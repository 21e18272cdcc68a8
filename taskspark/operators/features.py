"""Features of cleaned tasks."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taskspark import vocab
from taskspark.functions.dates import day_span, read_dates, whole_days
from taskspark.functions.texts import contains_any, fold_case, fold_text_columns, int_or_na, keep_listed, to_flag
from taskspark.operators.cleaning import DATES, ITEM
from taskspark.operators.groups import with_group_values
from taskspark.operators.impute import fill_numbers

MARKED_TEXTS = (
    "Notification", "SupplierVendor", "DamageCode", "TaskCreatedMonth", "TaskCreatedQuarter", "Engine",
)
FLAGS = ("IsTurnback", "IsLife")
UNKNOWN_LATER = (
    "Completed_On", "Planned_Start", "Planned_Finish", "TaskStatus", "IsTaskCompleted",
    "IsItemCompleted",
)
IDENTIFYING = ("Id", "Notification", "Task_Created_On", "TaskText", "Item_Created_On", "Material")


def with_calendar(task: DataFrame) -> DataFrame:
    """Year, month and quarter of creation."""
    return task.withColumns(
        {
            "TaskCreatedYear": F.year("Created_On"),
            "TaskCreatedMonth": F.month("Created_On"),
            "TaskCreatedQuarter": F.quarter("Created_On"),
        }
    )


def item_created_on(task: DataFrame) -> DataFrame:
    """First creation date of each item."""
    return task.groupBy(*ITEM).agg(F.min("Created_On").alias("Item_Created_On"))


def with_item_start(task: DataFrame) -> DataFrame:
    """First creation date of the item, and the days from it to the task, both days counted."""
    df = with_group_values(task, ITEM, F.min("Created_On").alias("Item_Created_On"))
    df = df.withColumnRenamed("Created_On", "Task_Created_On")
    span = day_span(F.col("Item_Created_On"), F.col("Task_Created_On"))
    return df.withColumn("DaysFromItemStart", span)


def with_text_flags(task: DataFrame, words: Mapping[str, str] = vocab.TEXT_FLAGS) -> DataFrame:
    """A flag per word of the task code text, which is dropped."""
    flags = {name: contains_any(F.col("TaskCodeText"), [word]) for name, word in words.items()}
    return task.withColumns(flags).drop("TaskCodeText")


def with_bins(task: DataFrame, kept: Mapping[str, Sequence[str]] = vocab.KEPT_VALUES) -> DataFrame:
    """Values outside the kept ones become ``other``."""
    return task.withColumns({c: keep_listed(F.col(c), values) for c, values in kept.items()})


def with_owner_experience(task: DataFrame) -> DataFrame:
    """Number of tasks of the owner instead of the owner; 0 for texts that contain ``na``."""
    df = with_group_values(task, ["TaskOwner"], F.count("*").alias("__tasks"), measured=True)
    known = ~F.lower("TaskOwner").contains("na")
    count = F.when(known, F.col("__tasks")).otherwise(0)
    return df.withColumn("TaskOwnerExperience", count).drop("TaskOwner", "__tasks")


def days_per_task(days: Column, task: Column) -> Column:
    """Days over task number; task number 0 gives null."""
    return F.try_divide(days.cast("double"), task.cast("double"))


def seasonality(month: Column) -> Column:
    """Cosine of the month's place in the year."""
    return F.cos(2 * math.pi * month.cast("double") / 12)


def task_duration(task: DataFrame) -> DataFrame:
    """Whole days from creation to completion."""
    days = whole_days(F.col("Task_Created_On"), F.col("Completed_On"))
    return task.withColumn("TaskDuration", days)


def features(
    task: DataFrame,
    text_flags: Mapping[str, str] = vocab.TEXT_FLAGS,
    kept: Mapping[str, Sequence[str]] = vocab.KEPT_VALUES,
) -> DataFrame:
    """All features of a cleaned task set. Owner counts are those of this set.

    The owners come first, on the rows as they arrive: they are counted in a pass of their own, which
    then reads one column and none of the joins below. The text that only flags are taken from goes before the
    rows are shuffled for their items.
    """
    owner = F.lower(int_or_na(task, "TaskOwner"))
    df = with_owner_experience(task.withColumn("TaskOwner", owner))
    if isinstance(df.schema["TaskCodeText"].dataType, T.StringType):
        df = df.withColumn("TaskCodeText", fold_case(F.col("TaskCodeText")))
    df = with_text_flags(df, text_flags)
    df = with_item_start(with_calendar(read_dates(df, DATES)))
    df = df.withColumn("Seasonality", seasonality(F.col("TaskCreatedMonth")))
    df = df.withColumns(
        {
            **{c: int_or_na(df, c) for c in MARKED_TEXTS},
            **{c: to_flag(F.col(c)) for c in FLAGS},
        }
    )
    df = with_bins(fold_text_columns(df), kept)
    days = days_per_task(F.col("DaysFromItemStart"), F.col("Task"))
    return df.withColumn("DaysPerTask", days)


def usable_columns(df: DataFrame) -> DataFrame:
    """Without what is unknown for open tasks and what only names a row."""
    return df.drop(*UNKNOWN_LATER, *IDENTIFYING)


def feature_column(df: DataFrame, name: str) -> Column:
    """Feature by name: a number column, or 1 where ``Column_value`` holds, or 0 if neither exists."""
    if name in df.columns and isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name).cast("double")
    column, _, value = name.partition("_")
    if column not in df.columns:
        return F.lit(0.0)
    if isinstance(df.schema[column].dataType, T.BooleanType):
        value = value.lower()
    return F.when(F.col(column).cast("string") == value, 1.0).otherwise(0.0)


def number_features(df: DataFrame, selected: Sequence[str]) -> list[str]:
    """The selected features that are number columns, the ones a fill value is learned for."""
    return [
        c for c in selected if c in df.columns and isinstance(df.schema[c].dataType, T.NumericType)
    ]


def source_columns(df: DataFrame, selected: Sequence[str]) -> list[str]:
    """Columns of ``df`` the selected features are computed from."""
    wanted = {c if c in df.columns else c.partition("_")[0] for c in selected}
    return [c for c in df.columns if c in wanted]


def feature_matrix(
    df: DataFrame,
    fills: dict[str, float],
    selected: Sequence[str] = vocab.SELECTED_FEATURES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The selected features, in that order, one column each."""
    filled = fill_numbers(df, {c: v for c, v in fills.items() if c in selected})
    return filled.select(*keep, *[feature_column(filled, c).alias(c) for c in selected])


def as_vector(df: DataFrame, selected: Sequence[str] = vocab.SELECTED_FEATURES) -> DataFrame:
    """The feature columns as one vector column ``features``."""
    assembled = VectorAssembler(inputCols=list(selected), outputCol="features").transform(df)
    return assembled.drop(*selected)
