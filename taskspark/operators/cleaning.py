"""Cleaning of the task fact: general code, star join, tags, corrections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark import vocab
from taskspark.functions.dates import date_text, read_dates
from taskspark.functions.texts import contains_any, fold_case
from taskspark.operators.groups import with_group_values
from taskspark.session import TIGHT, store_and_reload

ITEM = ("Notification", "Item")
DATES = ("Created_On", "Completed_On", "Planned_Start", "Planned_Finish")

FACT_COLUMNS = (
    "Notification", "Item", "LayoutTaskId", "Task", "Material", "Created_On", "Completed_On",
    "TaskText", "TaskCodeId", "Planned_Start", "Planned_Finish", "SupplierVendorId",
    "TaskOwnerId", "TaskStatusId", "DamageCodeId", "CauseCodeId", "GroupCodeId", "CategoryId",
)


@dataclass(frozen=True)
class CleaningRules:
    """Words and codes the rules look for."""

    turnback_words: Sequence[str] = vocab.TURNBACK_WORDS
    life_words: Sequence[str] = vocab.LIFE_WORDS
    drop_code_words: Sequence[str] = vocab.DROP_CODE_WORDS
    drop_text_words: Sequence[str] = vocab.DROP_TEXT_WORDS
    close_code_words: Sequence[str] = vocab.CLOSE_CODE_WORDS
    close_text_words: Sequence[str] = vocab.CLOSE_TEXT_WORDS
    far_future: str = vocab.FAR_FUTURE
    planning_codes: Sequence[str] = vocab.PLANNING_CODES
    planning_group: str = vocab.PLANNING_GROUP
    planning_group_codes: Sequence[str] = vocab.PLANNING_GROUP_CODES
    literal_case: bool = False
    null_out_of_range: bool = True


def with_general_code(codes: DataFrame, general: DataFrame) -> DataFrame:
    """Task codes, upper case, with the general code of their group and code."""
    low = codes.withColumns({c: fold_case(F.col(c)) for c in ("TaskCode", "GroupCode")})
    general = general.select("Code_Group", "Task_Code", F.col("General_Code").alias("GeneralCode"))
    match = (F.col("GroupCode") == F.col("Code_Group")) & (F.col("TaskCode") == F.col("Task_Code"))
    joined = low.join(general, match, "left").drop("Code_Group", "Task_Code")
    return joined.withColumns({c: F.upper(c) for c in ("TaskCode", "GroupCode")})


def star_join(
    sources: Mapping[str, DataFrame],
    fact_columns: Sequence[str] = FACT_COLUMNS,
    items: DataFrame | None = None,
    staged: bool = False,
) -> DataFrame:
    """The task fact with the columns of its nine dimensions; unknown ids give nulls.

    The dimensions that grow with the fact come first, while its rows are narrow: what Spark broadcasts adds its
    texts to rows that are not shuffled any more.

    ``items`` has one row for each pair of keys in the fact, with columns to add. The programs then meet these few
    rows, and the fact moves once for both. ``staged`` stores the fact with its programs before it moves for the task
    codes, so that the shuffles up to there are gone from the disks by then. The smaller dimensions are stored before:
    Spark then knows their sizes, and does not move the fact for one that it has yet to measure.
    """

    def dim(name: str, *columns: str) -> DataFrame:
        found = sources[name].select(*columns)
        return store_and_reload(found, name) if staged else found

    programs = sources["EngineProgram"].select("Notification", "Coding", F.col("Description").alias("Engine"))
    codes = sources["TaskCode"].select("TaskCodeId", "TaskCode", "TaskCodeText", "GeneralCode")
    fact = sources["LayoutProcessingTask"].select(*fact_columns)
    if items is None:
        task = fact.join(programs, "Notification", "left")
    else:
        keys = {c: f"__item_{c}" for c in ITEM}
        known = items.join(programs, "Notification", "left").withColumnsRenamed(keys)
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in keys.items()])
        task = fact.join(known, same, "left").drop(*keys.values())
    if staged:
        task = store_and_reload(task, "programs", compression=TIGHT)
    task = (
        task.join(codes, "TaskCodeId", "left")
        .join(dim("SupplierVendor", "SupplierVendorId", "SupplierVendor"), "SupplierVendorId", "left")
        .join(dim("TaskOwner", "TaskOwnerId", "TaskOwner"), "TaskOwnerId", "left")
        .join(dim("TaskStatus", "TaskStatusId", "TaskStatus"), "TaskStatusId", "left")
        .join(dim("GroupCode", "GroupCodeId", "GroupCode"), "GroupCodeId", "left")
        .join(dim("CauseCode", "CauseCodeId", "CauseCode"), "CauseCodeId", "left")
        .join(dim("DamageCode", "DamageCodeId", "DamageCode"), "DamageCodeId", "left")
        .join(dim("Category", "CategoryId", "Category"), "CategoryId", "left")
    )
    last = ["TaskCode", "TaskCodeText", "GeneralCode"]
    return task.select("TaskCodeId", *[c for c in task.columns if c not in ("TaskCodeId", *last)], *last)


def typed(task: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Whole-number keys, text as text, dates as timestamps, engine in lower case."""
    return with_types(read_dates(task, DATES, rules.null_out_of_range))


def with_types(task: DataFrame) -> DataFrame:
    """``typed`` for tasks whose dates are read."""
    return task.withColumns(
        {
            **{c: F.col(c).try_cast("bigint") for c in ("Notification", "Item", "Task")},
            "TaskText": F.coalesce(F.col("TaskText").cast("string"), F.lit("nan")),
            "Engine": F.lower("Engine"),
        }
    )


def item_states(fact: DataFrame) -> DataFrame:
    """Each pair of item keys in ``fact``, as it stands there, with ``IsItemCompleted``.

    Keys that are the same whole number are one item. The tasks are folded by their keys first, so what meets there
    are items only.
    """
    raw = fact.groupBy(*ITEM).agg(F.bool_and(F.col("Completed_On").isNotNull()).alias("__done"))
    keys = {c: f"__typed_{c}" for c in ITEM}
    raw = raw.withColumns({n: F.col(c).try_cast("bigint") for c, n in keys.items()})
    whole = F.bool_and("__done").alias("IsItemCompleted")
    return with_group_values(raw, list(keys.values()), whole).drop("__done", *keys.values())


def with_item_completed(
    task: DataFrame, of: DataFrame | None = None, keys: Sequence[str] = ITEM
) -> DataFrame:
    """``IsItemCompleted``: every task of the item, among the rows ``of``, has a completion date."""
    done = F.bool_and(F.col("Completed_On").isNotNull()).alias("IsItemCompleted")
    return with_group_values(task, keys, done, of=of)


def with_planning_flag(task: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """``IsPlanning`` by task code, or by task code within the planning group."""
    code, group = F.col("TaskCode"), F.col("GroupCode")
    if not rules.literal_case:
        code, group = F.lower(code), F.lower(group)
    lowered = (lambda v: v) if rules.literal_case else str.lower
    by_code = code.isin(*[lowered(c) for c in rules.planning_codes])
    by_group = (group == lowered(rules.planning_group)) & code.isin(
        *[lowered(c) for c in rules.planning_group_codes]
    )
    flag = F.coalesce(by_code, F.lit(False)) | F.coalesce(by_group, F.lit(False))
    return task.withColumn("IsPlanning", flag)


def with_tags(
    task: DataFrame, rules: CleaningRules = CleaningRules(), of: DataFrame | None = None
) -> DataFrame:
    """Completion, turnback, life and planning tags, from the dates before their correction.

    ``of``: the rows whose items are looked at for completion, ``task`` by default.
    """
    return with_task_tags(with_item_completed(task, of), rules)


def with_task_tags(task: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """The tags that a task has by itself."""
    in_code = contains_any(F.col("TaskCodeText"), rules.turnback_words).cast("int")
    in_text = contains_any(F.col("TaskText"), rules.turnback_words).cast("int")
    tagged = task.withColumns(
        {
            "IsTaskCompleted": F.col("Completed_On").isNotNull(),
            "IsTurnback": F.greatest(in_code, in_text),
            "IsLife": contains_any(F.col("TaskText"), rules.life_words).cast("int"),
        }
    )
    return with_planning_flag(tagged, rules)


def with_corrections(task: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Corrected dates and ``Available``. The first rule that fits a row decides.

    1. inactive, deleted, no demand: not available
    2. expiry, buffer, life or planned for the far future: completed when created
    3. created after completed: created when completed
    """
    code, text = F.col("TaskCodeText"), F.col("TaskText")
    created, completed = F.col("Created_On"), F.col("Completed_On")
    cutoff = F.lit(rules.far_future).cast("timestamp_ntz")
    dropped = contains_any(code, rules.drop_code_words) | contains_any(text, rules.drop_text_words)
    closed = (
        contains_any(code, rules.close_code_words)
        | contains_any(text, rules.close_text_words)
        | F.coalesce(F.col("Planned_Start") > cutoff, F.lit(False))
        | F.coalesce(F.col("Planned_Finish") > cutoff, F.lit(False))
    )
    branch = F.when(dropped, 1).when(closed, 2).when(created > completed, 3).otherwise(0)
    return (
        task.withColumn("__branch", branch)
        .withColumns(
            {
                "Completed_On": F.when(F.col("__branch") == 2, created).otherwise(completed),
                "Created_On": F.when(F.col("__branch") == 3, completed).otherwise(created),
                "Available": F.when(F.col("__branch") == 1, 0).otherwise(1),
            }
        )
        .drop("__branch")
    )


def clean(sources: Mapping[str, DataFrame], rules: CleaningRules = CleaningRules()) -> DataFrame:
    """The cleaned task fact of the renamed record sets.

    The joined task codes are stored first: Spark then knows their size, and shuffles the fact for
    them only if they are too large to broadcast. The fact is read twice and stored with its dates read:
    completion of items is folded from three of its columns and comes to it with the programs.
    """
    codes = with_general_code(sources["TaskCode"], sources["GeneralCode"])
    codes = store_and_reload(codes, "codes", compression=TIGHT)
    fact = read_dates(sources["LayoutProcessingTask"].select(*FACT_COLUMNS), DATES, rules.null_out_of_range)
    fact = store_and_reload(fact, "fact", compression=TIGHT)
    found = {**sources, "LayoutProcessingTask": fact, "TaskCode": codes}
    task = star_join(found, items=item_states(fact), staged=True)
    return with_corrections(with_task_tags(with_types(task), rules), rules)


def cleaned_output(task: DataFrame) -> DataFrame:
    """The 36 result columns under their result names, dates as text."""
    task = task.withColumns({c: date_text(F.col(c)) for c in DATES})
    return task.select(*[F.col(c).alias(n) for c, n in vocab.CLEANED_FIELDS.items()])
