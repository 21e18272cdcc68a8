"""Queries of scalar functions, cleaning, features, sequences and models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.functions import dates, texts
from taskspark.functions.alignment import align_global, align_hybrid, align_local
from taskspark.operators import cleaning, features, impute, sequences
from taskspark.operators.outliers import drop_outliers as drop
from taskspark.plans import jobs, models
from taskspark.session import scratch_path, store_and_reload
from taskspark.sources.scans import load_sources
from taskspark.vocab import CLEANED_FIELDS, SIMILARITY_FIELDS
from workload import tables
from workload.alignment_sql import aligned
from workload.registry import query
from workload.tables import KEPT, RULES, SELECTED, TEXT_FLAGS

WO = tables.with_clauses("work_orders")
MT = tables.with_clauses("work_orders", "model_tasks")
DATES = ("Created_On", "Completed_On", "Planned_Start", "Planned_Finish")

def dates_as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: dates.date_text(F.col(c)) for c in names})


# --- scalar functions -----------------------------------------------------------------------


@query(
    "cast_map",
    f"{WO} SELECT Id, TRY_CAST(Material AS INT) AS Material, TRY_CAST(TaskText AS BIGINT) AS TaskText,"
    " CAST(Task AS DOUBLE) AS Task FROM work_orders",
)
def cast_map(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir).select("Id", "Material", "TaskText", "Task")
    return texts.cast_columns(rows, {"Material": "int", "TaskText": "bigint", "Task": "double"})


@query(
    "case_fold",
    f"{WO} SELECT Id, lower(coalesce(TaskOwner, 'nan')) AS low, upper(coalesce(TaskOwner, 'nan')) AS up,"
    " lower(coalesce(CauseCode, 'nan')) AS CauseCode, lower(Category) AS Category FROM work_orders",
)
def case_fold(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir)
    folded = texts.fold_text_columns(rows.select("Id", "CauseCode", "Category", "TaskOwner"))
    return folded.select(
        "Id",
        F.col("TaskOwner").alias("low"),
        texts.fold_case(F.col("TaskOwner"), upper=True).alias("up"),
        "CauseCode",
        "Category",
    )


STAMP = "'^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$'"
LIFE = "'^[0-9]{1,2}-[0-9]{1,2}-[7-9]{4}'"


@query(
    "sentinel_dates",
    f"""{tables.with_clauses('date_texts')}
SELECT l_orderkey, l_linenumber, stored,
       CASE WHEN stored IS NULL OR stored IN ('', 'nan') THEN '1677-09-21'
            WHEN regexp_matches(stored, {LIFE}) THEN '2262-04-11'
            WHEN regexp_matches(stored, {STAMP}) THEN CAST(CAST(TRY_CAST(stored AS TIMESTAMP) AS DATE) AS VARCHAR)
       END AS day
FROM date_texts""",
)
def sentinel_dates(spark, sf_dir):
    rows = tables.date_texts(spark, sf_dir)
    day = dates.sentinel_date(F.col("stored")).alias("day")
    return rows.select("l_orderkey", "l_linenumber", "stored", day)


@query(
    "life_date_text",
    f"""{tables.with_clauses('date_texts')}
SELECT l_orderkey, l_linenumber,
       CASE WHEN regexp_matches(stored, {LIFE}) THEN '11-04-2262' ELSE stored END AS day
FROM date_texts""",
)
def life_date_text(spark, sf_dir):
    rows = tables.date_texts(spark, sf_dir)
    return rows.select("l_orderkey", "l_linenumber", dates.life_date_text(F.col("stored")).alias("day"))


READ_SQL = """
SELECT *, CASE WHEN stamp BETWEEN TIMESTAMP '1677-09-21 00:12:43.145225'
                   AND TIMESTAMP '2262-04-11 23:47:16.854775' THEN stamp END AS readable
FROM (SELECT *, CASE WHEN regexp_matches(sent, '^[0-9]{4}[-/]')
                     THEN TRY_CAST(replace(sent, '/', '-') AS TIMESTAMP) END AS stamp FROM date_texts)
"""


@query(
    "parse_dates",
    f"{tables.with_clauses('date_texts')} SELECT l_orderkey, l_linenumber, sent,"
    f" strftime(readable, '%Y-%m-%d %H:%M:%S') AS stamp FROM ({READ_SQL})",
)
def parse_dates(spark, sf_dir):
    rows = tables.date_texts(spark, sf_dir)
    read = dates.read_dates(rows.withColumn("stamp", F.col("sent")), ["stamp"])
    stamp = F.date_format("stamp", "yyyy-MM-dd HH:mm:ss").alias("stamp")
    return read.select("l_orderkey", "l_linenumber", "sent", stamp)


SPAN_SQL = (
    "SELECT l_orderkey, l_linenumber, o_orderdate AS a, l_shipdate + INTERVAL 9 HOUR AS b,"
    " o_orderdate + INTERVAL 17 HOUR AS c FROM lineitem JOIN orders ON o_orderkey = l_orderkey"
)


@query(
    "day_span",
    f"""SELECT l_orderkey, l_linenumber,
       CAST(floor((epoch_us(b) - epoch_us(a)) / 86400000000.0) + 1 AS INT) AS forward,
       CAST(floor((epoch_us(c) - epoch_us(b)) / 86400000000.0) + 1 AS INT) AS backward
FROM ({SPAN_SQL})""",
)
def day_span(spark, sf_dir):
    tables.given(spark, sf_dir, "lineitem", "orders")
    return spark.sql(SPAN_SQL).select(
        "l_orderkey",
        "l_linenumber",
        dates.day_span(F.col("a"), F.col("b")).alias("forward"),
        dates.day_span(F.col("b"), F.col("c")).alias("backward"),
    )


@query(
    "calendar_parts",
    f"{WO} SELECT Id, year(Created_On) AS TaskCreatedYear, month(Created_On) AS TaskCreatedMonth,"
    " quarter(Created_On) AS TaskCreatedQuarter FROM work_orders",
)
def calendar_parts(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir).select("Id", "Created_On")
    return features.with_calendar(rows).drop("Created_On")


@query(
    "keyword_flags",
    f"{WO} SELECT Id, TaskCodeText LIKE '%ring%' OR TaskCodeText LIKE '%rod%' AS in_code,"
    " lower(TaskText) LIKE '%medium%' AS in_text, coalesce(lower(CauseCode) LIKE '%l01%', false) AS in_cause"
    " FROM work_orders",
)
def keyword_flags(spark, sf_dir):
    return tables.work_orders(spark, sf_dir).select(
        "Id",
        texts.contains_any(F.col("TaskCodeText"), ("ring", "rod")).alias("in_code"),
        texts.contains_any(F.col("TaskText"), ("medium",)).alias("in_text"),
        texts.contains_any(F.col("CauseCode"), ("l01",)).alias("in_cause"),
    )


@query(
    "bin_categories",
    f"""{MT} SELECT Id,
       CASE WHEN Engine IN ('machinery', 'automobile') THEN Engine ELSE 'other' END AS Engine,
       CASE WHEN lower(CauseCode) IN ('l00', 'l01') THEN lower(CauseCode) ELSE 'other' END AS CauseCode,
       CASE WHEN DamageCode IN ('10', '20', '30') THEN DamageCode ELSE 'other' END AS DamageCode,
       CASE WHEN SupplierVendor IN ('1', '2', '3') THEN SupplierVendor ELSE 'other' END AS SupplierVendor
FROM model_tasks""",
)
def bin_categories(spark, sf_dir):
    rows = tables.model_tasks(spark, sf_dir).select("Id", *KEPT)
    return features.with_bins(texts.fold_text_columns(rows), KEPT)


@query(
    "engine_family",
    f"{MT} SELECT Id, CASE WHEN Engine LIKE 'ma%' OR Engine LIKE 'au%' THEN substring(Engine, 1, 3)"
    " ELSE Engine END AS family FROM model_tasks",
)
def engine_family(spark, sf_dir):
    family = texts.engine_family(F.col("Engine"), ("ma", "au")).alias("family")
    return tables.model_tasks(spark, sf_dir).select("Id", family)


@query(
    "int_or_na",
    f"{MT} SELECT Id, coalesce(TaskOwner, 'NA') AS TaskOwner,"
    " coalesce(CAST(Notification AS VARCHAR), 'NA') AS Notification,"
    " coalesce(CAST(IsLife AS VARCHAR), 'NA') AS IsLife FROM model_tasks",
)
def int_or_na(spark, sf_dir):
    rows = tables.model_tasks(spark, sf_dir)
    names = ("TaskOwner", "Notification", "IsLife")
    return rows.select("Id", *[texts.int_or_na(rows, c).alias(c) for c in names])


# --- cleaning -------------------------------------------------------------------------------

REC = tables.RECORDS
CODES_SQL = f"""
SELECT t.TaskCodeId, upper(t.TaskCodeName) AS TaskCode, t.TaskCodeText, t.GroupCodeId,
       upper(t.GroupCodeName) AS GroupCode, g.GeneralCode
FROM ({REC['TaskCode']}) t LEFT JOIN ({REC['GeneralCode']}) g
  ON g.CodeGroup = lower(t.GroupCodeName) AND g.TaskCode = lower(t.TaskCodeName)
"""
STAR_SQL = f"""
SELECT f.NotificationCode AS Notification, f.ItemNumber AS Item, f.LayoutTaskId, f.TaskId AS Task,
       f.MaterialCode AS Material, f.CreatedOn AS Created_On, f.CompletedOn AS Completed_On,
       f.TaskText, f.TaskCodeId, f.PlannedStart AS Planned_Start, f.PlannedFinish AS Planned_Finish,
       f.SupplierVendorId, f.TaskOwnerId, f.TaskStatusId, f.DamageCodeId, f.CauseCodeId,
       f.CodeGroupId AS GroupCodeId, f.CategoryId, e.CodingCodeId AS Coding, e.Description AS Engine,
       s.SupplierVendorCode AS SupplierVendor, o.TaskOwnerCode AS TaskOwner,
       st.TaskStatusCode AS TaskStatus, g.CodeGroupName AS GroupCode, ca.CauseCode,
       d.DamageCodeName AS DamageCode, c.CategoryName AS Category, t.TaskCode, t.TaskCodeText,
       t.GeneralCode
FROM ({REC['LayoutProcessingTask']}) f
LEFT JOIN ({REC['EngineProgram']}) e ON e.NotificationCode = f.NotificationCode
LEFT JOIN ({REC['SupplierVendor']}) s ON s.SupplierVendorId = f.SupplierVendorId
LEFT JOIN ({REC['TaskOwner']}) o ON o.TaskOwnerId = f.TaskOwnerId
LEFT JOIN ({REC['TaskStatus']}) st ON st.TaskStatusId = f.TaskStatusId
LEFT JOIN ({REC['GroupCode']}) g ON g.CodeGroupId = f.CodeGroupId
LEFT JOIN ({REC['CauseCode']}) ca ON ca.CauseCodeId = f.CauseCodeId
LEFT JOIN ({REC['DamageCode']}) d ON d.DamageCodeId = f.DamageCodeId
LEFT JOIN ({REC['Category']}) c ON c.CategoryId = f.CategoryId
LEFT JOIN ({CODES_SQL}) t ON t.TaskCodeId = f.TaskCodeId
"""
TYPED_SQL = f"""
SELECT * REPLACE (CAST(Created_On AS DATE) AS Created_On,
                  CASE WHEN Completed_On > '1677-09-21' THEN CAST(Completed_On AS DATE) END AS Completed_On,
                  CAST(Planned_Start AS DATE) AS Planned_Start,
                  CAST(Planned_Finish AS DATE) AS Planned_Finish, lower(Engine) AS Engine)
FROM star
"""
# Tags and the deciding rule, for any table with the task columns.
TAGS_SQL = """
SELECT *, bool_and(Completed_On IS NOT NULL) OVER (PARTITION BY Notification, Item) AS IsItemCompleted,
       Completed_On IS NOT NULL AS IsTaskCompleted,
       CAST(lower(TaskCodeText) LIKE '%ring%' OR lower(TaskText) LIKE '%ring%' AS INT) AS IsTurnback,
       CAST(lower(TaskText) LIKE '%medium%' AS INT) AS IsLife,
       TaskCode = 'ECONOMY' OR (GroupCode = 'R' AND TaskCode IN ('SMALL', 'LARGE')) AS IsPlanning
FROM {source}
"""
BRANCH_SQL = """
SELECT *, CASE WHEN lower(TaskCodeText) LIKE '%gizmo%' OR lower(TaskText) LIKE '%promo 1-urgent%' THEN 1
               WHEN lower(TaskCodeText) LIKE '%old%' OR lower(TaskText) LIKE '%not specified%'
                    OR Planned_Start > DATE '2100-01-01' OR Planned_Finish > DATE '2100-01-01' THEN 2
               WHEN Created_On > Completed_On THEN 3 ELSE 0 END AS branch
FROM {source}
"""
FIXED_SQL = """
SELECT * EXCLUDE (branch) REPLACE (
         CASE WHEN branch = 3 THEN Completed_On ELSE Created_On END AS Created_On,
         CASE WHEN branch = 2 THEN Created_On ELSE Completed_On END AS Completed_On),
       CASE WHEN branch = 1 THEN 0 ELSE 1 END AS Available
FROM {source}
"""
DATES_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in DATES)


@query("general_code", CODES_SQL)
def general_code(spark, sf_dir):
    found = sources(spark, sf_dir)
    return cleaning.with_general_code(found["TaskCode"], found["GeneralCode"])


def sources(spark, sf_dir):
    return load_sources(tables.records(spark, sf_dir))


@query("star_join", STAR_SQL)
def star_join(spark, sf_dir):
    found = sources(spark, sf_dir)
    codes = cleaning.with_general_code(found["TaskCode"], found["GeneralCode"])
    return cleaning.star_join({**found, "TaskCode": codes}, staged=True)


@query(
    "item_completed",
    f"{WO} SELECT Id, Notification, Item, bool_and(Completed_On IS NOT NULL)"
    " OVER (PARTITION BY Notification, Item) AS IsItemCompleted FROM work_orders",
)
def item_completed(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir).select("Id", "Notification", "Item", "Completed_On")
    return cleaning.with_item_completed(rows).drop("Completed_On")


TAG_NAMES = "Id, IsItemCompleted, IsTaskCompleted, IsTurnback, IsLife, IsPlanning"


@query("clean_tags", f"{WO} SELECT {TAG_NAMES} FROM ({TAGS_SQL.format(source='work_orders')})")
def clean_tags(spark, sf_dir):
    return cleaning.with_tags(tables.work_orders(spark, sf_dir), RULES).select(*TAG_NAMES.split(", "))


@query("planning_flag", f"{WO} SELECT Id, IsPlanning FROM ({TAGS_SQL.format(source='work_orders')})")
def planning_flag(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir).select("Id", "TaskCode", "GroupCode")
    return cleaning.with_planning_flag(rows, RULES).select("Id", "IsPlanning")


CASCADE_SQL = f"""{WO}, b AS ({BRANCH_SQL.format(source='work_orders')}),
fixed AS ({FIXED_SQL.format(source='b')})
SELECT Id, Notification, Item, Task, Available, CAST(Created_On AS VARCHAR) AS Created_On,
       CAST(Completed_On AS VARCHAR) AS Completed_On FROM fixed"""


@query("clean_cascade", CASCADE_SQL)
def clean_cascade(spark, sf_dir):
    """Corrected dates and availability of every task."""
    rows = tables.work_orders(spark, sf_dir)
    rows = rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in DATES})
    fixed = cleaning.with_corrections(rows, RULES)
    names = ("Id", "Notification", "Item", "Task", "Available", "Created_On", "Completed_On")
    return dates_as_text(fixed.select(*names), "Created_On", "Completed_On")


def _cleaned_sql() -> str:
    names = ", ".join(
        (f"CAST({c} AS VARCHAR) AS {n}" if c in DATES else f"{c} AS {n}")
        for c, n in CLEANED_FIELDS.items()
    )
    return f"""WITH star AS ({STAR_SQL}), typed AS ({TYPED_SQL}),
tagged AS ({TAGS_SQL.format(source='typed')}), b AS ({BRANCH_SQL.format(source='tagged')}),
fixed AS ({FIXED_SQL.format(source='b')}) SELECT {names} FROM fixed"""


@query("clean_output", _cleaned_sql())
def clean_output(spark, sf_dir):
    """The whole cleaning job, from record sets to the 36 result columns."""
    return cleaning.cleaned_output(cleaning.clean(sources(spark, sf_dir), RULES))


@query("job_clean_data", _cleaned_sql())
def job_clean_data(spark, sf_dir):
    """The cleaning job through files: record sets in, the rows of the stored run out."""
    path = scratch_path(spark, "cleaned")
    jobs.clean_data(tables.records(spark, sf_dir), path, "first", RULES)
    return spark.read.parquet(path).where("run_date = 'first'").drop("run_date")


# --- features -------------------------------------------------------------------------------

PREPARED_SQL = f"""{MT},
dated AS (SELECT * REPLACE (CAST(Created_On AS DATE) AS Created_On, CAST(Completed_On AS DATE) AS Completed_On)
          FROM model_tasks),
started AS (SELECT *, min(Created_On) OVER (PARTITION BY Notification, Item) AS Item_Created_On,
                   count(*) OVER (PARTITION BY lower(coalesce(TaskOwner, 'NA'))) AS owned FROM dated),
prepared AS (
SELECT Id, CAST(Notification AS VARCHAR) AS Notification, Item, Task,
       CAST(Created_On AS VARCHAR) AS Task_Created_On, CAST(Completed_On AS VARCHAR) AS Completed_On,
       CAST(Item_Created_On AS VARCHAR) AS Item_Created_On,
       Created_On - Item_Created_On + 1 AS DaysFromItemStart,
       year(Created_On) AS TaskCreatedYear,
       CAST(month(Created_On) AS VARCHAR) AS TaskCreatedMonth,
       CAST(quarter(Created_On) AS VARCHAR) AS TaskCreatedQuarter,
       round(cos(2 * pi() * month(Created_On) / 12), 9) + 0.0 AS Seasonality,
       CASE WHEN lower(coalesce(TaskOwner, 'NA')) LIKE '%na%' THEN 0 ELSE owned END AS TaskOwnerExperience,
       round((Created_On - Item_Created_On + 1) / CAST(Task AS DOUBLE), 9) AS DaysPerTask,
       CASE WHEN Engine IN ('machinery', 'automobile') THEN Engine ELSE 'other' END AS Engine,
       CASE WHEN lower(CauseCode) IN ('l00', 'l01') THEN lower(CauseCode) ELSE 'other' END AS CauseCode,
       CASE WHEN DamageCode IN ('10', '20', '30') THEN DamageCode ELSE 'other' END AS DamageCode,
       CASE WHEN SupplierVendor IN ('1', '2', '3') THEN SupplierVendor ELSE 'other' END AS SupplierVendor,
       lower(Category) AS Category, lower(Coding) AS Coding, lower(GeneralCode) AS GeneralCode,
       lower(TaskText) AS TaskText, lower(TaskStatus) AS TaskStatus, Material,
       TaskCodeText LIKE '%bolt%' AS IsExpiry, TaskCodeText LIKE '%rod%' AS IsPCE,
       TaskCodeText LIKE '%plate%' AS IsEval, TaskCodeText LIKE '%hot%' AS IsReceive,
       IsTurnback = 1 AS IsTurnback, coalesce(IsLife = 1, true) AS IsLife,
       IsPlanning, IsTaskCompleted, IsItemCompleted
FROM started)
"""
PREPARED_NAMES = (
    "Id", "Notification", "Item", "Task", "Task_Created_On", "Completed_On", "Item_Created_On",
    "DaysFromItemStart", "TaskCreatedYear", "TaskCreatedMonth", "TaskCreatedQuarter", "Seasonality",
    "TaskOwnerExperience", "DaysPerTask", "Engine", "CauseCode", "DamageCode", "SupplierVendor",
    "Category", "Coding", "GeneralCode", "TaskText", "TaskStatus", "Material", "IsExpiry", "IsPCE",
    "IsEval", "IsReceive", "IsTurnback", "IsLife", "IsPlanning", "IsTaskCompleted", "IsItemCompleted",
)


def prepared(spark, sf_dir) -> DataFrame:
    return features.features(tables.stored_model_tasks(spark, sf_dir), TEXT_FLAGS, KEPT)


def comparable(df: DataFrame) -> DataFrame:
    """Dates as text and doubles rounded, as the oracle gives them."""
    df = dates_as_text(df, *[c for c in ("Task_Created_On", "Completed_On", "Item_Created_On") if c in df.columns])
    rounded = {c: F.round(c, 9) for c in ("Seasonality", "DaysPerTask") if c in df.columns}
    return df.withColumns(rounded)


@query(
    "item_created_on",
    f"{WO} SELECT Notification, Item, CAST(min(Created_On) AS VARCHAR) AS Item_Created_On"
    " FROM work_orders GROUP BY Notification, Item",
)
def item_created_on(spark, sf_dir):
    return dates_as_text(features.item_created_on(tables.work_orders(spark, sf_dir)), "Item_Created_On")


@query(
    "item_start",
    f"{PREPARED_SQL} SELECT Id, Task_Created_On, Item_Created_On, DaysFromItemStart FROM prepared",
)
def item_start(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir).select("Id", "Notification", "Item", "Created_On")
    started = features.with_item_start(rows).drop("Notification", "Item")
    return dates_as_text(started, "Task_Created_On", "Item_Created_On")


@query("text_flags", f"{PREPARED_SQL} SELECT Id, IsExpiry, IsPCE, IsEval, IsReceive FROM prepared")
def text_flags(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir).select("Id", "TaskCodeText")
    return features.with_text_flags(rows, TEXT_FLAGS)


@query("owner_experience", f"{PREPARED_SQL} SELECT Id, TaskOwnerExperience FROM prepared")
def owner_experience(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir).select("Id", "TaskOwner")
    marked = rows.withColumn("TaskOwner", F.lower(texts.int_or_na(rows, "TaskOwner")))
    return features.with_owner_experience(marked)


@query(
    "days_per_task",
    "SELECT l_orderkey, l_linenumber, round(l_quantity / nullif(l_tax, 0), 6) AS share FROM lineitem",
)
def days_per_task(spark, sf_dir):
    tables.given(spark, sf_dir, "lineitem")
    share = F.round(features.days_per_task(F.col("l_quantity"), F.col("l_tax")), 6).alias("share")
    return spark.table("lineitem").select("l_orderkey", "l_linenumber", share)


@query(
    "seasonality",
    f"{WO} SELECT Id, round(cos(2 * pi() * month(Created_On) / 12), 9) + 0.0 AS Seasonality FROM work_orders",
)
def seasonality(spark, sf_dir):
    month = features.seasonality(F.month("Created_On"))
    return tables.work_orders(spark, sf_dir).select("Id", F.round(month, 9).alias("Seasonality"))


@query("task_duration", f"{WO} SELECT Id, Completed_On - Created_On AS TaskDuration FROM work_orders")
def task_duration(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir)
    rows = rows.select("Id", F.col("Created_On").alias("Task_Created_On"), "Completed_On")
    return features.task_duration(rows).select("Id", "TaskDuration")


@query("features_full", f"{PREPARED_SQL} SELECT {', '.join(PREPARED_NAMES)} FROM prepared")
def features_full(spark, sf_dir):
    return comparable(prepared(spark, sf_dir)).select(*PREPARED_NAMES)


@query(
    "impute_median",
    f"""{WO}, gaps AS (SELECT Id, Completed_On - Created_On AS days, CASE WHEN Task > 5 THEN Task END AS task
FROM work_orders)
SELECT Id, CAST(coalesce(days, (SELECT median(days) FROM gaps)) AS DOUBLE) AS days,
       CAST(coalesce(task, (SELECT median(task) FROM gaps)) AS DOUBLE) AS task FROM gaps""",
)
def impute_median(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir).select(
        "Id",
        dates.whole_days(F.col("Created_On"), F.col("Completed_On")).alias("days"),
        F.when(F.col("Task") > 5, F.col("Task")).alias("task"),
    )
    rows = store_and_reload(rows, "gaps")  # read once for each step of the medians and once to be filled
    return impute.fill_numbers(rows, impute.medians(rows, ["days", "task"]))


TIES_SQL = """
SELECT 7 AS same, CASE WHEN l_linestatus = 'F' THEN 1 END AS one, CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS flag,
       CASE WHEN l_linenumber < 7 THEN 5.0 ELSE l_extendedprice END AS tied, l_extendedprice AS price,
       CASE WHEN l_quantity > 60 THEN 1 END AS nothing, l_discount - 0.05 AS signed
FROM lineitem
"""
TIED = ("same", "one", "flag", "tied", "price", "nothing", "signed")


@query(
    "median_ties",
    f"SELECT {', '.join(f'CAST(median(CAST({c} AS DOUBLE)) AS DOUBLE) AS {c}' for c in TIED)} FROM ({TIES_SQL})",
)
def median_ties(spark, sf_dir):
    """Medians of a constant, a flag, a column of ties, plain ones and an empty one."""
    tables.given(spark, sf_dir, "lineitem")
    found = impute.medians(spark.sql(TIES_SQL), TIED)
    return spark.createDataFrame([tuple(found.get(c) for c in TIED)], ", ".join(f"{c} double" for c in TIED))


PRICE_RANKS = (0, 1, 999, 5000)


@query(
    "order_values",
    f"""WITH p AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) - 1 AS place FROM lineitem),
k AS (SELECT p_name AS v, row_number() OVER (ORDER BY p_name) - 1 AS place FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT p.place, p.v AS price, k.v AS name FROM p JOIN k USING (place) WHERE p.place IN {PRICE_RANKS}""",
)
def order_values(spark, sf_dir):
    """Values at given places of the sorted lines, of a number and of a text with many ties."""
    tables.given(spark, sf_dir, "lineitem", "part")
    lines = spark.sql("SELECT l_extendedprice AS price, p_name AS name FROM lineitem JOIN part ON p_partkey = l_partkey")
    price = impute.order_values(lines, {"price": PRICE_RANKS})["price"]
    name = impute.order_values(lines, {"name": PRICE_RANKS})["name"]
    return spark.createDataFrame(list(zip(PRICE_RANKS, price, name)), "place long, price double, name string")


@query(
    "one_hot_vectors",
    f"""{WO}, rows AS (SELECT Id, Material, TaskOwner FROM work_orders),
m AS (SELECT Material, row_number() OVER (ORDER BY Material) - 1 AS at FROM (SELECT DISTINCT Material FROM rows WHERE Material IS NOT NULL)),
o AS (SELECT TaskOwner, (SELECT count(*) FROM m) + row_number() OVER (ORDER BY TaskOwner) - 1 AS at
      FROM (SELECT DISTINCT TaskOwner FROM rows WHERE TaskOwner IS NOT NULL))
SELECT Id, (SELECT count(*) FROM m) + (SELECT count(*) FROM o) AS levels,
       concat_ws(',', CAST(m.at AS VARCHAR), CAST(o.at AS VARCHAR)) AS places,
       concat_ws(',', 'Material_' || m.Material, 'TaskOwner_' || o.TaskOwner) AS names
FROM rows LEFT JOIN m USING (Material) LEFT JOIN o USING (TaskOwner)""",
)
def one_hot_vectors(spark, sf_dir):
    """Every task's material and owner as a sparse vector over all levels, read back with the level names."""
    rows = store_and_reload(tables.work_orders(spark, sf_dir).select("Id", "Material", "TaskOwner"), "levels")
    found = impute.one_hot_vectors(rows, impute.learn_vectors(rows, ["Material", "TaskOwner"]))
    level = impute.vector_levels(found)
    parts = found.select("Id", F.unwrap_udt("features").alias("v"))
    parts = parts.select("Id", F.col("v.size").cast("long").alias("levels"), F.col("v.indices").alias("at"))
    spelt = parts.select("Id", F.explode("at").alias("at")).join(level, "at").groupBy("Id")
    spelt = spelt.agg(F.array_sort(F.collect_list(F.struct("at", "level"))).alias("named"))
    return parts.join(spelt, "Id", "left").select(
        "Id", "levels", F.concat_ws(",", F.col("at").cast("array<string>")).alias("places"),
        F.coalesce(F.concat_ws(",", F.col("named.level")), F.lit("")).alias("names"),
    )


@query(
    "impute_mode",
    f"""{WO}, top AS (SELECT
  (SELECT TaskOwner FROM work_orders WHERE TaskOwner IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS o,
  (SELECT CauseCode FROM work_orders WHERE CauseCode IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS c)
SELECT Id, coalesce(TaskOwner, o) AS TaskOwner, coalesce(CauseCode, c) AS CauseCode FROM work_orders, top""",
)
def impute_mode(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir).select("Id", "TaskOwner", "CauseCode")
    return impute.fill_texts(rows, impute.modes(rows, ["TaskOwner", "CauseCode"]))


def _hot(column: str, *values: str) -> str:
    return ", ".join(
        f'CASE WHEN {column} = \'{v}\' THEN 1 ELSE 0 END AS "{column}_{v}"' for v in values
    )


@query(
    "one_hot",
    f"{WO} SELECT Id, {_hot('Category', 'ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')},"
    f" {_hot('CauseCode', 'L00', 'L01', 'L02', 'L03', 'L04')} FROM work_orders",
)
def one_hot(spark, sf_dir):
    rows = tables.work_orders(spark, sf_dir).select("Id", "Category", "CauseCode")
    return impute.one_hot(rows, impute.learn_levels(rows, ["Category", "CauseCode"]))


def _matrix_sql() -> str:
    parts = []
    for name in SELECTED:
        column, _, value = name.partition("_")
        if not value:
            parts.append(f"CAST({name} AS DOUBLE) AS {name}")
        else:
            parts.append(f"CASE WHEN CAST({column} AS VARCHAR) = '{value.lower()}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{name}\"")
    return f"{PREPARED_SQL} SELECT Id, {', '.join(parts)} FROM prepared"


@query("feature_matrix", _matrix_sql())
def feature_matrix(spark, sf_dir):
    """The selected features of all tasks in their fixed order."""
    rows = comparable(prepared(spark, sf_dir))
    rows = store_and_reload(rows.select("Id", *features.source_columns(rows.drop("Id"), SELECTED)), "prepared")
    fills = impute.medians(rows, features.number_features(rows, SELECTED))
    return features.feature_matrix(rows, fills, SELECTED, keep=["Id"])


# --- models ---------------------------------------------------------------------------------

TRAINING_SQL = f"""{PREPARED_SQL}, training AS (
SELECT *, CAST(Completed_On AS DATE) - CAST(Task_Created_On AS DATE) AS TaskDuration FROM prepared
WHERE IsItemCompleted AND NOT IsPlanning AND year(CAST(Task_Created_On AS DATE)) >= {tables.FIRST_YEAR})
"""


def training(spark, sf_dir) -> DataFrame:
    return models.training_rows(prepared(spark, sf_dir), tables.FIRST_YEAR)


@query("training_rows", f"{TRAINING_SQL} SELECT {', '.join(PREPARED_NAMES)}, TaskDuration FROM training")
def training_rows(spark, sf_dir):
    return comparable(training(spark, sf_dir)).select(*PREPARED_NAMES, "TaskDuration")


@query(
    "duration_label",
    f"{TRAINING_SQL} SELECT Id, TaskDuration, CASE WHEN TaskDuration <= 30 THEN 0 ELSE 1 END AS label FROM training",
)
def duration_label(spark, sf_dir):
    return models.duration_label(training(spark, sf_dir)).select("Id", "TaskDuration", "label")


@query(
    "inference_rows",
    f"{PREPARED_SQL} SELECT {', '.join(PREPARED_NAMES)} FROM prepared"
    " WHERE NOT IsItemCompleted AND NOT IsTaskCompleted",
)
def inference_rows(spark, sf_dir):
    return comparable(models.inference_rows(prepared(spark, sf_dir))).select(*PREPARED_NAMES)


@query("drop_outliers")
def drop_outliers(spark, sf_dir):
    """Inliers. The rows are counted, sampled and scored, so they are stored first."""
    rows = training(spark, sf_dir).select("Id", "Item", "Task", "TaskDuration", "DaysFromItemStart")
    return drop(store_and_reload(rows, "training"))


@query("train_classifier")
def train_classifier(spark, sf_dir):
    """Tasks by label and by the class the trained classifier gives them."""
    rules = tables.model_rules()
    matrix, _ = models.training_matrix(tables.stored_model_tasks(spark, sf_dir), rules)
    found = models.train_classifier(matrix, rules).transform(matrix)
    return found.groupBy("label", "prediction").agg(F.count("*").alias("tasks"))


@query("train_regressor")
def train_regressor(spark, sf_dir):
    """Duration the trained regressor gives the short tasks, by true duration."""
    rules = tables.model_rules()
    matrix, _ = models.training_matrix(tables.stored_model_tasks(spark, sf_dir), rules)
    classifier = models.train_classifier(matrix, rules)
    regressor = models.train_regressor(matrix, classifier, rules)
    found = regressor.transform(matrix.where(F.col("label") == 0))
    return found.groupBy("TaskDuration").agg(
        F.count("*").alias("tasks"), F.round(F.avg("prediction"), 3).alias("predicted")
    )


@query("predict_duration")
def predict_duration(spark, sf_dir):
    rules = tables.model_rules()
    tasks = tables.stored_model_tasks(spark, sf_dir)
    return models.predict(tasks, models.train(tasks, rules), rules)


# --- sequences ------------------------------------------------------------------------------

ORDER = ("Placed", "Id")


def _pairs_sql(tasks: str, order: str) -> str:
    """Sequences of ``tasks`` as ``seqs`` and their pairs as ``pairs``."""
    return f"""
seqs AS (SELECT Notification, CAST(Item AS VARCHAR) AS Item, min_by(LayoutId, ({order})) AS LayoutId,
                list(TaskCode ORDER BY {order}) AS Seq
         FROM {tasks} GROUP BY Notification, Item),
pairs AS (SELECT s.Notification, s.LayoutId AS db_layout_id_ref, s.Item AS layout_ref,
                 m.LayoutId AS db_layout_id_test, m.Item AS layout_test, s.Seq AS Seq1, m.Seq AS Seq2
          FROM seqs s JOIN (SELECT Notification, max(Item) AS Item FROM seqs GROUP BY 1) l
            ON l.Notification = s.Notification AND s.Item <> l.Item
          JOIN seqs m ON m.Notification = l.Notification AND m.Item = l.Item)
"""


SEQ = f"{tables.with_clauses('sequence_tasks')}, {_pairs_sql('sequence_tasks', 'Placed, Id')}"
WO_SEQ = (
    f"{WO}, laid AS (SELECT *, Item AS LayoutId FROM work_orders), {_pairs_sql('laid', 'Task, Id')}"
)
ALIGNED = (
    "Notification, layout_ref, layout_test, array_to_string(align1, ' ') AS align1,"
    " array_to_string(align2, ' ') AS align2"
)
SIMILAR = (
    "SELECT Notification, db_layout_id_ref, layout_ref, db_layout_id_test, layout_test,"
    " array_to_string(Seq1, ' ') AS Seq1, array_to_string(Seq2, ' ') AS Seq2,"
    " array_to_string(align1, ' ') AS Align_Seq1, array_to_string(align2, ' ') AS Align_Seq2,"
    " score AS Score FROM aligned"
)


def arrays_as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.concat_ws(" ", c) for c in names})


CODED_SQL = (
    "SELECT event_id AS Id, user_id AS Notification, ascii(event_type) * 100 + length(event_type)"
    " AS TaskCodeId FROM events"
)
CODE_NAMES_SQL = (
    "SELECT DISTINCT ascii(event_type) * 100 + length(event_type) AS TaskCodeId,"
    " upper(event_type) AS TaskCodeName FROM events WHERE event_type <> 'error'"
)


@query(
    "sequence_code_names",
    f"SELECT e.*, coalesce(c.TaskCodeName, 'nan') AS TaskCode FROM ({CODED_SQL}) e"
    f" LEFT JOIN ({CODE_NAMES_SQL}) c USING (TaskCodeId)",
)
def sequence_code_names(spark, sf_dir):
    tables.given(spark, sf_dir, "events")
    return sequences.with_code_names(spark.sql(CODED_SQL), spark.sql(CODE_NAMES_SQL))


@query(
    "item_sequences",
    f"{SEQ} SELECT Notification, Item, LayoutId, array_to_string(Seq, ' ') AS Seq FROM seqs",
)
def item_sequences(spark, sf_dir):
    found = sequences.item_sequences(tables.sequence_tasks(spark, sf_dir), ORDER)
    return arrays_as_text(found, "Seq")


@query(
    "sequence_pairs",
    f"{SEQ} SELECT Notification, db_layout_id_ref, layout_ref, db_layout_id_test, layout_test,"
    " array_to_string(Seq1, ' ') AS Seq1, array_to_string(Seq2, ' ') AS Seq2 FROM pairs",
)
def sequence_pairs(spark, sf_dir):
    return arrays_as_text(pairs(spark, sf_dir), "Seq1", "Seq2")


def pairs(spark, sf_dir) -> DataFrame:
    found = sequences.item_sequences(tables.sequence_tasks(spark, sf_dir), ORDER)
    return sequences.sequence_pairs(found)


def _aligned(df: DataFrame, align) -> DataFrame:
    return sequences.with_alignment(df, align).drop("Seq1", "Seq2")


KEYS = ("Notification", "layout_ref", "layout_test")


@query("align_global", f"{SEQ}, {aligned('pairs', 'global')} SELECT {ALIGNED} FROM aligned")
def align_global_(spark, sf_dir):
    found = _aligned(pairs(spark, sf_dir), align_global)
    return arrays_as_text(found.select(*KEYS, "align1", "align2"), "align1", "align2")


@query("align_local", f"{SEQ}, {aligned('pairs', 'local')} SELECT {ALIGNED}, score FROM aligned")
def align_local_(spark, sf_dir):
    found = _aligned(pairs(spark, sf_dir), align_local).withColumn("score", F.round("score", 9))
    return arrays_as_text(found.select(*KEYS, "align1", "align2", "score"), "align1", "align2")


@query("align_hybrid", f"{SEQ}, {aligned('pairs', 'hybrid')} SELECT {ALIGNED}, score FROM aligned")
def align_hybrid_(spark, sf_dir):
    found = _aligned(pairs(spark, sf_dir), align_hybrid).withColumn("score", F.round("score", 9))
    return arrays_as_text(found.select(*KEYS, "align1", "align2", "score"), "align1", "align2")


ARRAYS = ("Seq1", "Seq2", "Align_Seq1", "Align_Seq2")


@query("similarity_all", f"{SEQ}, {aligned('pairs', 'hybrid')} {SIMILAR}")
def similarity_all(spark, sf_dir):
    found = sequences.similarity(tables.sequence_tasks(spark, sf_dir), ORDER)
    return arrays_as_text(found.withColumn("Score", F.round("Score", 9)), *ARRAYS)


@query("similarity_by_ref", f"{SEQ}, {aligned('pairs', 'hybrid')} {SIMILAR} WHERE Notification = 3")
def similarity_by_ref(spark, sf_dir):
    found = sequences.similarity_by_ref(tables.sequence_tasks(spark, sf_dir), ORDER, 3)
    return arrays_as_text(found.withColumn("Score", F.round("Score", 9)), *ARRAYS)


@query("similarity_workorders", f"{WO_SEQ}, {aligned('pairs', 'hybrid')} {SIMILAR}")
def similarity_workorders(spark, sf_dir):
    """Many short sequences: the task codes of the work orders."""
    rows = tables.work_orders(spark, sf_dir).withColumn("LayoutId", F.col("Item"))
    found = sequences.similarity(rows, ("Task", "Id"))
    return arrays_as_text(found.withColumn("Score", F.round("Score", 9)), *ARRAYS)


NAMED_SEQ = f"""{tables.with_clauses('sequence_tasks')}, named AS (
    SELECT s.* REPLACE (coalesce(c.TaskCodeName, 'nan') AS TaskCode) FROM sequence_tasks s
    LEFT JOIN ({CODE_NAMES_SQL}) c ON c.TaskCodeId = ascii(s.TaskCode) * 100 + length(s.TaskCode)),
{_pairs_sql('named', 'Placed, Id')}"""
SIMILARITY_FILE = ", ".join(f"{c} AS {SIMILARITY_FIELDS.get(c, c)}" for c in sequences.RESULT)


@query("job_similarities", f"{NAMED_SEQ}, {aligned('pairs', 'hybrid')} SELECT {SIMILARITY_FILE} FROM ({SIMILAR})")
def job_similarities(spark, sf_dir):
    """The similarity job through files, from code ids: the rows of the stored run."""
    tasks = tables.sequence_tasks(spark, sf_dir)
    tasks = tasks.withColumn("TaskCodeId", F.expr("ascii(TaskCode) * 100 + length(TaskCode)")).drop("TaskCode")
    path = scratch_path(spark, "similarities")
    jobs.all_similarities(tasks, ORDER, path, "first", spark.sql(CODE_NAMES_SQL))
    found = spark.read.parquet(path).where("run_date = 'first'").drop("run_date")
    texts = [SIMILARITY_FIELDS.get(c, c) for c in ARRAYS]
    return arrays_as_text(found.withColumn("Score", F.round("Score", 9)), *texts)
