"""The given tables in the shape of work orders.

One SQL text serves Spark and the oracle. A customer is a notification, a line number an item, and
every line a task of it whose number is the quantity. No window numbers the tasks: a customer may
hold a third of all lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from taskspark.operators.cleaning import CleaningRules
from taskspark.plans.models import ModelRules
from taskspark.session import shuffles_dropped, store_and_reload
from taskspark.sources import cells

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

# Names used by every query below; the words occur in the given tables.
RULES = CleaningRules(
    turnback_words=("ring",),
    life_words=("medium",),
    drop_code_words=("gizmo",),
    drop_text_words=("promo 1-urgent",),
    close_code_words=("old",),
    close_text_words=("not specified",),
    far_future="2100-01-01",
    planning_codes=("economy",),
    planning_group="r",
    planning_group_codes=("small", "large"),
)
TEXT_FLAGS = {"IsExpiry": "bolt", "IsPCE": "rod", "IsEval": "plate", "IsReceive": "hot"}
KEPT = {
    "Engine": ("machinery", "automobile"),
    "CauseCode": ("l00", "l01"),
    "DamageCode": ("10", "20", "30"),
    "SupplierVendor": ("1", "2", "3"),
}
FIRST_YEAR = 1998
SELECTED = (
    "Item", "TaskOwnerExperience", "DaysFromItemStart", "DaysPerTask", "Task",
    "SupplierVendor_1", "Seasonality", "DamageCode_30", "CauseCode_l00", "TaskCreatedMonth_7",
    "TaskCreatedMonth_2", "GeneralCode_r_promo", "Category_small", "SupplierVendor_2",
    "CauseCode_other", "Category_large", "DamageCode_10", "TaskCreatedQuarter_3", "IsEval_False",
    "Engine_machinery", "Category_housing", "TaskCreatedYear",
)

WORK_ORDERS = """
SELECT concat_ws('-', CAST(l.l_orderkey AS STRING), CAST(l.l_linenumber AS STRING),
                 CAST(l.l_partkey AS STRING), CAST(l.l_suppkey AS STRING),
                 CAST(CAST(l.l_quantity AS INT) AS STRING))         AS Id,
       o.o_custkey                                                  AS Notification,
       CAST(l.l_linenumber AS BIGINT)                               AS Item,
       CAST(l.l_quantity AS BIGINT)                                 AS Task,
       CAST(l.l_partkey AS STRING)                                  AS Material,
       CAST(o.o_orderdate AS DATE) + CAST(round(l.l_discount * 100) AS INT) * 5 AS Created_On,
       CASE WHEN l.l_linestatus = 'F' OR l.l_returnflag <> 'N'
            THEN CAST(l.l_shipdate AS DATE) END                     AS Completed_On,
       CAST(o.o_orderdate AS DATE) + CAST(round(l.l_tax * 100) AS INT)          AS Planned_Start,
       CASE WHEN l.l_quantity >= 49 THEN DATE '2262-04-11'
            ELSE CAST(o.o_orderdate AS DATE) + CAST(l.l_quantity AS INT) END    AS Planned_Finish,
       concat(p.p_type, ' ', o.o_orderpriority)                     AS TaskText,
       p.p_name                                                     AS TaskCodeText,
       upper(p.p_type)                                              AS TaskCode,
       l.l_returnflag                                               AS GroupCode,
       concat('Group ', l.l_returnflag)                             AS GroupText,
       CAST(l.l_suppkey AS STRING)                                  AS SupplierVendor,
       CASE WHEN c.c_acctbal < 0 THEN NULL ELSE n.n_name END        AS TaskOwner,
       o.o_orderstatus                                              AS TaskStatus,
       CAST(l.l_linenumber * 10 AS STRING)                          AS DamageCode,
       CASE WHEN l.l_tax = 0 THEN NULL
            ELSE concat('L0', CAST(CAST(round(l.l_tax * 100) AS INT) % 5 AS STRING)) END AS CauseCode,
       c.c_mktsegment                                               AS Engine,
       p.p_type                                                     AS Category,
       concat('Z0', CAST(n.n_regionkey AS STRING), '0')             AS Coding,
       p.p_brand                                                    AS Description
FROM lineitem l
JOIN orders o   ON o.o_orderkey  = l.l_orderkey
JOIN part p     ON p.p_partkey   = l.l_partkey
JOIN customer c ON c.c_custkey   = o.o_custkey
JOIN nation n   ON n.n_nationkey = c.c_nationkey
"""

# Raw sheets: headings as delivered, every cell text, some cells empty.
SHEETS = {
    "LayoutType": """
SELECT CAST(Notification AS STRING) AS Notification, CAST(Item AS STRING) AS `Sort number`,
       min(TaskText) AS Text, DamageCode AS `Damage Code`,
       CASE WHEN DamageCode <> '70' THEN concat('Damage ', DamageCode) END AS `Prob. code text`,
       min(CauseCode) AS `Cause code`, concat('Cause ', min(CauseCode)) AS `Cause code text`
FROM work_orders GROUP BY Notification, Item, DamageCode
""",
    "PWC_EngineProgram": """
SELECT CAST(c.c_custkey AS STRING) AS Notification,
       concat('Z0', CAST(r.r_regionkey AS STRING), '0') AS Coding,
       r.r_name AS `Coding code txt`, c.c_mktsegment AS Description
FROM customer c
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
""",
    "SAP_Raw_Extract": """
SELECT CAST(Notification AS STRING) AS Notification, CAST(Item AS STRING) AS Item,
       CAST(Task AS STRING) AS Task, Material, Description,
       concat(CAST(Created_On AS STRING), ' 00:00:00') AS `Created On`,
       concat(CAST(Completed_On AS STRING), ' 00:00:00') AS `Completed On`, TaskText AS `Task text`,
       GroupCode AS `Code group`, GroupText AS `Task group text`, upper(TaskCodeText) AS `Task code`,
       TaskCodeText AS `Task code text`,
       concat(CAST(Planned_Start AS STRING), ' 00:00:00') AS `Planned start`,
       CASE WHEN Planned_Finish = DATE '2262-04-11' THEN '31-12-9999'
            ELSE concat(CAST(Planned_Finish AS STRING), ' 00:00:00') END AS `Planned finish`,
       SupplierVendor AS `Supplier Vendor`, TaskOwner AS `Task Owner`,
       TaskStatus AS `Task Status`, Category AS CATEGORY
FROM work_orders
""",
    "Categories": "SELECT p_brand AS Description, p_type AS Category FROM part",
}

# The item sheet with a row for every line, so that rows repeat.
REPEATED_ITEMS = """
SELECT CAST(Notification AS STRING) AS Notification, CAST(Item AS STRING) AS `Sort number`,
       Category AS Text, DamageCode AS `Damage Code`,
       CASE WHEN DamageCode <> '70' THEN concat('Damage ', DamageCode) END AS `Prob. code text`,
       CauseCode AS `Cause code`, concat('Cause ', CauseCode) AS `Cause code text`
FROM work_orders
"""

# Date texts of every kind the loader meets.
DATE_TEXTS = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity = 50 THEN '31-12-9999' WHEN l_quantity = 49 THEN '1-1-7777'
            WHEN l_quantity = 48 THEN 'nan' WHEN l_quantity = 47 THEN '' WHEN l_quantity = 46 THEN 'junk'
            WHEN l_quantity = 45 THEN NULL WHEN l_quantity = 44 THEN '9999-12-31 00:00:00'
            WHEN l_quantity = 43 THEN '2019-02-30 00:00:00' WHEN l_quantity = 42 THEN '2019-03-04'
            ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 07:30:00' END AS stored,
       CASE WHEN l_quantity = 50 THEN '1677-09-21' WHEN l_quantity = 49 THEN '2262-04-11'
            WHEN l_quantity = 48 THEN '2500-01-02' WHEN l_quantity = 47 THEN '31-12-1999'
            WHEN l_quantity = 46 THEN '' WHEN l_quantity = 45 THEN NULL
            WHEN l_quantity > 30 THEN CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T10:00:00'
            WHEN l_quantity > 15 THEN replace(CAST(CAST(l_shipdate AS DATE) AS STRING), '-', '/')
            ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS sent
FROM lineitem
"""

# Record sets as the cleaning job reads them, with the services' field names.
RECORDS = {
    "GroupCode": """
SELECT DISTINCT CAST(ascii(l_returnflag) AS BIGINT) AS CodeGroupId, l_returnflag AS CodeGroupName,
       concat('Group ', l_returnflag) AS CodeGroupText FROM lineitem
""",
    "SupplierVendor": """
SELECT s_suppkey AS SupplierVendorId, CAST(s_suppkey AS STRING) AS SupplierVendorCode FROM supplier
""",
    "DamageCode": """
SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS DamageCodeId,
       CAST(l_linenumber * 10 AS STRING) AS DamageCodeName,
       concat('Damage ', CAST(l_linenumber * 10 AS STRING)) AS DamageCodeText FROM lineitem
""",
    "CauseCode": """
SELECT DISTINCT CAST(round(l_tax * 100) AS BIGINT) AS CauseCodeId,
       concat('L0', CAST(CAST(round(l_tax * 100) AS INT) % 5 AS STRING)) AS CauseCode,
       'cause' AS CauseText FROM lineitem WHERE l_tax > 0
""",
    "TaskOwner": """
SELECT CAST(n_nationkey AS BIGINT) AS TaskOwnerId, n_name AS TaskOwnerCode FROM nation
""",
    "TaskStatus": """
SELECT DISTINCT CAST(ascii(o_orderstatus) AS BIGINT) AS TaskStatusId,
       o_orderstatus AS TaskStatusCode FROM orders
""",
    "EngineProgram": """
SELECT c.c_custkey AS EngineProgramId, c.c_custkey AS NotificationCode,
       c.c_mktsegment AS Description, CAST(n.n_regionkey AS BIGINT) AS CodingCodeId
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE c.c_acctbal >= -500
""",
    "CodingCode": """
SELECT CAST(r_regionkey AS BIGINT) AS CodingCodeId,
       concat('Z0', CAST(r_regionkey AS STRING), '0') AS CodingCodeName,
       r_name AS CodingCodeText FROM region
""",
    "TaskCode": """
SELECT DISTINCT p.p_partkey * 100 + ascii(l.l_returnflag) AS TaskCodeId,
       upper(p.p_type) AS TaskCodeName, p.p_name AS TaskCodeText,
       CAST(ascii(l.l_returnflag) AS BIGINT) AS GroupCodeId, l.l_returnflag AS GroupCodeName
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
""",
    "LayoutProcessingTask": """
SELECT concat_ws('-', CAST(l.l_orderkey AS STRING), CAST(l.l_linenumber AS STRING),
                 CAST(l.l_partkey AS STRING), CAST(l.l_suppkey AS STRING),
                 CAST(CAST(l.l_quantity AS INT) AS STRING))         AS LayoutTaskId,
       CAST(l.l_quantity AS BIGINT) AS TaskId, CAST(l.l_linenumber AS BIGINT) AS ItemNumber,
       o.o_custkey AS NotificationCode, CAST(l.l_partkey AS STRING) AS MaterialCode,
       CAST(CAST(o.o_orderdate AS DATE) + CAST(round(l.l_discount * 100) AS INT) * 5 AS STRING)
                                                                    AS CreatedOn,
       CASE WHEN l.l_linestatus = 'F' OR l.l_returnflag <> 'N'
            THEN CAST(CAST(l.l_shipdate AS DATE) AS STRING)
            ELSE '1677-09-21' END                                   AS CompletedOn,
       concat(p.p_type, ' ', o.o_orderpriority)                     AS TaskText,
       p.p_partkey * 100 + ascii(l.l_returnflag)                    AS TaskCodeId,
       CAST(CAST(o.o_orderdate AS DATE) + CAST(round(l.l_tax * 100) AS INT) AS STRING)
                                                                    AS PlannedStart,
       CASE WHEN l.l_quantity >= 49 THEN '2262-04-11'
            ELSE CAST(CAST(o.o_orderdate AS DATE) + CAST(l.l_quantity AS INT) AS STRING) END
                                                                    AS PlannedFinish,
       l.l_suppkey AS SupplierVendorId,
       CASE WHEN c.c_acctbal >= 0 THEN CAST(c.c_nationkey AS BIGINT) END AS TaskOwnerId,
       CAST(ascii(o.o_orderstatus) AS BIGINT)                       AS TaskStatusId,
       CAST(ascii(p.p_type) * 100 + length(p.p_type) AS BIGINT)     AS CategoryId,
       CAST(l.l_linenumber AS BIGINT)                               AS DamageCodeId,
       CAST(round(l.l_tax * 100) AS BIGINT)                         AS CauseCodeId,
       CAST(ascii(l.l_returnflag) AS BIGINT)                        AS CodeGroupId
FROM lineitem l
JOIN orders o   ON o.o_orderkey = l.l_orderkey
JOIN part p     ON p.p_partkey  = l.l_partkey
JOIN customer c ON c.c_custkey  = o.o_custkey
""",
    "Material": """
SELECT CAST(p_partkey AS STRING) AS MaterialCode, p_name AS Description,
       CAST(ascii(p_type) * 100 + length(p_type) AS BIGINT) AS CategoryId FROM part
""",
    "LayoutType": """
SELECT DISTINCT o.o_custkey AS NotificationId, CAST(l.l_linenumber AS BIGINT) AS ItemNumber,
       p.p_type AS LayoutText, CAST(l.l_linenumber * 10 AS STRING) AS DamageCodeName,
       concat('L0', CAST(CAST(round(l.l_tax * 100) AS INT) % 5 AS STRING)) AS CauseCodeName
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN part p   ON p.p_partkey  = l.l_partkey
""",
    "GeneralCode": """
SELECT DISTINCT lower(l.l_returnflag) AS CodeGroup, lower(p.p_type) AS TaskCode,
       concat(lower(l.l_returnflag), '_', lower(p.p_type)) AS GeneralCode
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey WHERE p.p_type > 'M'
""",
    "Category": """
SELECT DISTINCT CAST(ascii(p_type) * 100 + length(p_type) AS BIGINT) AS CategoryId,
       p_type AS CategoryName FROM part
""",
}

# Cleaned tasks as the model job reads them: work orders with the tags and the general code.
MODEL_TASKS = """
SELECT w.Id, w.Notification, w.Item, w.Task, w.Material,
       CAST(w.Created_On AS STRING) AS Created_On, CAST(w.Completed_On AS STRING) AS Completed_On,
       CAST(w.Planned_Start AS STRING) AS Planned_Start,
       CAST(w.Planned_Finish AS STRING) AS Planned_Finish,
       w.TaskText, w.TaskCodeText, w.TaskStatus, w.TaskOwner, w.SupplierVendor, w.DamageCode,
       w.CauseCode, lower(w.Engine) AS Engine, w.Category, w.Coding,
       concat(lower(w.GroupCode), '_', lower(w.TaskCode)) AS GeneralCode,
       CASE WHEN w.TaskCodeText LIKE '%ring%' THEN 1 ELSE 0 END AS IsTurnback,
       CASE WHEN w.TaskText LIKE 'MEDIUM%' THEN 1 END AS IsLife,
       w.TaskCode = 'ECONOMY' AS IsPlanning,
       w.Completed_On IS NOT NULL AS IsTaskCompleted,
       i.done = 1 AS IsItemCompleted
FROM work_orders w
JOIN (SELECT Notification, Item,
             min(CASE WHEN Completed_On IS NOT NULL THEN 1 ELSE 0 END) AS done
      FROM work_orders GROUP BY Notification, Item) i
  ON i.Notification = w.Notification AND i.Item = w.Item
"""

# Event streams of users as task sequences: users with the same last digit form a notification.
SEQUENCE_TASKS = """
SELECT user_id % 10 AS Notification, CAST(user_id AS STRING) AS Item, ts AS Placed,
       event_id AS Id, event_type AS TaskCode, user_id AS LayoutId
FROM events
"""


_SCHEMAS: dict[str, T.StructType] = {}


def given(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Register the given tables as views. A file's schema is looked up once."""
    for name in names or GIVEN:
        path = f"{sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = spark.read.parquet(path).schema
        df = spark.read.schema(_SCHEMAS[path]).parquet(path)
        df.createOrReplaceTempView(name)
        if name == "lineitem":
            spread(df).createOrReplaceTempView("lines")


def on_lines(sql: str) -> str:
    """The same SQL with the line fact dealt out over the cores."""
    return sql.replace("FROM lineitem l\n", "FROM lines l\n")


#: The joins of the work orders, and the same ones in the order in which Spark moves least: the customers meet the
#: orders, a quarter of the lines, and the texts of the parts come last, so that no shuffle carries them.
JOINS = WORK_ORDERS[WORK_ORDERS.index("FROM lineitem l\n"):]
NARROW_JOINS = """FROM lineitem l
JOIN (orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey)
  ON o.o_orderkey = l.l_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
"""

#: The items of the work orders and whether all their tasks are completed. Parts only decide which lines count.
DONE_ITEMS = """
SELECT o.o_custkey AS Notification, CAST(l.l_linenumber AS BIGINT) AS Item,
       min(CASE WHEN CASE WHEN l.l_linestatus = 'F' OR l.l_returnflag <> 'N'
                          THEN CAST(l.l_shipdate AS DATE) END IS NOT NULL THEN 1 ELSE 0 END) AS done
""" + NARROW_JOINS.replace("JOIN part p", "LEFT SEMI JOIN part p") + "GROUP BY o.o_custkey, CAST(l.l_linenumber AS BIGINT)"

#: The work orders with the state of their item, which meets the lines before the texts of the parts do.
ITEM_ORDERS = WORK_ORDERS.replace(
    JOINS,
    ", i.done = 1 AS IsItemCompleted\n"
    + NARROW_JOINS.replace(
        "JOIN part p",
        f"JOIN ({DONE_ITEMS}) i ON i.Notification = o.o_custkey AND i.Item = CAST(l.l_linenumber AS BIGINT)\nJOIN part p",
    ),
)
#: The same rows as ``MODEL_TASKS``, which joins the state of the items to the whole work orders.
NARROW_MODEL_TASKS = (
    MODEL_TASKS[: MODEL_TASKS.index("JOIN (SELECT Notification")]
    .replace("FROM work_orders w", "FROM item_orders w")
    .replace("i.done = 1 AS IsItemCompleted", "w.IsItemCompleted")
)


#: The joins of the task records, and the same ones with the customers at the orders. Of the part only a short text
#: comes along, so it meets the lines first.
FACT = RECORDS["LayoutProcessingTask"]
FACT_JOINS = FACT[FACT.index("FROM lineitem l\n"):]
NARROW_FACT_JOINS = """FROM lineitem l
JOIN part p ON p.p_partkey = l.l_partkey
JOIN (orders o JOIN customer c ON c.c_custkey = o.o_custkey) ON o.o_orderkey = l.l_orderkey
"""

#: The same rows as the item records, folded before their texts are formed.
ITEM_RECORDS = """
SELECT NotificationId, CAST(number AS BIGINT) AS ItemNumber, LayoutText,
       CAST(number * 10 AS STRING) AS DamageCodeName, concat('L0', CAST(cause AS STRING)) AS CauseCodeName
FROM (SELECT DISTINCT o.o_custkey AS NotificationId, l.l_linenumber AS number, p.p_type AS LayoutText,
             CAST(round(l.l_tax * 100) AS INT) % 5 AS cause
      FROM lineitem l
      JOIN part p   ON p.p_partkey  = l.l_partkey
      JOIN orders o ON o.o_orderkey = l.l_orderkey)
"""

#: SQL of the record sets as Spark reads them, with less to move than in ``RECORDS``.
NARROW_RECORDS = {
    **RECORDS, "LayoutProcessingTask": FACT.replace(FACT_JOINS, NARROW_FACT_JOINS), "LayoutType": ITEM_RECORDS
}


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out when a file has fewer splits than there are cores; else leave them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    given(spark, sf_dir, "lineitem", "orders", "part", "customer", "nation")
    df = spark.sql(on_lines(WORK_ORDERS.replace(JOINS, NARROW_JOINS)))
    df.createOrReplaceTempView("work_orders")
    return df


def sheet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    work_orders(spark, sf_dir)
    given(spark, sf_dir, "region", "supplier")
    return spark.sql(SHEETS[name])


def sheets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw sheets, for whoever reads more than one: the work orders are joined and stored once for all of them."""
    orders = work_orders(spark, sf_dir).drop("Id", "TaskCode", "Engine", "Coding")
    store_and_reload(orders, "orders").createOrReplaceTempView("work_orders")
    given(spark, sf_dir, "region", "supplier")
    return {name: spark.sql(sql) for name, sql in SHEETS.items()}


def write_sheet(spark: SparkSession, sf_dir: str, name: str, path: str) -> None:
    """A raw sheet as a compressed file, as it is read once and whole."""
    rows = sheet(spark, sf_dir, name)
    with shuffles_dropped(spark):
        rows.write.options(**cells.WRITE).option("compression", "gzip").csv(path)


def repeated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    work_orders(spark, sf_dir)
    return spark.sql(REPEATED_ITEMS)


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    given(spark, sf_dir, "lineitem")
    return spark.sql(DATE_TEXTS)


def records(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    given(spark, sf_dir)
    return {name: spark.sql(on_lines(sql)) for name, sql in NARROW_RECORDS.items()}


def write_records(rows: DataFrame, path: str) -> None:
    """A record set as a landed file of bodies, compressed as a service sends them: it is read once and whole."""
    with shuffles_dropped(rows.sparkSession):
        rows.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").json(path)


def model_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    work_orders(spark, sf_dir)
    spark.sql(on_lines(ITEM_ORDERS)).createOrReplaceTempView("item_orders")
    return spark.sql(NARROW_MODEL_TASKS)


def stored_model_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned tasks as the model job finds them: a table the cleaning job has written."""
    return store_and_reload(model_tasks(spark, sf_dir), "tasks")


def sequence_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    given(spark, sf_dir, "events")
    return spark.sql(SEQUENCE_TASKS)


def model_rules(**changes) -> ModelRules:
    settings = dict(text_flags=TEXT_FLAGS, kept=KEPT, selected=SELECTED, first_year=FIRST_YEAR)
    return ModelRules(**{**settings, **changes})


def with_clauses(*names: str) -> str:
    """The named views as ``WITH`` clauses for the oracle."""
    texts = {
        "work_orders": WORK_ORDERS,
        "model_tasks": MODEL_TASKS,
        "sequence_tasks": SEQUENCE_TASKS,
        "date_texts": DATE_TEXTS,
    }
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({texts[n]})" for n in names) + "\n"
