"""Queries of sheets, entities, keys, loads and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark import vocab
from taskspark.operators import extract as ex
from taskspark.operators.ids import dense_ids
from taskspark.operators.keys import Lookup, choices, new_rows, resolve
from taskspark.plans import jobs, load
from taskspark.plans.entities import ENTITIES
from taskspark.session import path_exists, scratch_path, store_and_reload
from taskspark.sources import cells, scans, sinks
from taskspark.sources.tables import Tables, cause_code_ids
from taskspark.sources.tables import query as ad_hoc
from workload import tables
from workload.registry import query

WO = tables.with_clauses("work_orders")
DATES = ("Created_On", "Completed_On", "Planned_Start", "Planned_Finish")

# Text cells of the task sheet as the oracle sees them.
SAP_SQL = """
SELECT CAST(Notification AS VARCHAR) AS "Notification", CAST(Item AS VARCHAR) AS "Item",
       CAST(Task AS VARCHAR) AS "Task", Material AS "Material", Description AS "Description",
       CAST(Created_On AS VARCHAR) || ' 00:00:00' AS "Created On",
       CAST(Completed_On AS VARCHAR) || ' 00:00:00' AS "Completed On", TaskText AS "Task text",
       GroupCode AS "Code group", GroupText AS "Task group text", upper(TaskCodeText) AS "Task code",
       TaskCodeText AS "Task code text",
       CAST(Planned_Start AS VARCHAR) || ' 00:00:00' AS "Planned start",
       CASE WHEN Planned_Finish = DATE '2262-04-11' THEN '31-12-9999'
            ELSE CAST(Planned_Finish AS VARCHAR) || ' 00:00:00' END AS "Planned finish",
       SupplierVendor AS "Supplier Vendor", TaskOwner AS "Task Owner",
       TaskStatus AS "Task Status", Category AS "CATEGORY"
FROM work_orders
"""
RENAMED_SQL = """
SELECT CAST(Notification AS VARCHAR) AS Notification, CAST(Item AS VARCHAR) AS Item,
       CAST(Task AS VARCHAR) AS Task, Material, Description,
       CAST(Created_On AS VARCHAR) || ' 00:00:00' AS Created_On,
       CAST(Completed_On AS VARCHAR) || ' 00:00:00' AS Completed_On, TaskText,
       GroupCode, GroupText, upper(TaskCodeText) AS TaskCode, TaskCodeText,
       CAST(Planned_Start AS VARCHAR) || ' 00:00:00' AS Planned_Start,
       CASE WHEN Planned_Finish = DATE '2262-04-11' THEN '31-12-9999'
            ELSE CAST(Planned_Finish AS VARCHAR) || ' 00:00:00' END AS Planned_Finish,
       SupplierVendor, TaskOwner, TaskStatus, Category
FROM work_orders
"""
BLANKED_SQL = f"""
SELECT Notification, Item, Task, Material, Description, Created_On,
       coalesce(Completed_On, '') AS Completed_On, TaskText, GroupCode, GroupText, TaskCode,
       TaskCodeText, Planned_Start, Planned_Finish, SupplierVendor,
       coalesce(TaskOwner, '') AS TaskOwner, TaskStatus, Category
FROM ({RENAMED_SQL})
"""
ITEMS_SQL = """
SELECT CAST(Notification AS VARCHAR) AS Notification, CAST(Item AS VARCHAR) AS Sort_Number,
       Category AS Text, DamageCode,
       CASE WHEN DamageCode <> '70' THEN 'Damage ' || DamageCode END AS DamageText,
       CauseCode, 'Cause ' || CauseCode AS CauseText
FROM work_orders
"""
PROGRAMS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS Notification,
       'Z0' || CAST(r_regionkey AS VARCHAR) || '0' AS Coding, r_name AS CodingText,
       c_mktsegment AS Description
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
"""
SOURCE_SQL = {
    "layouttype": WO + f", sheet AS ({ITEMS_SQL})",
    "pwc_engineprogram": f"WITH sheet AS ({PROGRAMS_SQL})",
    "sap_raw_extract": WO + f", sheet AS ({BLANKED_SQL})",
    "categories": "WITH sheet AS (SELECT p_brand AS Description, p_type AS Category FROM part)",
}


def raw_sheet(spark, sf_dir, name: str) -> DataFrame:
    if name == "layouttype":
        return tables.repeated_items(spark, sf_dir)
    return tables.sheet(spark, sf_dir, {k.lower(): k for k in tables.SHEETS}[name])


# --- extraction: one query per entity ------------------------------------------------------

EXTRACT_NAMES = {
    "DamageCode": "damage", "CauseCode": "cause", "LayoutType": "item", "CodingCode": "coding",
    "EngineProgram": "program", "GroupCode": "group", "TaskCode": "taskcode",
    "SupplierVendor": "supplier", "TaskOwner": "owner", "TaskStatus": "status",
    "Material": "material", "LayoutTask": "task", "Category": "category",
}


def _register_extract(entity: str, spec: ex.Extract) -> None:
    order = [*spec.sort, *[c for c in spec.columns if c not in spec.sort]]
    rows = f"SELECT {'DISTINCT ' if spec.distinct else ''}{', '.join(spec.columns)} FROM sheet"
    by = ", ".join(f"{c} ASC NULLS LAST" for c in order)
    sql = (
        f"{SOURCE_SQL[spec.sheet]} SELECT row_number() OVER (ORDER BY {by}) AS Id, "
        f"{', '.join(spec.columns)} FROM ({rows})"
    )

    @query(f"extract_{EXTRACT_NAMES[entity]}", sql)
    def run(spark, sf_dir):
        return ex.extract(entity, raw_sheet(spark, sf_dir, spec.sheet))


for _entity, _spec in ex.EXTRACTS.items():
    _register_extract(_entity, _spec)


# --- new rows: one query per entity --------------------------------------------------------
# Loaded is what the history up to a date (or with a property) holds; the source is everything.

CUTOFF = "DATE '1995-02-01'"
# entity -> (source SQL, condition of what is loaded, key)
NEW_ROWS = {
    "GroupCode": (
        "SELECT GroupCode, GroupText || ' ' || TaskStatus AS GroupText, Created_On FROM work_orders",
        f"Created_On < {CUTOFF} AND GroupCode <> 'R'",
    ),
    "CodingCode": (
        "SELECT Coding, Engine AS CodingText, Created_On FROM work_orders",
        f"Created_On < {CUTOFF} AND Coding <> 'Z010'",
    ),
    "DamageCode": (
        "SELECT DamageCode, CASE WHEN DamageCode <> '70' THEN Category END AS DamageText, Created_On"
        " FROM work_orders",
        f"Created_On < {CUTOFF} AND coalesce(DamageText, 'Z') > 'L'",
    ),
    "CauseCode": (
        "SELECT CauseCode, Category AS CauseText, Created_On FROM work_orders",
        f"Created_On < {CUTOFF} AND CauseText > 'L'",
    ),
    "TaskOwner": (
        "SELECT TaskOwner AS TaskOwner_Id, Created_On FROM work_orders",
        "Created_On < DATE '1995-01-05'",
    ),
    "TaskStatus": ("SELECT TaskStatus, Created_On FROM work_orders", "TaskStatus <> 'P'"),
    "SupplierVendor": (
        "SELECT SupplierVendor AS SupplierVendor_Id, Created_On FROM work_orders",
        "Created_On < DATE '1995-01-15'",
    ),
    "Category": (
        "SELECT Category AS CategoryName, Created_On FROM work_orders", "CategoryName <> 'PROMO'"
    ),
    "TaskCode": (
        "SELECT TaskCode, TaskCodeText, ascii(GroupCode) AS GroupCode, Created_On FROM work_orders",
        f"Created_On < {CUTOFF}",
    ),
    "Material": (
        "SELECT Material AS Material_Id, Description, length(Category) AS Category_Id, Created_On"
        " FROM work_orders",
        f"Created_On < {CUTOFF}",
    ),
    "EngineProgram": (
        "SELECT CAST(Notification AS STRING) AS Notification_Id, Engine AS Description,"
        " length(Coding) AS CodingCode, Created_On FROM work_orders",
        f"Created_On < {CUTOFF}",
    ),
    "LayoutType": (
        "SELECT Notification AS Notification_Id, CAST(Item AS STRING) AS Item_Number,"
        " Category AS Layout_Text, Item AS DamageCode,"
        " CASE WHEN CauseCode <> 'L00' THEN length(CauseCode) END AS CauseCode, Created_On"
        " FROM work_orders",
        "Created_On < DATE '1998-01-01'",
    ),
    "LayoutTask": (
        "SELECT Notification * 10 + Item AS Layout_Id, CAST(Task AS STRING) AS Task_Id, Id AS Mark,"
        " Created_On FROM work_orders",
        "Created_On < DATE '1998-01-01'",
    ),
}


def _register_new_rows(entity: str, source: str, loaded: str) -> None:
    key = ENTITIES[entity].key
    same = " AND ".join(f"s.{k} IS NOT DISTINCT FROM d.{k}" for k in key)
    sql = (
        f"{WO}, src AS ({source}) SELECT * REPLACE (CAST(Created_On AS VARCHAR) AS Created_On)"
        f" FROM src s WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT {', '.join(key)} FROM src"
        f" WHERE {loaded}) d WHERE {same})"
    )

    @query(f"new_rows_{entity}", sql)
    def run(spark, sf_dir):
        tables.work_orders(spark, sf_dir)
        rows = spark.sql(source)
        found = new_rows(rows, rows.where(loaded), key)
        return found.withColumn("Created_On", F.col("Created_On").cast("string"))


for _entity, (_source, _loaded) in NEW_ROWS.items():
    _register_new_rows(_entity, _source, _loaded)


# --- keys to ids and back -------------------------------------------------------------------

# Dimensions with ids by rule; each lacks some keys, so that some facts stay unresolved.
DIMS = {
    "GroupCode": "SELECT DISTINCT ascii(l_returnflag) AS Id, l_returnflag AS GroupCode,"
    " 'Group ' || l_returnflag AS GroupText FROM lineitem WHERE l_returnflag <> 'N'",
    "Category": "SELECT DISTINCT ascii(p_type) * 100 + length(p_type) AS Id, p_type AS CategoryName"
    " FROM part WHERE p_type <> 'PROMO'",
    "CodingCode": "SELECT r_regionkey AS Id, 'Z0' || CAST(r_regionkey AS STRING) || '0' AS Coding,"
    " r_name AS CodingText FROM region WHERE r_name <> 'ASIA'",
    "EngineProgram": "SELECT c_custkey + 100 AS Id, CAST(c_custkey AS STRING) AS Notification_Id,"
    " c_mktsegment AS Description, n_regionkey AS CodingCode"
    " FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal >= 0",
    "CauseCode": "SELECT DISTINCT CAST(round(l_tax * 100) AS INT) % 5 + 1 AS Id,"
    " 'L0' || CAST(CAST(round(l_tax * 100) AS INT) % 5 AS STRING) AS CauseCode,"
    " 'Cause ' || CAST(CAST(round(l_tax * 100) AS INT) % 5 AS STRING) AS CauseText"
    " FROM lineitem WHERE l_tax > 0.01",
    "DamageCode": "SELECT DISTINCT l_linenumber AS Id, CAST(l_linenumber * 10 AS STRING) AS DamageCode,"
    " 'Damage ' || CAST(l_linenumber * 10 AS STRING) AS DamageText FROM lineitem WHERE l_linenumber < 7",
    "Material": "SELECT p_partkey + 7 AS Id, CAST(p_partkey AS STRING) AS Material_Id,"
    " p_brand AS Description, ascii(p_type) * 100 + length(p_type) AS Category_Id"
    " FROM part WHERE p_size > 2",
    "TaskOwner": "SELECT n_nationkey + 1 AS Id, n_name AS TaskOwner_Id FROM nation",
    "SupplierVendor": "SELECT s_suppkey + 5 AS Id, CAST(s_suppkey AS STRING) AS SupplierVendor_Id"
    " FROM supplier WHERE s_acctbal > 0",
    "TaskStatus": "SELECT DISTINCT ascii(o_orderstatus) AS Id, o_orderstatus AS TaskStatus FROM orders",
    "TaskCode": "SELECT DISTINCT p_partkey * 100 + ascii(l_returnflag) AS Id, upper(p_type) AS TaskCode,"
    " p_name AS TaskCodeText, ascii(l_returnflag) AS GroupCode"
    " FROM lineitem JOIN part ON p_partkey = l_partkey",
    "TaskCodeByGroup": "SELECT DISTINCT ascii(p_type) * 10000 + length(p_type) * 100 + ascii(l_returnflag)"
    " AS Id, upper(p_type) AS TaskCode, l_returnflag AS GroupCode"
    " FROM lineitem JOIN part ON p_partkey = l_partkey",
    "LayoutType": "SELECT DISTINCT (c_custkey + 100) * 10 + l_linenumber AS Id,"
    " c_custkey + 100 AS Notification_Id, CAST(l_linenumber AS STRING) AS Item_Number,"
    " c_mktsegment AS Layout_Text, l_linenumber AS DamageCode, l_linenumber % 5 + 1 AS CauseCode"
    " FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey",
    "ItemNumbers": "SELECT DISTINCT (c_custkey + 100) * 10 + l_linenumber AS Id,"
    " CAST(c_custkey AS STRING) AS Notification_Id, CAST(l_linenumber AS STRING) AS Item_Number"
    " FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey"
    " WHERE c_acctbal >= 0",
}


def dims(spark, sf_dir, *names: str) -> list[DataFrame]:
    tables.given(spark, sf_dir)
    return [spark.sql(DIMS[n]) for n in names]


def _fk(entity: str, source: str, lookups, dim_names) -> str:
    """Oracle of ``resolve``: left joins, ids under their names, keys kept, first missing named."""
    joins, ids, reasons = [], [], []
    for n, (look, dim) in enumerate(zip(lookups, dim_names)):
        on = " AND ".join(f"CAST(s.{k} AS VARCHAR) = CAST(d{n}.{d} AS VARCHAR)" for k, d in look.on.items())
        joins.append(f"LEFT JOIN ({DIMS[dim]}) d{n} ON {on}")
        ids.append(f"d{n}.{look.id} AS {look.name}")
        if look.required:
            reasons.append(f"WHEN d{n}.{look.id} IS NULL THEN 'no {look.entity}'")
    return f"{WO}, src AS ({source}) SELECT {{kept}}, {', '.join(ids)}, {{keys}}, CASE {' '.join(reasons)} END AS reject_reason FROM src s {' '.join(joins)}"


FK_SOURCES = {
    "taskcode": ("TaskCode", ["GroupCode"], "SELECT DISTINCT TaskCode, TaskCodeText, GroupCode FROM work_orders"),
    "material": (
        "Material", ["Category"],
        "SELECT DISTINCT Material AS Material_Id, Description, Category AS CategoryName FROM work_orders",
    ),
    "program": (
        "EngineProgram", ["CodingCode"],
        "SELECT DISTINCT Notification AS Notification_Id, Coding, Engine AS Description FROM work_orders",
    ),
    "item": (
        "LayoutType", ["EngineProgram", "DamageCode", "CauseCode"],
        "SELECT Notification, Item AS Item_Number, Category AS Layout_Text, DamageCode, CauseCode"
        " FROM work_orders",
    ),
    "task": (
        "LayoutTask",
        ["ItemNumbers", "Material", "TaskOwner", "SupplierVendor", "TaskStatus", "TaskCodeByGroup"],
        "SELECT Id AS Mark, Notification, Item, Task AS Task_Id, Material, TaskText AS Task_Text,"
        " GroupCode, TaskCode, SupplierVendor, TaskOwner, TaskStatus FROM work_orders",
    ),
}


def _register_fk(name: str, entity: str, dim_names: list[str], source: str) -> None:
    lookups: tuple[Lookup, ...] = ENTITIES[entity].lookups
    used = [k for look in lookups for k in look.on]
    columns = [part.split(" AS ")[-1].strip() for part in source.split(" FROM ")[0][7:].replace("DISTINCT ", "").split(",")]
    kept = ", ".join(f"s.{c}" for c in columns if c not in used)
    keys = ", ".join(f"s.{c} AS key_{c}" for c in columns if c in used)

    @query(f"fk_{name}", _fk(entity, source, lookups, dim_names).format(kept=kept, keys=keys))
    def run(spark, sf_dir):
        tables.work_orders(spark, sf_dir)
        return resolve(spark.sql(source), list(zip(lookups, dims(spark, sf_dir, *dim_names))))


for _name, (_entity, _dims, _source) in FK_SOURCES.items():
    _register_fk(_name, _entity, _dims, _source)


@query(
    "expand_taskcode",
    f"SELECT t.Id, TaskCode, TaskCodeText, g.GroupCode, g.GroupText FROM ({DIMS['TaskCode']}) t"
    f" LEFT JOIN ({DIMS['GroupCode']}) g ON g.Id = t.GroupCode",
)
def expand_taskcode(spark, sf_dir):
    return load.expand_taskcode(*dims(spark, sf_dir, "TaskCode", "GroupCode"))


@query(
    "expand_material",
    f"SELECT m.Id, Material_Id, Description, CategoryName FROM ({DIMS['Material']}) m"
    f" LEFT JOIN ({DIMS['Category']}) c ON c.Id = m.Category_Id",
)
def expand_material(spark, sf_dir):
    return load.expand_material(*dims(spark, sf_dir, "Material", "Category"))


@query(
    "expand_program",
    f"SELECT p.Id, Notification_Id, Description, c.Coding AS CodingCode, CodingText"
    f" FROM ({DIMS['EngineProgram']}) p LEFT JOIN ({DIMS['CodingCode']}) c ON c.Id = p.CodingCode",
)
def expand_program(spark, sf_dir):
    return load.expand_program(*dims(spark, sf_dir, "EngineProgram", "CodingCode"))


@query(
    "expand_item",
    f"SELECT i.Id, Item_Number, Layout_Text, p.Notification_Id AS Notification, p.Description,"
    f" c.Coding AS CodingCode, c.CodingText, u.CauseCode, u.CauseText, d.DamageCode, d.DamageText"
    f" FROM ({DIMS['LayoutType']}) i LEFT JOIN ({DIMS['EngineProgram']}) p ON p.Id = i.Notification_Id"
    f" LEFT JOIN ({DIMS['CodingCode']}) c ON c.Id = p.CodingCode"
    f" LEFT JOIN ({DIMS['CauseCode']}) u ON u.Id = i.CauseCode"
    f" LEFT JOIN ({DIMS['DamageCode']}) d ON d.Id = i.DamageCode",
)
def expand_item(spark, sf_dir):
    return load.expand_item(
        *dims(spark, sf_dir, "LayoutType", "EngineProgram", "CodingCode", "CauseCode", "DamageCode")
    )


OPEN_SQL = "SELECT Notification, Item, Task, Material FROM work_orders WHERE Completed_On IS NULL"
DONE_SQL = "SELECT Notification, Item, max(Completed_On) AS Done FROM work_orders WHERE Completed_On IS NOT NULL GROUP BY Notification, Item"


@query(
    "task_item_mismatch",
    f"""{WO}, t AS ({OPEN_SQL}), i AS ({DONE_SQL})
SELECT Notification, Item, Task, Material, CAST(NULL AS VARCHAR) AS Done, 'task' AS side FROM t
WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.Notification = t.Notification AND i.Item = t.Item)
UNION ALL
SELECT Notification, Item, NULL, NULL, CAST(Done AS VARCHAR), 'item' FROM i
WHERE NOT EXISTS (SELECT 1 FROM t WHERE i.Notification = t.Notification AND i.Item = t.Item)""",
)
def task_item_mismatch(spark, sf_dir):
    """Open tasks whose item has nothing done, and items that have nothing open."""
    tables.work_orders(spark, sf_dir)
    found = load.task_item_mismatch(spark.sql(OPEN_SQL), spark.sql(DONE_SQL))
    return found.withColumn("Done", F.col("Done").cast("string"))


# --- scans, sinks, loads --------------------------------------------------------------------


@query("scan_raw_sheets", WO + SAP_SQL)
def scan_raw_sheets(spark, sf_dir):
    path = scratch_path(spark, "raw")
    names = ("SAP_Raw_Extract", "PWC_EngineProgram")
    for name in names:
        tables.sheet(spark, sf_dir, name).write.options(**cells.WRITE).csv(f"{path}/{name}")
    return scans.scan_sheets(spark, {n: f"{path}/{n}" for n in names})["SAP_Raw_Extract"]


def _cells(*columns: str) -> str:
    """All cells of a row as one text, in which null and blank differ."""
    return " || '|' || ".join(f"coalesce({c}, '<null>')" for c in columns)


ITEM_SHEET_SQL = """
SELECT CAST(Notification AS VARCHAR) AS a, CAST(Item AS VARCHAR) AS b, min(TaskText) AS c, DamageCode AS d,
       CASE WHEN DamageCode <> '70' THEN 'Damage ' || DamageCode END AS e, min(CauseCode) AS f,
       'Cause ' || min(CauseCode) AS g
FROM work_orders GROUP BY Notification, Item, DamageCode
"""
SAP_COLUMNS = tuple(
    f'"{c}"'
    for c in (
        "Notification", "Item", "Task", "Material", "Description", "Created On", "Completed On", "Task text",
        "Code group", "Task group text", "Task code", "Task code text", "Planned start", "Planned finish",
        "Supplier Vendor", "Task Owner", "Task Status", "CATEGORY",
    )
)


@query(
    "scan_all_sheets",
    f"""{WO}, sap AS ({SAP_SQL}), items AS ({ITEM_SHEET_SQL}), programs AS ({PROGRAMS_SQL})
SELECT 'SAP_Raw_Extract' AS sheet, {_cells(*SAP_COLUMNS)} AS cells FROM sap
UNION ALL SELECT 'LayoutType', {_cells(*"abcdefg")} FROM items
UNION ALL SELECT 'PWC_EngineProgram', {_cells("Notification", "Coding", "CodingText", "Description")} FROM programs
UNION ALL SELECT 'Categories', {_cells("p_brand", "p_type")} FROM part""",
)
def scan_all_sheets(spark, sf_dir):
    """Every row of the four raw sheets, as written and scanned again."""
    path, out = scratch_path(spark, "raw"), None
    for name in tables.SHEETS:
        tables.write_sheet(spark, sf_dir, name, f"{path}/{name}")
    for name, rows in scans.scan_sheets(spark, {n: f"{path}/{n}" for n in tables.SHEETS}).items():
        texts = [F.coalesce(F.col(f"`{c}`"), F.lit("<null>")) for c in rows.columns]
        one = rows.select(F.lit(name).alias("sheet"), F.concat_ws("|", *texts).alias("cells"))
        out = one if out is None else out.union(one)
    return out


AWKWARD_SQL = r"""
SELECT CAST(doc_id AS STRING) AS Document,
       CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat(' ', text, '  ')
            WHEN 3 THEN concat('";', text, chr(92)) ELSE concat(chr(13), chr(10), text, chr(9), '"') END AS Text,
       CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN concat(';', source, chr(10)) END AS Source
FROM documents
"""


@query("sink_texts_csv", AWKWARD_SQL)
def sink_texts_csv(spark, sf_dir):
    """Whole texts with quotes, separators, line breaks, outer blanks and backslashes, through an entity file."""
    tables.given(spark, sf_dir, "documents")
    path = scratch_path(spark, "texts")
    rows = spark.sql(AWKWARD_SQL).select(F.col("Document").cast("long").alias("Id"), "Document", "Text", "Source")
    sinks.write_entity(rows, path, rows_per_file=10_000)
    return scans.scan_entity(spark, path, ["Document", "Text", "Source"])


@query(
    "scan_entity_folder",
    f"""{WO}, t AS ({BLANKED_SQL}), programs AS ({PROGRAMS_SQL})
SELECT 'Material' AS entity, Material || '|' || Description || '|' || Category AS cells
FROM (SELECT DISTINCT Material, Description, Category FROM t)
UNION ALL SELECT 'TaskOwner', TaskOwner FROM (SELECT DISTINCT TaskOwner FROM t)
UNION ALL SELECT 'EngineProgram', Notification || '|' || Coding || '|' || Description FROM programs""",
)
def scan_entity_folder(spark, sf_dir):
    """All entity files of a folder; a blank cell is a blank, not a missing one."""
    path, out = scratch_path(spark, "entities"), None
    wanted = {"Material": "sap_raw_extract", "TaskOwner": "sap_raw_extract", "EngineProgram": "pwc_engineprogram"}
    for entity, sheet in wanted.items():
        sinks.write_entity(ex.extract(entity, raw_sheet(spark, sf_dir, sheet)), f"{path}/{entity}")
    columns = {e: list(ex.EXTRACTS[e].columns) for e in wanted}
    for entity, rows in scans.scan_entity_folder(spark, path, columns).items():
        # concat gives null for a missing cell, as || does
        parts = [F.lit("|") if n % 2 else F.col(rows.columns[n // 2]) for n in range(2 * len(rows.columns) - 1)]
        one = rows.select(F.lit(entity).alias("entity"), F.concat(*parts).alias("cells"))
        out = one if out is None else out.union(one)
    return out


@query(
    "sink_entity_csv",
    f"WITH sheet AS ({PROGRAMS_SQL}) SELECT CAST(row_number() OVER (ORDER BY Notification, Coding,"
    " Description) AS VARCHAR) AS Id, Notification, Coding, Description FROM sheet",
)
def sink_entity_csv(spark, sf_dir):
    path = scratch_path(spark, "entity")
    sinks.write_entity(ex.extract("EngineProgram", raw_sheet(spark, sf_dir, "pwc_engineprogram")), path)
    schema = "Id string, Notification string, Coding string, Description string"
    return spark.read.schema(schema).option("header", True).option("sep", ";").csv(path)


@query(
    "scan_entity_csv",
    f"{WO}, sheet AS ({BLANKED_SQL}) SELECT DISTINCT Material, Description, Category FROM sheet",
)
def scan_entity_csv(spark, sf_dir):
    path = scratch_path(spark, "entity")
    sinks.write_entity(ex.extract("Material", raw_sheet(spark, sf_dir, "sap_raw_extract")), path)
    return scans.scan_entity(spark, path, list(ex.EXTRACTS["Material"].columns))


@query("scan_table", DIMS["Material"])
def scan_table(spark, sf_dir):
    store = Tables(spark, scratch_path(spark, "tables"))
    store.append(dims(spark, sf_dir, "Material")[0], "Material")
    return store.read("Material")


@query(
    "adhoc_sql",
    f"SELECT c.CauseCode, count(*) AS n FROM ({DIMS['LayoutType']}) i"
    f" JOIN ({DIMS['CauseCode']}) c ON c.Id = i.CauseCode GROUP BY c.CauseCode",
)
def adhoc_sql(spark, sf_dir):
    items, causes = dims(spark, sf_dir, "LayoutType", "CauseCode")
    text = (
        "SELECT c.CauseCode, count(*) AS n FROM {items} i JOIN {causes} c ON c.Id = i.CauseCode"
        " GROUP BY c.CauseCode"
    )
    return ad_hoc(spark, text, items=items, causes=cause_code_ids(causes))


RECORD_COLUMNS = (
    "LayoutTaskId string, TaskId bigint, ItemNumber bigint, NotificationCode bigint,"
    " MaterialCode string, CreatedOn string, CompletedOn string, TaskText string,"
    " TaskCodeId bigint, TaskOwnerId bigint"
)
RECORD_NAMES = ", ".join(part.split()[0] for part in RECORD_COLUMNS.split(","))


@query("scan_json_records", f"SELECT {RECORD_NAMES} FROM ({tables.RECORDS['LayoutProcessingTask']})")
def scan_json_records(spark, sf_dir):
    path = scratch_path(spark, "records")
    tables.write_records(tables.records(spark, sf_dir)["LayoutProcessingTask"], path)
    return scans.scan_records(spark, path, RECORD_COLUMNS)


STRAY_SQL = f"""
SELECT LayoutTaskId, CASE WHEN TaskId > 48 THEN 'n/a' ELSE CAST(TaskId AS STRING) END AS TaskId,
       ItemNumber, NotificationCode, CASE WHEN ItemNumber = 6 THEN 'later' ELSE CreatedOn END AS CreatedOn,
       TaskText, CAST(NotificationCode % 4 AS INT) AS kind
FROM ({{tasks}})
"""
STRAY_COLUMNS = "LayoutTaskId string, TaskId bigint, NotificationCode bigint, CreatedOn date, TaskText string"


@query(
    "scan_json_rejects",
    f"""WITH stray AS ({STRAY_SQL.format(tasks=tables.RECORDS['LayoutProcessingTask'])}),
told AS (SELECT *, CASE WHEN kind = 3 AND ItemNumber = 1 THEN 'not JSON' WHEN TaskId = 'n/a' THEN 'cast TaskId'
                        WHEN CreatedOn = 'later' THEN 'cast CreatedOn' END AS reject_reason FROM stray)
SELECT CASE WHEN reject_reason IS NULL THEN LayoutTaskId END AS LayoutTaskId,
       CASE WHEN reject_reason IS NULL THEN TRY_CAST(TaskId AS BIGINT) END AS TaskId,
       CASE WHEN reject_reason IS NULL THEN NotificationCode END AS NotificationCode,
       CASE WHEN reject_reason IS NULL THEN CreatedOn END AS CreatedOn,
       CASE WHEN reject_reason IS NULL THEN TaskText END AS TaskText, reject_reason
FROM told
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 'no object' FROM stray WHERE kind = 2 AND ItemNumber = 2""",
)
def scan_json_rejects(spark, sf_dir):
    """Service bodies as objects and arrays, some with stray values, stray items or cut short: every record once."""
    tables.given(spark, sf_dir)
    stray = spark.sql(STRAY_SQL.format(tasks=tables.on_lines(tables.RECORDS["LayoutProcessingTask"])))
    text = F.to_json(F.struct(*[c for c in stray.columns if c != "kind"]))
    number = F.col("ItemNumber")
    body = (
        F.when((F.col("kind") == 3) & (number == 1), F.expr("left(body, length(body) - 3)"))
        .when((F.col("kind") == 2) & (number == 2), F.concat(F.lit("[7, "), "body", F.lit("]")))
        .when(F.col("kind") == 1, F.concat(F.lit(" [ "), "body", F.lit(" ]")))
        .otherwise(F.col("body"))
    )
    path = scratch_path(spark, "bodies")
    stray.withColumn("body", text).select(body.alias("value")).write.text(path)
    rows = scans.scan_records_marked(spark, path, STRAY_COLUMNS).drop("record")
    return rows.withColumn("CreatedOn", F.col("CreatedOn").cast("string"))


def _renamed_sources() -> str:
    """All record sets with our column names, each row as one text of its cells by name."""
    parts = []
    for name, sql in tables.RECORDS.items():
        renames = vocab.SOURCE_FIELDS[name]
        columns = sorted(renames.get(c, c) for c in SOURCE_COLUMNS[name])
        back = {renames.get(c, c): c for c in SOURCE_COLUMNS[name]}
        cell = " || '|' || ".join(f"'{c}=' || coalesce(CAST({back[c]} AS VARCHAR), '<null>')" for c in columns)
        parts.append(f"SELECT '{name}' AS source, {cell} AS cells FROM ({sql})")
    return " UNION ALL ".join(parts)


#: Columns of every record set as the services name them.
SOURCE_COLUMNS = {
    "GroupCode": ("CodeGroupId", "CodeGroupName", "CodeGroupText"),
    "SupplierVendor": ("SupplierVendorId", "SupplierVendorCode"),
    "DamageCode": ("DamageCodeId", "DamageCodeName", "DamageCodeText"),
    "CauseCode": ("CauseCodeId", "CauseCode", "CauseText"),
    "TaskOwner": ("TaskOwnerId", "TaskOwnerCode"),
    "TaskStatus": ("TaskStatusId", "TaskStatusCode"),
    "EngineProgram": ("EngineProgramId", "NotificationCode", "Description", "CodingCodeId"),
    "CodingCode": ("CodingCodeId", "CodingCodeName", "CodingCodeText"),
    "TaskCode": ("TaskCodeId", "TaskCodeName", "TaskCodeText", "GroupCodeId", "GroupCodeName"),
    "LayoutProcessingTask": (
        "LayoutTaskId", "TaskId", "ItemNumber", "NotificationCode", "MaterialCode", "CreatedOn", "CompletedOn",
        "TaskText", "TaskCodeId", "PlannedStart", "PlannedFinish", "SupplierVendorId", "TaskOwnerId",
        "TaskStatusId", "CategoryId", "DamageCodeId", "CauseCodeId", "CodeGroupId",
    ),
    "Material": ("MaterialCode", "Description", "CategoryId"),
    "LayoutType": ("NotificationId", "ItemNumber", "LayoutText", "DamageCodeName", "CauseCodeName"),
    "GeneralCode": ("CodeGroup", "TaskCode", "GeneralCode"),
    "Category": ("CategoryId", "CategoryName"),
}


@query("load_all_sources", _renamed_sources())
def load_all_sources(spark, sf_dir):
    """Every record of all fourteen sets under our column names, by way of landed bodies."""
    root, landed, out = scratch_path(spark, "landed"), {}, None
    for name, rows in tables.records(spark, sf_dir).items():
        tables.write_records(rows, f"{root}/{name}")
        landed[name] = scans.scan_records(spark, f"{root}/{name}", rows.schema)
    for name, rows in scans.load_sources(landed).items():
        parts = [
            F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("<null>"))) for c in sorted(rows.columns)
        ]
        one = rows.select(F.lit(name).alias("source"), F.concat_ws("|", *parts).alias("cells"))
        out = one if out is None else out.union(one)
    return out


@query(
    "load_sources",
    f"""SELECT LayoutTaskId, TaskId AS Task, ItemNumber AS Item, NotificationCode AS Notification,
       MaterialCode AS Material, CreatedOn AS Created_On, CompletedOn AS Completed_On,
       PlannedStart AS Planned_Start, PlannedFinish AS Planned_Finish, TaskCodeId,
       SupplierVendorId, TaskOwnerId, TaskStatusId, CategoryId, DamageCodeId, CauseCodeId,
       CodeGroupId AS GroupCodeId
FROM ({tables.RECORDS['LayoutProcessingTask']})""",
)
def load_sources(spark, sf_dir):
    found = scans.load_sources(
        tables.records(spark, sf_dir),
        dropped={"LayoutProcessingTask": ["TaskText"]},
        inactive=("Category",),
    )
    assert "Category" not in found
    return found["LayoutProcessingTask"]


RUN_DATES = ("2024-01-01T00:00:00", "2024-01-02T00:00:00")


@query(
    "sink_run_dated",
    f"SELECT Id, Material_Id, Description, Category_Id, run_date FROM ({DIMS['Material']}),"
    f" (VALUES ('{RUN_DATES[0]}'), ('{RUN_DATES[1]}')) r(run_date)",
)
def sink_run_dated(spark, sf_dir):
    path = scratch_path(spark, "runs")
    rows = dims(spark, sf_dir, "Material")[0]
    for run_date in RUN_DATES:
        sinks.write_run(rows, path, run_date)
    schema = "Id bigint, Material_Id string, Description string, Category_Id int, run_date string"
    return spark.read.schema(schema).parquet(path)


REJECT_SQL = (
    "SELECT CAST(Notification AS STRING) AS Notification, CAST(Item AS STRING) AS Item, Category,"
    " CASE WHEN Task > 48 THEN 'n/a' ELSE CAST(Task AS STRING) END AS Task_Id, TaskOwner FROM work_orders"
)


@query(
    "load_with_rejects",
    f"""{WO}, src AS ({REJECT_SQL}),
marked AS (SELECT *, CASE WHEN TRY_CAST(Task_Id AS BIGINT) IS NULL THEN 'cast Task_Id'
                          WHEN TaskOwner IS NULL THEN 'null TaskOwner' END AS reason FROM src),
ranked AS (SELECT *, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY Notification, Item,
             Category, reason IS NULL ORDER BY Task_Id, TaskOwner) END AS place FROM marked)
SELECT Notification, Item, Category, Task_Id, TaskOwner,
       coalesce(reason, CASE WHEN place > 1 THEN 'duplicate key' END) AS reject_reason,
       count(*) AS copies
FROM ranked GROUP BY ALL""",
)
def load_with_rejects(spark, sf_dir):
    """Rows as stored or rejected; the first task of an item's category is stored."""
    tables.work_orders(spark, sf_dir)
    return sinks.mark_rejects(
        spark.sql(REJECT_SQL),
        required=("TaskOwner",),
        types={"Task_Id": "bigint"},
        unique=("Notification", "Item", "Category"),
    )


def entity_sources(spark, sf_dir) -> dict[str, DataFrame]:
    """Rows of all entities as their files hold them; suppliers are those in credit."""
    found = {}
    for sheet, raw in tables.sheets(spark, sf_dir).items():
        cleaned = ex.clean_sheet(sheet, raw)
        if sheet != "SAP_Raw_Extract":  # its rows are those of the stored work orders
            cleaned = store_and_reload(cleaned, "sheet")
        for entity, spec in ex.EXTRACTS.items():
            if spec.sheet == sheet.lower():
                rows = ex.entity_rows(entity, cleaned)
                found[entity] = rows.distinct() if spec.distinct else rows
    found["SupplierVendor"] = spark.sql(
        "SELECT CAST(s_suppkey AS STRING) AS SupplierVendor FROM supplier WHERE s_acctbal > 0"
    )
    return found


LOADED_SQL = f"""{WO}, t AS ({BLANKED_SQL}), credit AS (SELECT CAST(s_suppkey AS VARCHAR) AS code FROM supplier
    WHERE s_acctbal > 0),
items AS (SELECT Notification, Item, DamageCode, min(CauseCode) AS CauseCode FROM work_orders GROUP BY ALL),
tasks AS (SELECT DISTINCT Notification, Item, Task, Material, Created_On, Completed_On, TaskText,
    GroupCode, TaskCode, Planned_Start, Planned_Finish, SupplierVendor, TaskOwner, TaskStatus FROM t),
fine AS (SELECT * FROM tasks WHERE SupplierVendor IN (SELECT code FROM credit)),
loaded AS (
SELECT 'GroupCode' AS entity, count(*) AS stored, 0 AS again, 0 AS unresolved FROM (SELECT DISTINCT GroupCode, GroupText FROM t)
UNION ALL SELECT 'CodingCode', count(*), 0, 0 FROM region
UNION ALL SELECT 'DamageCode', count(DISTINCT DamageCode), 0, 0 FROM items
UNION ALL SELECT 'CauseCode', count(DISTINCT coalesce(CauseCode, '')), 0, 0 FROM items
UNION ALL SELECT 'TaskOwner', count(DISTINCT TaskOwner), 0, 0 FROM t
UNION ALL SELECT 'TaskStatus', count(DISTINCT TaskStatus), 0, 0 FROM t
UNION ALL SELECT 'SupplierVendor', count(*), 0, 0 FROM credit
UNION ALL SELECT 'Category', count(DISTINCT p_type), 0, 0 FROM part
UNION ALL SELECT 'TaskCode', count(*), 0, 0 FROM (SELECT DISTINCT TaskCode, TaskCodeText, GroupCode FROM t)
UNION ALL SELECT 'Material', count(*), 0, 0 FROM (SELECT DISTINCT Material, Description, Category FROM t)
UNION ALL SELECT 'EngineProgram', count(*), 0, 0 FROM customer
UNION ALL SELECT 'LayoutType', count(*), 0, 0 FROM items
UNION ALL SELECT 'LayoutTask', (SELECT count(*) FROM (SELECT DISTINCT Notification, Item, Task FROM fine)),
    (SELECT count(*) FROM fine) - (SELECT count(*) FROM (SELECT DISTINCT Notification, Item, Task FROM fine)),
    (SELECT count(*) FROM tasks) - (SELECT count(*) FROM fine))"""


@query("load_all", f"{LOADED_SQL} SELECT entity, stored, again + unresolved AS rejects FROM loaded")
def load_all(spark, sf_dir):
    """Rows stored and rejected by entity when everything is loaded into empty tables."""
    store = Tables(spark, scratch_path(spark, "tables"))
    done = load.load_all(entity_sources(spark, sf_dir), store)
    counts = [
        d.rejects.agg(
            F.lit(d.entity).alias("entity"),
            F.lit(d.rows).cast("long").alias("stored"),
            F.coalesce(F.sum("copies"), F.lit(0).cast("long")).alias("rejects"),
        )
        for d in done
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.union(one)
    return out


@query(
    "load_twice",
    f"""{LOADED_SQL} SELECT entity, stored + again + unresolved AS source, stored, 0::BIGINT AS known,
    again + unresolved AS rejected, 0::BIGINT AS stored_again, stored + again AS known_again,
    unresolved AS rejected_again, stored AS in_table FROM loaded""",
)
def load_twice(spark, sf_dir):
    """The same sources loaded two times: what each load did with their rows, and what the tables hold then."""
    store = Tables(spark, scratch_path(spark, "tables"))
    sources = {e: store_and_reload(rows, "source") for e, rows in entity_sources(spark, sf_dir).items()}
    first = {d.entity: d for d in load.load_all(sources, store)}
    second = {d.entity: d for d in load.load_all(sources, store)}
    rows = [
        (
            e, sources[e].count(), d.rows, d.known, d.rejected, second[e].rows, second[e].known, second[e].rejected,
            store.read(ENTITIES[e].table).count(),
        )
        for e, d in first.items()
    ]
    names = "source stored known rejected stored_again known_again rejected_again in_table".split()
    return spark.createDataFrame(rows, "entity string, " + ", ".join(f"{n} long" for n in names))


CODES_SQL = """
SELECT DISTINCT TaskCode, GroupCode, TaskCodeText, ascii(GroupCode) * 1000000 + length(TaskCodeText) AS Id
FROM work_orders
"""


@query(
    "taskcode_choices",
    f"""{WO}, codes AS ({CODES_SQL}), least AS (SELECT TaskCode, GroupCode, min(Id) AS chosen FROM codes
    GROUP BY TaskCode, GroupCode HAVING count(*) > 1)
SELECT codes.*, chosen FROM codes JOIN least USING (TaskCode, GroupCode)""",
)
def taskcode_choices(spark, sf_dir):
    """Task codes with several texts in a group, and the id that tasks with such a code get."""
    tables.work_orders(spark, sf_dir)
    look = next(x for x in ENTITIES["LayoutTask"].lookups if x.entity == "TaskCode")
    return choices(look, spark.sql(CODES_SQL))


# --- names and cells ------------------------------------------------------------------------


@query("rename_map", WO + RENAMED_SQL)
def rename_map(spark, sf_dir):
    return tables.sheet(spark, sf_dir, "SAP_Raw_Extract").withColumnsRenamed(vocab.SAP_HEADINGS)


@query("null_to_blank", WO + BLANKED_SQL)
def null_to_blank(spark, sf_dir):
    return ex.clean_sheet("SAP_Raw_Extract", tables.sheet(spark, sf_dir, "SAP_Raw_Extract"))


JOB_SQL = LOADED_SQL.replace(
    "SELECT CAST(s_suppkey AS VARCHAR) AS code FROM supplier\n    WHERE s_acctbal > 0",
    "SELECT DISTINCT SupplierVendor AS code FROM t",
)


@query("job_import_entities", f"{JOB_SQL} SELECT entity, stored, again + unresolved AS rejects FROM loaded")
def job_import_entities(spark, sf_dir):
    """Sheets to entity files to tables: rows stored, and rows in the files of rejects, by entity."""
    root = scratch_path(spark, "import")
    paths = {name: f"{root}/raw/{name}" for name in tables.SHEETS}
    for name, path in paths.items():
        tables.write_sheet(spark, sf_dir, name, path)
    jobs.split_raw(spark, paths, f"{root}/entities", compression="gzip")
    store = Tables(spark, f"{root}/tables")
    jobs.import_entities(spark, f"{root}/entities", store, f"{root}/failed", compression="gzip")
    return reduce(DataFrame.unionByName, [_imported(spark, root, store, e) for e in ENTITIES.values()])


def _imported(spark, root, store, entity) -> DataFrame:
    stored = store.read(entity.table).agg(F.count("*").alias("stored"))
    failed = f"{root}/failed/Failed_{entity.name}"
    rejects = F.lit(0).cast("long").alias("rejects")
    if path_exists(spark, failed):
        rows = spark.read.option("sep", ";").options(**cells.read_options()).csv(failed)
        return rows.agg(F.sum(F.col("copies").cast("long")).alias("rejects")).join(stored).select(
            F.lit(entity.name).alias("entity"), "stored", "rejects"
        )
    return stored.select(F.lit(entity.name).alias("entity"), "stored", rejects)
