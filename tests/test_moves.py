"""What is moved and kept on disk: join order, shared rows, compressed files, dropped shuffles."""

import glob
from datetime import date

from pyspark.sql import functions as F

from taskspark.operators import cleaning, extract, ids, impute
from taskspark.session import job_scratch, scratch_path, shuffles_dropped
from taskspark.sources import scans, sinks
from workload import loading, tables

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_entity_files_may_be_compressed(spark, tmp_path):
    rows = spark.createDataFrame([(1, ' a;"b"\n'), (2, None), (3, "")], "Id long, Text string")
    path = str(tmp_path / "rows")
    assert sinks.write_entity(rows, path, compression="gzip")
    assert glob.glob(f"{path}/*.csv.gz") and not glob.glob(f"{path}/*.csv")
    found = [r["Text"] for r in scans.scan_entity(spark, path, ["Text"]).collect()]
    assert sorted(found, key=str) == sorted([' a;"b"\n', None, ""], key=str)


def test_shuffles_are_dropped_only_inside(spark):
    before = spark.conf.get(CLEANUP, None)
    with shuffles_dropped(spark):
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP, None) == before


def test_records_are_sorted_out_without_their_schema(spark, tmp_path):
    path = str(tmp_path / "bodies")
    bodies = ['{"a":1,"b":"x"}', '[{"a":2},7,null]', '{"a":"n/a"}', "[]", "null", '{"a":'
    ]
    spark.createDataFrame([(b,) for b in bodies], "value string").write.text(path)
    rows = scans.scan_records_marked(spark, path, "a long, b string")
    assert "schema_of_variant" not in rows._jdf.queryExecution().toString()
    found = sorted((r["a"], r["b"], r["reject_reason"], r["record"]) for r in rows.fillna({"a": -1, "b": "", "reject_reason": "", "record": ""}).collect())
    assert found == sorted([
        (1, "x", "", ""), (2, "", "", ""), (-1, "", "no object", "7"), (-1, "", "no object", "null"),
        (-1, "", "cast a", '{"a":"n/a"}'), (-1, "", "no object", "null"), (-1, "", "not JSON", '{"a":'),
    ])


def test_items_and_task_codes_are_joined_to_narrow_tasks(spark):
    fact = {c: F.lit(1).cast("string").alias(c) for c in cleaning.FACT_COLUMNS}
    one = spark.range(1)
    dims = {
        "EngineProgram": ("Notification", "Coding", "Description"), "SupplierVendor": ("SupplierVendorId", "SupplierVendor"),
        "TaskOwner": ("TaskOwnerId", "TaskOwner"), "TaskStatus": ("TaskStatusId", "TaskStatus"),
        "GroupCode": ("GroupCodeId", "GroupCode"), "CauseCode": ("CauseCodeId", "CauseCode"),
        "DamageCode": ("DamageCodeId", "DamageCode"), "Category": ("CategoryId", "Category"),
        "TaskCode": ("TaskCodeId", "TaskCode", "TaskCodeText", "GroupCode"),
        "GeneralCode": ("Code_Group", "Task_Code", "GeneralCode"),
    }
    found = {n: one.select(*[F.lit("1").alias(c) for c in cs]) for n, cs in dims.items()}
    found["GeneralCode"] = one.select(*[F.lit("1").alias(c) for c in ("CodeGroup", "Code_Group", "TaskCode", "Task_Code", "GeneralCode")])
    found["LayoutProcessingTask"] = one.select(*fact.values())
    joined = cleaning.star_join({**found, "TaskCode": one.select(*[F.lit("1").alias(c) for c in ("TaskCodeId", "TaskCode", "TaskCodeText", "GeneralCode")])})
    plan = joined._jdf.queryExecution().analyzed().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 9 and "TaskCodeId" in joins[-2]  # the plan lists the last join first
    assert joined.columns[0] == "TaskCodeId" and joined.columns[-3:] == ["TaskCode", "TaskCodeText", "GeneralCode"]


def test_part_texts_are_joined_last():
    text = tables.WORK_ORDERS.replace(tables.JOINS, tables.NARROW_JOINS)
    assert text != tables.WORK_ORDERS
    assert text.index("JOIN part p") > text.index("JOIN customer c")


def _order_tables(spark, folder):
    """Orders of three items; a line without a part, an order without a customer, a part and an order that repeat."""
    rows = {
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "N", 0)]),
        "customer": ("c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, 1, 5.0, "S"), (2, 1, -5.0, None)]),
        "part": ("p_partkey long, p_name string, p_type string, p_brand string", [(1, "ring", "MEDIUM", "B"), (2, None, "T", "B"), (2, "x", "ECONOMY", "C")]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string, o_orderstatus string",
            [(k, c, date(1999, 1, k), "P", "O") for k, c in ((1, 1), (2, 1), (2, 1), (3, 2), (4, 9), (5, None))],
        ),
        "lineitem": (
            "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double,"
            " l_tax double, l_linestatus string, l_returnflag string, l_shipdate date",
            [
                (o, n, p, 1, 3.0, 0.01, 0.02, status, flag, date(1999, 2, 1))
                for o, n, p, status, flag in (
                    (1, 1, 1, "F", "N"), (2, 1, 2, "O", "A"), (1, 2, 1, "F", "N"), (2, 2, 2, "O", "N"), (3, 1, 1, "F", "N"),
                    (3, 1, 7, "O", "N"), (3, 1, None, "O", "N"), (4, 1, 1, "F", "N"), (5, 1, 1, "F", "N"), (1, None, 1, "F", "N"),
                )
            ],
        ),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")


def test_state_of_items_meets_the_tasks_before_the_part_texts(spark, tmp_path):
    _order_tables(spark, tmp_path)
    found = tables.model_tasks(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    last, *others = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "p_partkey" in last and any("done" in line or "Item" in line for line in others)
    plain = spark.sql(tables.MODEL_TASKS)
    assert found.schema == plain.schema
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))
    assert {(r["Notification"], r["Item"], r["IsItemCompleted"]) for r in found.collect()} == {(1, 1, True), (1, 2, False), (2, 1, True)}


def test_work_orders_are_joined_once_for_all_sheets(spark, tmp_path):
    _order_tables(spark, tmp_path)
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(1, 5.0), (2, -5.0)], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    plain = {name: tables.sheet(spark, str(tmp_path), name) for name in tables.SHEETS}
    expected = {name: (rows.schema, sorted(map(repr, rows.collect()))) for name, rows in plain.items()}
    found = tables.sheets(spark, str(tmp_path))
    assert {name: (rows.schema, sorted(map(repr, rows.collect()))) for name, rows in found.items()} == expected
    assert len(expected["SAP_Raw_Extract"][1]) > 6
    for rows in loading.entity_sources(spark, str(tmp_path)).values():
        assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_record_sets_are_joined_narrow_with_the_same_rows(spark, tmp_path):
    _order_tables(spark, tmp_path)
    for name in ("nation", "customer", "part", "orders", "lineitem"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").createOrReplaceTempView(name)
    for name in ("LayoutProcessingTask", "LayoutType"):
        plain, narrow = spark.sql(tables.RECORDS[name]), spark.sql(tables.NARROW_RECORDS[name])
        assert narrow.schema.simpleString() == plain.schema.simpleString()
        assert sorted(map(repr, narrow.collect())) == sorted(map(repr, plain.collect())) != []
    moved = tables.NARROW_RECORDS["LayoutProcessingTask"]
    assert moved != tables.RECORDS["LayoutProcessingTask"] and "(orders o JOIN customer c" in moved


def test_landed_records_are_compressed_and_whole(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a\n\"b\""), (2, None), (3, "")], "k long, t string")
    path = str(tmp_path / "landed")
    tables.write_records(rows, path)
    assert glob.glob(f"{path}/*.json.gz") and not glob.glob(f"{path}/*.json")
    found = scans.scan_records(spark, path, "k long, t string")
    assert sorted(map(tuple, found.collect())) == [(1, "a\n\"b\""), (2, None), (3, "")]


def _record_sets(spark):
    """Tasks of keys as texts, of which some are the same number, some none; a notification with two programs."""
    fact = [
        ("1", "1", "a", "x", 1, "2001-01-01", "2001-01-02", "ring", 7), ("01", "1", "b", "x", 1, "2001-01-01", None, "medium", 7),
        ("1", "2", "c", "x", None, "1500-01-01", "2001-01-02", None, 8), (None, "2", "d", "x", 1, "2001-01-05", "2001-01-02", "t", 9),
        (None, "2", "d", "x", 1, "2001-01-05", "2001-01-02", "t", 9), ("n", None, "e", "x", 2, "bad", "1677-09-21", "t", None),
        ("2", "1", "f", "x", 2, "2001-01-01", "2001-01-02", "t", 7), ("02", "01", "g", "x", 2, "2001-01-01", "2001-01-02", "t", 7),
    ]
    names = "Notification string, Item string, LayoutTaskId string, Material string, TaskOwnerId int, Created_On string, Completed_On string, TaskText string, TaskCodeId int"
    rows = spark.createDataFrame(fact, names).withColumns({
        "Planned_Start": F.col("Created_On"), "Planned_Finish": F.col("Created_On"), "Task": F.lit("3"),
        **{c: F.lit(1) for c in ("SupplierVendorId", "TaskStatusId", "DamageCodeId", "CauseCodeId", "GroupCodeId", "CategoryId")},
    })
    one = {
        "SupplierVendor": "SupplierVendor", "TaskStatus": "TaskStatus", "GroupCode": "GroupCode", "CauseCode": "CauseCode",
        "DamageCode": "DamageCode", "Category": "Category",
    }
    found = {n: spark.createDataFrame([(1, n)], f"{n}Id int, {c} string") for n, c in one.items()}
    return {
        **found, "LayoutProcessingTask": rows,
        "TaskOwner": spark.createDataFrame([(1, "o"), (None, "none")], "TaskOwnerId int, TaskOwner string"),
        "EngineProgram": spark.createDataFrame([("1", 5, "E"), ("1", 6, None), ("02", 7, "F"), (None, 8, "G")], "Notification string, Coding int, Description string"),
        "TaskCode": spark.createDataFrame([(7, "SMALL", "hot", "R"), (8, "X", None, None), (7, "Y", "z", "A")], "TaskCodeId int, TaskCode string, TaskCodeText string, GroupCode string"),
        "GeneralCode": spark.createDataFrame([("r", "small", "r_small")], "Code_Group string, Task_Code string, General_Code string"),
    }


def test_staged_star_join_has_the_same_rows(spark):
    found = _record_sets(spark)
    found["TaskCode"] = cleaning.with_general_code(found["TaskCode"], found["GeneralCode"])
    plain, staged = cleaning.star_join(found), cleaning.star_join(found, staged=True)
    assert staged.columns == plain.columns
    assert sorted(map(repr, staged.collect())) == sorted(map(repr, plain.collect())) != []
    joins = [df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") for df in (plain, staged)]
    assert joins == [10, 9]  # one of them is that of the general codes


def test_cleaning_moves_the_fact_once_for_items_and_programs(spark):
    found = _record_sets(spark)
    codes = cleaning.with_general_code(found["TaskCode"], found["GeneralCode"])
    star = cleaning.star_join({**found, "TaskCode": codes})
    plain = cleaning.with_corrections(cleaning.with_tags(cleaning.typed(star, tables.RULES), tables.RULES), tables.RULES)
    cleaned = cleaning.clean(found, tables.RULES)
    assert sorted(cleaned.columns) == sorted(plain.columns)
    rows = sorted(map(repr, cleaned.select(*plain.columns).collect()))
    assert rows == sorted(map(repr, plain.collect())) and len(rows) > 8
    done = {(r["Notification"], r["Item"], r["IsItemCompleted"]) for r in cleaned.collect()}
    assert done == {(1, 1, False), (1, 2, True), (None, 2, True), (None, None, False), (2, 1, True)}
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 8 and "Aggregate" not in plan


def _labels(spark, run):
    """Names of the tables that ``run`` stores."""
    with job_scratch(spark):
        run()
        folder = scratch_path(spark, "x").rpartition("/")[0]
        return sorted(path.rpartition("/")[2].partition("-")[0] for path in glob.glob(f"{folder}/*"))


def test_staged_ids_are_the_same(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("b", 1), (None, 3), ("a", None)] * 3, "a string, b int")
    for distinct in (True, False):
        plain, staged = (ids.dense_ids(rows, ["a"], distinct, staged=s) for s in (False, True))
        assert sorted(map(repr, staged.collect())) == sorted(map(repr, plain.collect()))
    assert _labels(spark, lambda: ids.dense_ids(rows, ["a"], True, staged=True)) == ["distinct", "ids"]
    assert _labels(spark, lambda: extract.extract("Category", spark.createDataFrame([("c",)], "Category string"))) == ["distinct", "ids"]


def test_levels_of_vectors_stay_off_the_driver(spark):
    rows = spark.createDataFrame([(1, "b", 2), (2, "a", None), (3, None, 10), (4, "b", 2), (5, "", None)], "k int, v string, w int")
    model = impute.learn_vectors(rows, ["v", "w"])
    found = impute.one_hot_vectors(rows, model)
    assert "ml_attr" not in found.schema["features"].metadata and model.size == 5
    assert not any(isinstance(value, (list, dict)) for value in vars(model).values())
    level = {r["at"]: r["level"] for r in impute.vector_levels(found).collect()}
    assert level == {0: "v_", 1: "v_a", 2: "v_b", 3: "w_10", 4: "w_2"} and impute.vector_names(found) == list(level.values())
    got = sorted((r["k"], r["features"].size, [level[i] for i in r["features"].indices], list(r["features"].values)) for r in found.collect())
    assert got == [(1, 5, ["v_b", "w_2"], [1, 1]), (2, 5, ["v_a"], [1]), (3, 5, ["w_10"], [1]), (4, 5, ["v_b", "w_2"], [1, 1]), (5, 5, ["v_"], [1])]
    none = impute.one_hot_vectors(rows, impute.learn_vectors(rows.where("k > 5"), ["v"]))
    assert {r["features"].size for r in none.collect()} == {0} and impute.vector_names(none) == []
