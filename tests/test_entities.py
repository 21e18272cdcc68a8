"""Extraction, ids, keys, sinks and loads on hand-made rows."""

from collections import Counter
from dataclasses import replace
from itertools import product

import pytest
from pyspark.sql import functions as F

from taskspark.operators import extract as ex
from taskspark.operators import ids
from taskspark.operators.keys import Lookup, choices, new_rows, resolve, resolved, unresolved, without_partner
from taskspark.plans import jobs, load
from taskspark.plans.entities import ENTITIES
from taskspark.session import path_exists, scratch_path
from taskspark.sources import scans, sinks
from taskspark.sources.tables import Tables, query


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def ranked(rows):
    """Rows in order, nulls last, numbered from 1."""
    return [(n, *r) for n, r in enumerate(sorted(rows, key=lambda r: [(v is None, v or "") for v in r]), 1)]


ITEMS = [("10", "2"), ("9", None), (None, "1"), ("10", "1"), ("10", "2"), ("", "x"), ("10", "2"), (None, "1")]


@pytest.mark.parametrize("partitions", [1, 8])
@pytest.mark.parametrize("hot", [1, 2, 65_536])
def test_dense_ids_keep_copies(spark, monkeypatch, partitions, hot):
    monkeypatch.setattr(ids, "HOT_COPIES", hot)
    df = spark.createDataFrame(ITEMS, "a string, b string").repartition(partitions)
    assert sorted(rows_of(ids.dense_ids(df, ["a"], distinct=False))) == ranked(ITEMS)


@pytest.mark.parametrize("partitions", [1, 8])
def test_dense_ids_distinct(spark, partitions):
    df = spark.createDataFrame(ITEMS, "a string, b string").repartition(partitions)
    assert sorted(rows_of(ids.dense_ids(df, ["b"], distinct=True).select("Id", "b", "a"))) == ranked(
        {(b, a) for a, b in ITEMS}
    )


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(0, 20_000, 1, 13).select(F.hash("id").cast("string").alias("v"))
    got = ids.dense_ids(df, ["v"], distinct=False).orderBy("Id").collect()
    assert [r["Id"] for r in got] == list(range(1, 20_001))
    assert [r["v"] for r in got] == sorted(r["v"] for r in got)


def test_extract_needs_all_columns_and_blanks_only_the_task_sheet(spark):
    tasks = spark.createDataFrame([("G", None), ("G", None)], "`Code group` string, `Task group text` string")
    assert rows_of(ex.extract("GroupCode", tasks)) == [(1, "G", "")]
    assert ex.extract("TaskCode", tasks) is None
    damage = spark.createDataFrame(
        [("0010", None), ("10", "x"), (None, None)], "`Damage Code` string, `Prob. code text` string"
    )
    assert sorted(rows_of(ex.extract("DamageCode", damage))) == [(1, "0010", None), (2, "10", "x"), (3, None, None)]


def test_split_sheets_passes_over_unknown_sheets(spark):
    sheet = spark.createDataFrame([("a", "c")], "Description string, Category string")
    assert set(ex.split_sheets({"CATEGORIES": sheet, "Notes": sheet})) == {"Category"}


def test_new_rows_match_null_and_keep_source_copies(spark):
    source = spark.createDataFrame(
        [(None, "a", 1), (None, "b", 2), ("x", None, 3), ("x", "a", 4), ("x", "a", 5)], "k string, l string, n int"
    )
    loaded = spark.createDataFrame([(None, "a"), ("x", None), ("x", None)], "k string, l string")
    assert sorted(r[2] for r in rows_of(new_rows(source, loaded, ["k", "l"]))) == [2, 4, 5]


def test_new_rows_compare_as_text(spark):
    source = spark.createDataFrame([("1",), ("01",)], "k string")
    loaded = spark.createDataFrame([(1,)], "k int")
    assert rows_of(new_rows(source, loaded, ["k"])) == [("01",)]


def test_resolve_splits_and_adds_nothing(spark):
    source = spark.createDataFrame([("a", "p", 1), ("z", "p", 2), ("a", "q", 3), (None, None, 4)], "k string, l string, n int")
    dim_k = spark.createDataFrame([(7, "a"), (8, "unused")], "Id int, code string")
    dim_l = spark.createDataFrame([(5, "p")], "Id int, l string")
    marked = resolve(
        source, [(Lookup("K", {"k": "code"}, "k_id"), dim_k), (Lookup("L", {"l": "l"}, "l", required=False), dim_l)]
    )
    assert sorted(rows_of(resolved(marked).select("n", "k_id", "l"))) == [(1, 7, 5), (3, 7, None)]
    assert sorted(rows_of(unresolved(marked).select("n", "key_k", "reject_reason"))) == [(2, "z", "no K"), (4, None, "no K")]


def test_lookup_with_two_texts_gives_a_row_each(spark):
    source = spark.createDataFrame([("a",)], "k string")
    dim = spark.createDataFrame([(1, "a"), (2, "a")], "Id int, k string")
    assert sorted(rows_of(resolved(resolve(source, [(Lookup("K", {"k": "k"}, "k"), dim)])))) == [(1,), (2,)]


def test_without_partner(spark):
    left = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "c")], "k string, v string")
    right = spark.createDataFrame([("1", 9), ("3", 8)], "k string, w int")
    got = rows_of(without_partner(left, right, ["k"]).select("k", "v", "w", "side"))
    assert Counter(got) == Counter([("2", "b", None, "left"), (None, "c", None, "left"), ("3", None, 8, "right")])


def test_lookup_that_takes_the_least_of_several_ids(spark):
    source = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([(2, "a", "x"), (1, "a", "y"), (5, "b", "z"), (9, None, "u"), (8, None, "u")], "Id int, k string, t string")
    look = Lookup("K", {"k": "k"}, "k", several=True)
    assert sorted(rows_of(resolved(resolve(source, [(look, dim)])))) == [(1,), (1,), (5,)]
    assert sorted(rows_of(choices(look, dim))) == [(1, "a", "y", 1), (2, "a", "x", 1)]


def test_mark_rejects_keeps_every_row(spark):
    rows = [("a", "1", "x"), ("a", "1", "x"), ("a", "2", "y"), ("b", "no", "z"), ("b", None, "z"), ("c", "3", None)]
    df = spark.createDataFrame(rows, "k string, n string, t string")
    types = {"n": "int"}
    marked = sinks.mark_rejects(df, required=("t",), types=types, unique=("k",))
    assert sorted(rows_of(sinks.stored(marked, types)), key=str) == [("a", 1, "x"), ("b", None, "z")]
    assert sorted(rows_of(sinks.rejected(marked)), key=str) == [
        ("a", "1", "x", "duplicate key", 1), ("a", "2", "y", "duplicate key", 1),
        ("b", "no", "z", "cast n", 1), ("c", "3", None, "null t", 1),
    ]
    assert marked.agg(F.sum("copies")).first()[0] == len(rows)


def test_entity_file_round_trip(spark):
    path = scratch_path(spark, "file")
    assert not sinks.write_entity(spark.createDataFrame([], "Id int, a string"), path)
    df = spark.createDataFrame([(1, "0010", 'say "x;y"'), (2, "", None)], "Id int, a string, b string")
    assert sinks.write_entity(df, path)
    assert sorted(rows_of(scans.scan_entity(spark, path, ["a", "b"]))) == [("", None), ("0010", 'say "x;y"')]
    assert not sinks.write_entity(df.limit(0), path) and not path_exists(spark, path)


AWKWARD = [
    "a", "", None, " outer ", "\t", "\n", 'q"uote', '";";', "a;b", "l1\nl2", "l1\r\nl2", "cr\rx", "back\\slash", '\\"',
    "\\", '"', '""', "ends\\", "#x", "null", "-", ",", "'", 'x"', " ", "\ufeffx", "0010", "\\N", "é\U0001f600",
]


@pytest.mark.parametrize("rows_per_file", [1, 1_000])
def test_texts_come_back_as_they_were(spark, rows_per_file):
    path = scratch_path(spark, "file")
    rows = [(n, a, b) for n, (a, b) in enumerate(product(AWKWARD, [None, "", ' "x;\n', "z"]))]
    assert sinks.write_entity(spark.createDataFrame(rows, "Id long, a string, b string").coalesce(2), path, rows_per_file)
    got = rows_of(scans.scan_entity(spark, path, ["a", "b"]))
    assert Counter(got) == Counter(r[1:] for r in rows)


def test_sheets_keep_their_cells(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes(b'a,b\r\n" x ","l1\r\nl2"\r\n,""\r\n"say ""hi""",0010 \r\n')
    got = rows_of(scans.scan_sheets(spark, {"s": str(tmp_path / "s.csv")})["s"])
    assert got == [(" x ", "l1\nl2"), (None, ""), ('say "hi"', "0010 ")]


BODIES = [
    '{"a": 1, "b": "x"}', '[{"a": 2, "b": "y"}, {"a": "n/a"}]', '{"a": 1,', "5", '[1, {"a": "3"}]', "", "  ", "[]", '{"a": {"z": 1}}',
    '{"a": null}', "null", "[null]", "<html>", '{"a": 1}{"a": 2}', '{"a": 1}, {"a": 2}', '[{"a": 1},', '{"A": 5}',
    '{"a": 1, "a": 2}', '  [ {"a": 7, "more": []} ] ', '{"a": 1.5}', '{"b": "é \\" ;"}',
]


def test_every_record_is_good_or_rejected(spark, tmp_path):
    (tmp_path / "r.json").write_text("\n".join(BODIES))
    rows = scans.scan_records_marked(spark, str(tmp_path / "r.json"), "a bigint, b string")
    good = rows.where("reject_reason IS NULL").select("a", "b", "record")
    assert Counter(rows_of(good)) == Counter(
        [(1, "x", None), (2, "y", None), (3, None, None), (None, None, None), (None, None, None), (7, None, None), (None, 'é " ;', None)]
    )
    bad = rows.where("reject_reason IS NOT NULL")
    assert Counter(rows_of(bad.select("reject_reason"))) == {
        ("cast a",): 3, ("not JSON",): 6, ("no object",): 4
    }
    assert rows_of(bad.where("a IS NOT NULL OR b IS NOT NULL")) == [] and {r["record"] for r in bad.collect()} >= {"<html>", "[{\"a\": 1},"}
    for columns in (["a"], ["b"], ["a", "b"], []):
        assert scans.scan_records(spark, str(tmp_path / "r.json"), "a bigint, b string").select(*columns).count() == 7


def test_whole_files_as_bodies(spark, tmp_path):
    (tmp_path / "one.json").write_text('[\n {"a": 1,\n  "b": "x"},\n {"a": 2}\n]\n')
    (tmp_path / "two.json").write_text('{\n "a": 3\n}')
    got = rows_of(scans.scan_records(spark, str(tmp_path), "a int, b string", whole_files=True))
    assert sorted(got, key=str) == [(1, "x"), (2, None), (3, None)]
    with pytest.raises(ValueError):
        scans.scan_records(spark, str(tmp_path), "a array<int>")


def test_records_that_are_missing_or_broken(spark, tmp_path):
    assert scans.scan_records(spark, str(tmp_path / "none"), "a int").count() == 0
    (tmp_path / "r.json").write_text('{"a": 1}\n<html>\n{"a": 2}\n')
    assert sorted(rows_of(scans.scan_records(spark, str(tmp_path / "r.json"), "a int"))) == [(1,), (2,)]


def test_missing_sheet_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scans.scan_sheets(spark, {"x": str(tmp_path / "none")})


def test_runs_are_appended(spark):
    path = scratch_path(spark, "runs")
    df = spark.createDataFrame([(1,), (2,)], "a int")
    for day in ("d1", "d2", "d1"):
        sinks.write_run(df, path, day)
    assert Counter(r["run_date"] for r in spark.read.parquet(path).collect()) == {"d1": 4, "d2": 2}


def test_sql_over_frames(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert rows_of(query(spark, "SELECT sum(a) FROM {t}", t=df)) == [(3,)]


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS etl")
    store = Tables(spark)
    assert not store.exists("Fresh")
    store.append(spark.createDataFrame([(1,)], "a int"), "Fresh")
    store.append(spark.createDataFrame([(2,)], "a int"), "Fresh")
    assert store.exists("Fresh") and sorted(rows_of(store.read("Fresh"))) == [(1,), (2,)]
    spark.sql("DROP TABLE etl.Fresh")


SAP = (
    "Notification string, Item string, Task string, Material string, Description string, `Created On` string,"
    " `Completed On` string, `Task text` string, `Code group` string, `Task group text` string,"
    " `Task code` string, `Task code text` string, `Planned start` string, `Planned finish` string,"
    " `Supplier Vendor` string, `Task Owner` string, `Task Status` string, CATEGORY string"
)


def sap_row(notification, item, task, created="2020-01-01 00:00:00", supplier="7", owner="ann"):
    return (
        notification, item, task, "m1", "blade", created, None, "text", "g", "group", "0010", "inspect",
        "2020-01-02 00:00:00", "31-12-9999", supplier, owner, "open", "vane",
    )


@pytest.fixture
def sheets(spark, tmp_path):
    items = "Notification string, `Sort number` string, Text string, `Damage Code` string, `Prob. code text` string, `Cause code` string, `Cause code text` string"
    frames = {
        "LayoutType": spark.createDataFrame(
            [("1", "1", "t", "10", "crack", "L1", "heat"), ("1", "2", "t", "10", "crack", None, None), ("2", "9", "t", None, None, "L1", "heat")], items
        ),
        "PWC_EngineProgram": spark.createDataFrame(
            [("1", "Z010", "new", "PT6"), ("2", "Z020", "used", "PW1")],
            "Notification string, Coding string, `Coding code txt` string, Description string",
        ),
        "SAP_Raw_Extract": spark.createDataFrame(
            [sap_row("1", "1", "1"), sap_row("1", "1", "2", owner=None), sap_row("1", "2", "1", created="junk"), sap_row("3", "1", "1")], SAP
        ),
        "Categories": spark.createDataFrame([("blade", "vane")], "Description string, Category string"),
        "Notes": spark.createDataFrame([("x",)], "a string"),
    }
    paths = {}
    for name, df in frames.items():
        paths[name] = str(tmp_path / "raw" / name)
        df.write.option("header", True).csv(paths[name])
    return paths


def test_split_then_import_twice(spark, sheets, tmp_path):
    folder, failed = str(tmp_path / "processed"), str(tmp_path / "failed")
    assert set(jobs.split_raw(spark, sheets, folder)) == set(ENTITIES)
    store = Tables(spark, str(tmp_path / "tables"))
    first = jobs.import_entities(spark, folder, store, failed)
    assert first == {
        "GroupCode": 1, "CodingCode": 2, "DamageCode": 2, "CauseCode": 2, "TaskOwner": 2, "TaskStatus": 1,
        "SupplierVendor": 1, "Category": 1, "TaskCode": 1, "Material": 1, "EngineProgram": 2,
        "LayoutType": 3, "LayoutTask": 2,
    }
    rejects = spark.read.option("header", True).option("sep", ";").csv(f"{failed}/Failed_LayoutTask").collect()
    assert Counter(r["reject_reason"] for r in rejects) == {"no LayoutType": 1, "bad date Created_On": 1}
    assert "junk" in {r["Created_On"] for r in rejects}
    lonely = spark.read.option("header", True).option("sep", ";").csv(f"{failed}/Failed").collect()
    assert Counter((r["side"], r["Notification"], r["Item"]) for r in lonely) == {("task", "3", "1"): 1, ("item", "2", "9"): 1}
    stored = store.read("LayoutProcessingTasks").orderBy("Task_Id").collect()
    assert [(r["Created_On"], r["Completed_On"], r["Planned_Finish"]) for r in stored] == [("2020-01-01", "1677-09-21", "2262-04-11")] * 2
    assert set(jobs.import_entities(spark, folder, store, failed).values()) == {0}
    for entity in ENTITIES.values():
        found = [r["Id"] for r in store.read(entity.table).select("Id").collect()]
        assert len(found) == len(set(found)) == first[entity.name]


def test_every_row_is_stored_known_or_rejected(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "tables"))
    owners = spark.createDataFrame([("ann",), ("ann",), (None,), ("bob",)], "TaskOwner string")
    entity = ENTITIES["TaskOwner"]
    first = load.load_entity(entity, owners, store)
    assert (first.rows, first.known, first.rejected) == (3, 0, 1)
    assert rows_of(first.rejects) == [("ann", "duplicate key", 1)]
    more = owners.union(spark.createDataFrame([("cyd",)], "TaskOwner string"))
    again = load.load_entity(entity, more, store)
    assert (again.rows, again.known, again.rejected) == (1, 4, 0) and again.rejects.count() == 0
    assert sorted(r["TaskOwner_Id"] for r in store.read("TaskOwner").collect()) == ["", "ann", "bob", "cyd"]
    assert store.read("TaskOwner").select("Id").distinct().count() == 4


def test_a_value_of_the_wrong_type_is_a_reject(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "tables"))
    entity = replace(ENTITIES["CodingCode"], types={"Coding": "int"})
    rows = spark.createDataFrame([("1", "a"), ("x", "b"), ("2", "c")], "Coding string, CodingText string")
    done = load.load_entity(entity, rows, store)
    assert (done.rows, done.rejected) == (2, 1)
    assert rows_of(done.rejects.select("Coding", "reject_reason")) == [("x", "cast Coding")]
    assert dict(store.read("CodingCode").dtypes)["Coding"] == "int"


def test_a_task_whose_code_has_two_texts_is_stored_once(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "tables"))
    sources = {
        "GroupCode": spark.createDataFrame([("g", "G")], "GroupCode string, GroupText string"),
        "TaskCode": spark.createDataFrame([("c", "one", "g"), ("c", "two", "g")], "TaskCode string, TaskCodeText string, GroupCode string"),
    }
    load.load_all(sources, store)
    look = next(x for x in ENTITIES["LayoutTask"].lookups if x.entity == "TaskCode")
    dim = load.dimension(store, "TaskCode")
    task = spark.createDataFrame([("c", "g", 1)], "TaskCode string, GroupCode string, n int")
    assert resolve(task, [(look, dim)]).count() == 1
    assert {r["TaskCodeText"] for r in choices(look, dim).collect()} == {"one", "two"}


def test_loading_nothing(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "tables"))
    none = spark.createDataFrame([], "TaskOwner string")
    done = load.load_entity(ENTITIES["TaskOwner"], none, store)
    assert (done.rows, done.known, done.rejected) == (0, 0, 0) and store.read("TaskOwner").columns == ["Id", "TaskOwner_Id"]
    assert load.load_entity(ENTITIES["TaskOwner"], none, store).rows == 0


def test_expansions_give_back_the_keys(spark, sheets, tmp_path):
    folder = str(tmp_path / "processed")
    jobs.split_raw(spark, sheets, folder)
    store = Tables(spark, str(tmp_path / "tables"))
    jobs.import_entities(spark, folder, store, str(tmp_path / "failed"))
    items = load.expand_item(*[store.read(t) for t in ("LayoutType", "EngineProgram", "CodingCode", "CauseCode", "DamageCode")])
    got = items.select("Notification", "Item_Number", "Description", "CodingCode", "CodingText", "CauseText", "DamageText")
    assert sorted(rows_of(got)) == [
        ("1", "1", "PT6", "Z010", "new", "heat", "crack"), ("1", "2", "PT6", "Z010", "new", "", "crack"),
        ("2", "9", "PW1", "Z020", "used", "heat", ""),
    ]
    codes = load.expand_taskcode(store.read("TaskCode"), store.read("CodeGroup")).drop("Id")
    assert rows_of(codes) == [("0010", "inspect", "g", "group")]
    materials = load.expand_material(store.read("Material"), store.read("Category")).drop("Id")
    assert rows_of(materials) == [("m1", "blade", "vane")]
