"""Cleaning rules, features, fill values, sequences."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from taskspark import vocab
from taskspark.operators import cleaning as cl
from taskspark.operators import features as ft
from taskspark.operators import impute, sequences

DAY = dt.datetime
TASK = (
    "id int, Notification int, Item int, Task int, TaskCode string, GroupCode string, TaskCodeText string,"
    " TaskText string, Created_On timestamp_ntz, Completed_On timestamp_ntz, Planned_Start timestamp_ntz,"
    " Planned_Finish timestamp_ntz"
)
EARLY, LATE, FAR = DAY(2020, 1, 1), DAY(2020, 2, 1), DAY(2500, 1, 2)
# text code, task text, created, completed, planned finish -> created, completed, available
CASCADE = [
    (("x", "x", EARLY, LATE, LATE), (EARLY, LATE, 1)),
    (("please DELETE", "buffer", EARLY, LATE, LATE), (EARLY, LATE, 0)),
    (("x", "No Demand", LATE, EARLY, FAR), (LATE, EARLY, 0)),
    (("x", "Buffer", LATE, EARLY, LATE), (LATE, LATE, 1)),
    (("Expiry", "x", EARLY, None, LATE), (EARLY, EARLY, 1)),
    (("x", "x", EARLY, None, FAR), (EARLY, EARLY, 1)),
    (("x", "x", LATE, EARLY, LATE), (EARLY, EARLY, 1)),
    (("x", "x", LATE, None, None), (LATE, None, 1)),
    ((None, "inactive", EARLY, LATE, LATE), (EARLY, LATE, 1)),
    ((None, None, LATE, EARLY, LATE), (EARLY, EARLY, 1)),
]


def tasks(spark):
    rows = [
        (n, 1, n, 1, "c", "g", code, text, created, done, None, finish)
        for n, ((code, text, created, done, finish), _) in enumerate(CASCADE)
    ]
    return spark.createDataFrame(rows, TASK)


def test_first_rule_that_fits_decides(spark):
    got = cl.with_corrections(tasks(spark)).orderBy("id").collect()
    assert [(r["Created_On"], r["Completed_On"], r["Available"]) for r in got] == [want for _, want in CASCADE]


def test_tags_come_from_dates_before_correction(spark):
    got = cl.with_corrections(cl.with_tags(tasks(spark))).orderBy("id").collect()
    assert [r["IsTaskCompleted"] for r in got] == [c[0][3] is not None for c in CASCADE]


def test_item_is_completed_when_all_tasks_are(spark):
    rows = [(1, 1, LATE), (1, 1, None), (1, 2, LATE), (None, 1, LATE), (None, 1, LATE)]
    df = spark.createDataFrame(rows, "Notification int, Item int, Completed_On timestamp_ntz")
    got = {(r[0], r[1], r[3]) for r in cl.with_item_completed(df).select("Notification", "Item", "Completed_On", "IsItemCompleted").collect()}
    assert got == {(1, 1, False), (1, 2, True), (None, 1, True)}
    assert cl.with_item_completed(df).count() == len(rows)


def test_planning_ignores_case_unless_told(spark):
    rows = [("TKAT", "X"), ("0040", "FLAYOUT"), ("0040", "flayout"), ("0040", "x"), (None, "flayout"), ("z", None)]
    df = spark.createDataFrame(rows, "TaskCode string, GroupCode string")
    both = [r["IsPlanning"] for r in cl.with_planning_flag(df).collect()]
    literal = [r["IsPlanning"] for r in cl.with_planning_flag(df, cl.CleaningRules(literal_case=True)).collect()]
    assert both == [True, True, True, False, False, False]
    assert literal == [False, False, True, False, False, False]


def test_general_code(spark):
    codes = spark.createDataFrame([(1, "Ab", "g", "t"), (2, None, "G", "t")], "TaskCodeId int, TaskCode string, GroupCode string, TaskCodeText string")
    general = spark.createDataFrame([("g", "ab", "gen")], "Code_Group string, Task_Code string, General_Code string")
    got = cl.with_general_code(codes, general).orderBy("TaskCodeId").select("TaskCode", "GroupCode", "GeneralCode").collect()
    assert [tuple(r) for r in got] == [("AB", "G", "gen"), ("NAN", "G", None)]


MODEL = (
    "Id int, Notification int, Item int, Task int, Material string, Created_On string, Completed_On string,"
    " Planned_Start string, Planned_Finish string, TaskText string, TaskCodeText string, TaskStatus string,"
    " TaskOwner string, SupplierVendor int, DamageCode double, CauseCode string, Engine string, IsTurnback int,"
    " IsLife int, IsPlanning boolean, IsTaskCompleted boolean, IsItemCompleted boolean, Category string,"
    " Coding string, GeneralCode string"
)


def model_row(id, item, task, created, owner="bob", done="2020-03-01", code="Eval and PCE", month=None):
    return (
        id, 1, item, task, "M", created, done, None, None, "T", code, "S", owner, 7965, 10.0, None, "PT6", 1, None,
        False, done is not None, done is not None, "Vane", "Z010", "G",
    )


def test_features(spark):
    rows = [
        model_row(1, 1, 2, "2020-01-01T10:00:00"), model_row(2, 1, 4, "2020-01-03T09:00:00", owner="Diana"),
        model_row(3, 1, 0, "2020/07/05", owner=None), model_row(4, 2, 1, None, done=None),
    ]
    got = ft.task_duration(ft.features(spark.createDataFrame(rows, MODEL))).orderBy("Id").collect()
    pick = [(r["DaysFromItemStart"], r["DaysPerTask"], r["TaskOwnerExperience"], r["TaskDuration"]) for r in got]
    assert pick == [(1, 0.5, 2, 59), (2, 0.5, 0, 57), (186, None, 0, -126), (None, None, 2, None)]
    one = got[0].asDict()
    assert (one["SupplierVendor"], one["DamageCode"], one["CauseCode"], one["Engine"]) == ("7965", "10", "nan", "pt6")
    assert (one["IsEval"], one["IsPCE"], one["IsExpiry"], one["IsLife"], one["IsTurnback"]) == (True, True, False, True, True)
    assert one["TaskCreatedMonth"] == "1" and one["Seasonality"] == pytest.approx(0.8660254)
    assert got[3]["TaskCreatedMonth"] == "na" and got[3]["Seasonality"] is None
    assert "TaskCodeText" not in one and "TaskOwner" not in one


def test_matrix_has_the_selected_features_in_order(spark):
    df = ft.features(spark.createDataFrame([model_row(1, 1, 2, "2020-07-01")], MODEL))
    fills = impute.medians(df, ft.number_features(df, vocab.SELECTED_FEATURES))
    matrix = ft.feature_matrix(df, fills)
    assert tuple(matrix.columns) == vocab.SELECTED_FEATURES and len(matrix.columns) == 42
    row = matrix.first().asDict()
    on = {c for c, v in row.items() if v == 1.0 and "_" in c}
    assert on == {"SupplierVendor_7965", "DamageCode_10", "TaskCreatedMonth_7", "Category_vane", "Coding_z010", "TaskCreatedQuarter_3"}
    assert row["IsEval_False"] == 0.0
    assert ft.as_vector(matrix).first()["features"].size == 42


def test_owner_counts_survive_a_hot_owner(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("o"), F.col("id").cast("string"))).alias("TaskOwner"))
    got = ft.with_owner_experience(df).groupBy("TaskOwnerExperience").count().collect()
    assert {tuple(r) for r in got} == {(334, 334), (1, 666)}


@pytest.mark.parametrize("n", [1, 2, 999, 5000])
def test_medians_are_exact(spark, n):
    draw = random.Random(n)
    rows = [
        (draw.randint(0, 9) * 1.0, draw.random(), None if k % 3 else draw.gauss(0, 5), 4.0, k % 2 * 1.0, 1e308, -0.5 * (k < n // 2))
        for k in range(n)
    ]
    names = "abcdefg"
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(7)
    got = impute.medians(df, list(names))
    for at, name in enumerate(names):
        values = [r[at] for r in rows if r[at] is not None]
        want = 1e308 if name == "f" else statistics.median(values)  # the sum of two would be infinite
        assert got[name] == want


def test_medians_of_many_rows_in_small_partitions(spark):
    """What a bracket by values alone could not split: one value holds the middle, or two do."""
    n = 300_001
    df = spark.range(n).repartition(16).select(
        (F.col("id") % 2).alias("flag"), F.lit(3).alias("same"),
        F.when(F.col("id") < n // 3, F.lit(0)).when(F.col("id") < 2 * n // 3, F.lit(5)).otherwise(F.col("id")).alias("third"),
        F.col("id").alias("plain"), F.when(F.col("id") % 2 == 0, F.lit(1.0)).otherwise(F.lit(2.0)).alias("two"),
    )
    assert impute.medians(df, df.columns) == {"flag": 0.0, "same": 3.0, "third": 5.0, "plain": (n - 1) / 2, "two": 1.0}
    even = df.where(f"plain < {n - 1}")
    assert impute.medians(even, ["flag", "plain"]) == {"flag": 0.5, "plain": (n - 2) / 2}


def test_values_at_places(spark):
    draw = random.Random(5)
    values = [draw.randint(-50, 50) for _ in range(2_000)] + [7] * 5_000
    df = spark.createDataFrame([(v, str(v)) for v in values] + [(None, None)] * 9, "v long, t string").repartition(9)
    places = [0, 1, 1, 3_000, len(values) - 1]
    assert impute.order_values(df, {"v": places}) == {"v": [sorted(values)[p] for p in places]}
    texts = sorted(map(str, values))
    assert impute.order_values(df.select("t"), {"t": places}) == {"t": [texts[p] for p in places]}
    with pytest.raises(IndexError):
        impute.order_values(df, {"v": [len(values)]})


def test_no_median_without_values(spark):
    assert impute.medians(spark.createDataFrame([(None,)], "a double"), ["a"]) == {}


def test_lowest_mode_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert impute.modes(df, ["v"]) == {"v": "a"}


def test_one_hot_of_unknown_is_all_zero(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    got = impute.one_hot(df, {"v": ["a", "b"]}).collect()
    assert [tuple(r) for r in got] == [(1, 0), (0, 0), (0, 0)]
    assert impute.learn_levels(df, ["v"]) == {"v": ["a", "z"]}


def test_one_hot_vectors_of_many_levels(spark, tmp_path):
    train = spark.range(6_000).select(F.format_string("v%04d", F.col("id") % 5_000).alias("v"), (F.col("id") % 3).alias("w"))
    model = impute.learn_vectors(train, ["v", "w"])
    path = str(tmp_path / "levels")
    model.save(path)
    rows = spark.createDataFrame([("v0000", 0, 1), ("v4999", 2, 2), ("new", None, 3), (None, 1, 4)], "v string, w long, k int")
    found = impute.one_hot_vectors(rows, type(model).load(path))
    assert found.columns == ["k", "features"]
    names = impute.vector_names(found)
    assert len(names) == 5_003 and names[:2] == ["v_v0000", "v_v0001"] and names[-3:] == ["w_0", "w_1", "w_2"]
    got = {r["k"]: r["features"] for r in found.collect()}
    assert {k: [names[i] for i in v.indices] for k, v in got.items()} == {1: ["v_v0000", "w_0"], 2: ["v_v4999", "w_2"], 3: [], 4: ["w_1"]}
    assert all(v.size == 5_003 and set(v.values) <= {1.0} for v in got.values())


SEQ = "Notification int, Item string, Task int, Id int, TaskCode string, LayoutId int"


def test_pairs_compare_keys_as_text(spark):
    rows = [(1, "9", 1, 1, "A", 9), (1, "10", 2, 3, "B", 10), (1, "10", 1, 2, "A", 10), (2, "5", 1, 4, "A", 5), (1, "2", 1, 5, None, 2)]
    found = sequences.item_sequences(spark.createDataFrame(rows, SEQ), ("Task", "Id"))
    pairs = sequences.sequence_pairs(found).orderBy("layout_ref").collect()
    assert [(r["Notification"], r["layout_ref"], r["layout_test"], r["Seq1"], r["Seq2"]) for r in pairs] == [
        (1, "10", "9", ["A", "B"], ["A"]), (1, "2", "9", ["nan"], ["A"]),
    ]


def test_similarity_is_sorted_and_whole(spark):
    rows = [(1, str(i), t, 10 * i + t, c, i) for i, s in enumerate(["ABCD", "ABXD", "XYZ", "ABCD"]) for t, c in enumerate(s)]
    df = spark.createDataFrame(rows, SEQ)
    got = sequences.similarity_by_ref(df, ("Task", "Id"), 1).collect()
    assert [(r["layout_ref"], round(r["Score"], 6)) for r in got] == [("0", 1.0), ("1", 0.8), ("2", 0.0)]
    assert sequences.similarity(df, ("Task", "Id")).count() == 3


def test_code_names(spark):
    tasks_ = spark.createDataFrame([(1,), (2,)], "TaskCodeId int")
    codes = spark.createDataFrame([(1, "A")], "TaskCodeId int, TaskCodeName string")
    assert {tuple(r) for r in sequences.with_code_names(tasks_, codes).collect()} == {(1, "A"), (2, "nan")}
