import datetime as dt

from pyspark.sql import functions as F

from taskspark.functions import dates, texts

EDGES = {
    None: ("1677-09-21", None),
    "": ("1677-09-21", None),
    "nan": ("1677-09-21", None),
    "31-12-9999": ("2262-04-11", None),
    "1-1-7777": ("2262-04-11", None),
    "9999-12-31 00:00:00": ("9999-12-31", None),
    "2019-03-04 00:00:00": ("2019-03-04", "2019-03-04 00:00:00"),
    "2019-3-4 1:2:3": ("2019-03-04", "2019-03-04 01:02:03"),
    "2019/03/04": (None, "2019-03-04 00:00:00"),
    "2019-03-04": (None, "2019-03-04 00:00:00"),
    "2019-03-04T10:00:00": (None, "2019-03-04 10:00:00"),
    "2019-02-30 00:00:00": (None, None),
    "2019-03-04 25:00:00": (None, None),
    "1677-09-21": (None, None),
    "2262-04-11": (None, "2262-04-11 00:00:00"),
    "2262-04-12": (None, None),
    "2500-01-02": (None, None),
    "1999": (None, None),
    "1999-12": (None, None),
    "junk": (None, None),
}


def one_column(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {type_}")


def test_sentinel_and_read_dates(spark):
    df = one_column(spark, EDGES).withColumn("read", F.col("v"))
    df = df.withColumn("stored", dates.sentinel_date(F.col("v")))
    rows = dates.read_dates(df, ["read"]).withColumn("read", F.date_format("read", "yyyy-MM-dd HH:mm:ss"))
    assert {r["v"]: (r["stored"], r["read"]) for r in rows.collect()} == EDGES


def test_far_dates_stay_without_upper_bound(spark):
    df = one_column(spark, ["2500-01-02", "1677-09-21"])
    rows = dates.read_dates(df, ["v"], null_out_of_range=False).collect()
    assert [r["v"] for r in rows] == [dt.datetime(2500, 1, 2), None]


def test_typed_dates_are_taken_as_they_are(spark):
    df = one_column(spark, [dt.date(2019, 3, 4), None], "date")
    assert [r["v"] for r in dates.read_dates(df, ["v"]).collect()] == [dt.datetime(2019, 3, 4), None]


def test_life_date_text(spark):
    df = one_column(spark, ["31-12-9999", "01-02-2019", None])
    rows = df.select(dates.life_date_text(F.col("v")).alias("v")).collect()
    assert [r["v"] for r in rows] == ["11-04-2262", "01-02-2019", None]


def test_whole_days_round_down(spark):
    start = dt.datetime(2020, 3, 1, 12)
    ends = [start + dt.timedelta(hours=h) for h in (-25, -24, -1, 0, 1, 23, 24, 49)]
    df = spark.createDataFrame([(start, e) for e in ends], "a timestamp_ntz, b timestamp_ntz")
    rows = df.select(dates.day_span(F.col("a"), F.col("b")).alias("d")).collect()
    assert [r["d"] for r in rows] == [(e - start).days + 1 for e in ends]


def test_days_count_parts_of_a_second(spark):
    a, b = dt.datetime(2020, 1, 1, 0, 0, 0, 5), dt.datetime(2020, 1, 2, 0, 0, 0, 4)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(dates.whole_days(F.col("a"), F.col("b"))).first()[0] == 0


def test_contains_any_and_null(spark):
    df = one_column(spark, ["TurnBack now", "RETURNED", "x", None])
    rows = df.select(texts.contains_any(F.col("v"), ("turnback", "return")).alias("f")).collect()
    assert [r["f"] for r in rows] == [True, True, False, False]


def test_fold_keep_family(spark):
    df = one_column(spark, ["PT6A-1", "pw100", "zz", None])
    rows = df.select(
        texts.fold_case(F.col("v")).alias("low"),
        texts.keep_listed(F.col("v"), ("zz",)).alias("kept"),
        texts.engine_family(F.lower("v")).alias("family"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("pt6a-1", "other", "pt6"), ("pw100", "other", "pw1"), ("zz", "zz", "zz"), ("nan", "other", None),
    ]


def test_int_or_na_by_type(spark):
    df = spark.createDataFrame([("a", 1.9), (None, None), ("7.5", -2.0)], "s string, n double")
    rows = df.select(texts.int_or_na(df, "s").alias("s"), texts.int_or_na(df, "n").alias("n")).collect()
    assert [tuple(r) for r in rows] == [("a", "1"), ("NA", "NA"), ("7.5", "-2")]


def test_missing_flag_is_true(spark):
    df = one_column(spark, [0, 1, None], "int")
    assert [r[0] for r in df.select(texts.to_flag(F.col("v"))).collect()] == [False, True, True]


def test_cast_columns_gives_null_for_what_does_not_fit(spark):
    df = one_column(spark, ["10", "x", "", None])
    rows = texts.cast_columns(df, {"v": "bigint"}).collect()
    assert [r["v"] for r in rows] == [10, None, None, None]
