"""Readers. Every schema is declared: no inference pass, and codes such as ``0010`` keep zeros."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taskspark import vocab
from taskspark.session import path_exists
from taskspark.sources.cells import read_options

MARKS = [T.StructField("reject_reason", T.StringType()), T.StructField("record", T.StringType())]


def scan_sheets(spark: SparkSession, paths: Mapping[str, str], line_breaks: bool = True) -> dict[str, DataFrame]:
    """Raw sheets by name, every cell text, outer blanks and line breaks kept. An empty cell is null, a quoted
    empty one blank. A missing file raises."""
    reader = spark.read.option("inferSchema", False).options(**read_options(line_breaks))
    return {sheet: reader.csv(path) for sheet, path in paths.items()}


def scan_entity(spark: SparkSession, path: str, columns: list[str], line_breaks: bool = True) -> DataFrame:
    """``;`` file of one entity with its ``Id`` left out; all other columns are text, as ``write_entity`` had it."""
    schema = T.StructType(
        [T.StructField("Id", T.LongType())] + [T.StructField(c, T.StringType()) for c in columns]
    )
    reader = spark.read.schema(schema).option("sep", ";").options(**read_options(line_breaks))
    return reader.csv(path).drop("Id")


def scan_entity_folder(
    spark: SparkSession, root: str, columns: Mapping[str, list[str]]
) -> dict[str, DataFrame]:
    """All entity files of a folder, by entity name."""
    return {name: scan_entity(spark, f"{root}/{name}", cols) for name, cols in columns.items()}


def scan_records_marked(
    spark: SparkSession, path: str, schema: str | T.StructType, whole_files: bool = False
) -> DataFrame:
    """Landed JSON bodies as records of ``schema``, with ``reject_reason`` and ``record`` (its JSON text).

    Each line is a body, or each file with ``whole_files``: a JSON object, or an array of them. Blank bodies and
    empty arrays hold no records. A body that is not JSON (text behind it and repeated names included) is one
    row ``not JSON``, anything else than an object in it one row ``no object``, and a value that is not of its
    column's type makes the record a row ``cast <column>``, the first such column by name of the schema. Rejects
    keep null columns and their text. Which rows come out does not depend on the columns that are read on.

    ``schema`` has flat columns; names are matched exactly, absent fields are null. Nothing landed gives no rows.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    flat = [f for f in schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    if len(flat) < len(schema.fields):
        raise ValueError("records are flat: no arrays, maps or structs")
    if not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType(schema.fields + MARKS))
    body = spark.read.text(path, wholetext=whole_files).where(F.trim("value") != "")
    # In brackets, so that text behind a complete body is an error too.
    wrapped = body.withColumn("parts", F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))).try_cast("array<variant>"))
    alone = F.size("parts") == 1
    inner = F.when(alone, F.get("parts", F.lit(0)))
    several = F.try_variant_get("inner", "$", "array<variant>")
    items = wrapped.select("value", inner.alias("inner")).select(
        "value",
        F.explode(
            F.when(F.col("inner").isNull(), F.array(F.lit(None).cast("variant")))
            .otherwise(F.coalesce(several, F.array("inner")))
        ).alias("item"),
        F.col("inner").isNull().alias("broken"),
    )
    # One step each for the texts, their values and the reason, so that each is formed once.
    names = {f.name: n for n, f in enumerate(flat)}
    # A map of variants shows an object without the schema of all its values.
    is_object = F.try_variant_get("item", "$", "map<string,variant>").isNotNull()
    texts = items.select(
        "value", "item", "broken", is_object.alias("object"),
        *[F.try_variant_get("item", _path(c), "string").alias(f"text{n}") for c, n in names.items()],
    )
    values = texts.select("*", *[F.col(f"text{names[f.name]}").try_cast(f.dataType).alias(f"value{names[f.name]}") for f in flat])
    failed = [
        F.when(F.col(f"text{names[f.name]}").isNotNull() & F.col(f"value{names[f.name]}").isNull(), F.lit(f"cast {f.name}"))
        for f in flat
        if not isinstance(f.dataType, T.StringType)
    ]
    reason = F.when(F.col("broken"), F.lit("not JSON")).when(~F.col("object"), F.lit("no object")).otherwise(
        F.coalesce(*failed, F.lit(None).cast("string"))
    )
    good = F.col("reject_reason").isNull()
    record = F.when(F.col("broken"), F.col("value")).otherwise(F.to_json("item"))
    return values.withColumn("reject_reason", reason).select(
        *[F.when(good, F.col(f"value{n}")).alias(c) for c, n in names.items()],
        "reject_reason",
        F.when(~good, record).alias("record"),
    )


def _path(name: str) -> str:
    """The place of a field in a record, whose name may hold one kind of quotes."""
    mark = "'" if '"' in name else '"'
    if mark in name:
        raise ValueError(f"a field name with both kinds of quotes: {name}")
    return f"$[{mark}{name}{mark}]"


def scan_records(
    spark: SparkSession, path: str, schema: str | T.StructType, whole_files: bool = False
) -> DataFrame:
    """The records of ``scan_records_marked`` whose every value is of its column's type."""
    rows = scan_records_marked(spark, path, schema, whole_files)
    return rows.where(F.col("reject_reason").isNull()).drop("reject_reason", "record")


def load_sources(
    raw: Mapping[str, DataFrame],
    fields: Mapping[str, Mapping[str, str]] = vocab.SOURCE_FIELDS,
    dropped: Mapping[str, list[str]] | None = None,
    inactive: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """Record sets with our column names, without dropped columns and inactive sources."""
    dropped = dropped or {}
    return {
        name: raw[name].withColumnsRenamed(dict(names)).drop(*dropped.get(name, []))
        for name, names in fields.items()
        if name not in inactive and name in raw
    }
