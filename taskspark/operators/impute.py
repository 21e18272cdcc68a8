"""Fill values and category levels learned from a table. Results are a few values per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taskspark.operators.ids import dense_ids
from taskspark.session import scratch_path, shuffles_dropped, store_and_reload

ACCURACY = 10_000
#: How far from the middle a bracket is laid: more than the sketch can err.
MARGIN = 5 / ACCURACY
#: The places of a vector are numbered by an int.
MOST_PLACES = (1 << 31) - 1


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of all columns; a column without values has none. NaN counts as the largest value.

    A sketch brackets the middle of every column and a count proves the bracket, so that only values
    near the middle move. Those are then counted and placed exactly by ``order_values``. A column whose
    bracket does not hold (or is one value) goes there whole or not at all: no size changes the answer.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    around = [0.5 - MARGIN, 0.5 + MARGIN]
    first = df.agg(
        *[F.count(v).alias(f"n_{c}") for c, v in values.items()],
        *[F.percentile_approx(v, around, ACCURACY).alias(f"at_{c}") for c, v in values.items()],
    ).first()
    sizes = {c: first[f"n_{c}"] for c in columns if first[f"n_{c}"]}
    if not sizes:
        return {}
    brackets = {c: first[f"at_{c}"] for c in sizes}
    counts = df.agg(
        *[F.count_if(values[c] < low).alias(f"below_{c}") for c, (low, _) in brackets.items()],
        *[F.count_if(values[c].between(low, high)).alias(f"inside_{c}") for c, (low, high) in brackets.items()],
    ).first()
    middle, kept, out = {}, [], {}
    for c, n in sizes.items():
        ranks, below, inside = ((n - 1) // 2, n // 2), counts[f"below_{c}"], counts[f"inside_{c}"]
        (low, high), value = brackets[c], values[c]
        if not (below <= ranks[0] and ranks[1] < below + inside):
            below = 0
        elif low == high:
            out[c] = low
            continue
        else:
            value = F.when(value.between(low, high), value)
        kept.append(value.alias(c))
        middle[c] = [r - below for r in ranks]
    if middle:
        found = order_values(df.select(*kept), middle)
        out |= {c: found[c][0] / 2 + found[c][1] / 2 for c in middle}
    return {c: out[c] for c in columns if c in out}


def order_values(df: DataFrame, ranks: Mapping[str, Sequence[int]]) -> dict[str, list]:
    """The values at the given places (from 0, in ascending order, nulls left out) of each column.

    Equal values are counted before they move, so a constant or a hot value is one row per task. The
    distinct values are sorted by range and stored; the sizes of the stretches lead to the stretch that
    holds a place, and only there a running count is formed. No stretch grows with ties. Columns must
    have one type; a place beyond the last raises.
    """
    pairs = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("value")) for c in ranks]
    counted = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
    counted = counted.groupBy("name", "value").agg(F.count("*").alias("n"))
    placed = counted.repartitionByRange("name", "value").withColumn("stretch", F.spark_partition_id())
    placed = store_and_reload(placed, "order")
    sizes = placed.groupBy("name", "stretch").agg(F.sum("n").alias("n")).orderBy("name", "stretch").collect()
    wanted = []
    for c, places in ranks.items():
        for place in sorted(set(places)):
            before = 0
            for row in sizes:
                if row["name"] == c:
                    if before <= place < before + row["n"]:
                        wanted.append((c, row["stretch"], before, place))
                        break
                    before += row["n"]
            else:
                raise IndexError(f"{c} has {before} values, none at place {place}")
    if not wanted:
        return {c: [] for c in ranks}
    here = reduce(lambda a, b: a | b, [(F.col("name") == c) & (F.col("stretch") == s) for c, s, _, _ in wanted])
    running = Window.partitionBy("name", "stretch").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = placed.where(here).withColumn("upto", F.sum("n").over(running))
    hits = [
        (F.col("name") == c) & (F.col("stretch") == s) & (F.col("upto") > p - b) & (F.col("upto") - F.col("n") <= p - b)
        for c, s, b, p in wanted
    ]
    rows = upto.where(reduce(lambda a, b: a | b, hits)).collect()
    found = {}
    for c, s, b, p in wanted:
        found[c, p] = next(
            r["value"] for r in rows
            if r["name"] == c and r["stretch"] == s and r["upto"] - r["n"] <= p - b < r["upto"]
        )
    return {c: [found[c, p] for p in places] for c, places in ranks.items()}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent text of each column, the lowest one on ties."""
    counted = _value_counts(df, columns)
    ranked = F.min(F.struct((-F.col("n")).alias("n"), "value"))
    rows = counted.where(F.col("value").isNotNull()).groupBy("name").agg(ranked.alias("top")).collect()
    return {r["name"]: r["top"]["value"] for r in rows}


def learn_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted values of each column, to name a column each. For many values see ``learn_vectors``."""
    values = _value_counts(df, columns).where(F.col("value").isNotNull())
    rows = values.select("name", "value").collect()
    return {c: sorted(r["value"] for r in rows if r["name"] == c) for c in columns}


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).groupBy("name", "value").agg(F.count("*").alias("n"))


def fill_numbers(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Numbers as doubles, null replaced by the column's fill value."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in values.items()}
    )


def fill_texts(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Null replaced by the column's fill value."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def one_hot(df: DataFrame, levels: dict[str, Sequence[str]]) -> DataFrame:
    """A 0/1 column ``Column_value`` for each level; a value that is no level has only zeros."""
    hot = {
        f"{c}_{v}": F.when(F.col(c).cast("string") == v, 1).otherwise(0)
        for c, vs in levels.items()
        for v in vs
    }
    return df.withColumns(hot).drop(*levels)


@dataclass(frozen=True)
class VectorLevels:
    """The levels of columns as places of one vector ``into`` of ``size``.

    ``path`` is a table of ``name`` (the column), ``level`` (its text) and ``at`` (the place). However many levels
    there are, none is held by the driver.
    """

    columns: tuple[str, ...]
    into: str
    size: int
    path: str

    def table(self) -> DataFrame:
        return SparkSession.active().read.schema(LEVELS).parquet(self.path)

    def save(self, path: str) -> None:
        self.table().write.parquet(f"{path}/levels")
        about = [(n, c, self.into, self.size) for n, c in enumerate(self.columns)]
        frame = SparkSession.active().createDataFrame(about, "place int, name string, into string, size long")
        frame.coalesce(1).write.json(f"{path}/columns")

    @classmethod
    def load(cls, path: str) -> VectorLevels:
        reader = SparkSession.active().read.schema("place int, name string, into string, size long")
        rows = reader.json(f"{path}/columns").orderBy("place").collect()
        return cls(tuple(r["name"] for r in rows), rows[0]["into"], rows[0]["size"], f"{path}/levels")


LEVELS = "name string, level string, at long"


def learn_vectors(df: DataFrame, columns: Sequence[str], into: str = "features") -> VectorLevels:
    """One-hot encoding of columns with any number of levels, as one sparse vector ``into``.

    Levels are the distinct texts of a column, in ascending order, columns one after another; see ``vector_levels``
    for their names. A value that is no level, null included, has only zeros. Learn once, then use
    ``one_hot_vectors`` on training and prediction rows alike; what is learned can be saved. Rows hold as many
    entries as there are columns, whatever the number of levels.
    """
    pairs = [F.struct(F.lit(n).alias("place"), F.col(c).cast("string").alias("level")) for n, c in enumerate(columns)]
    levels = df.select(F.inline(F.array(*pairs))).where(F.col("level").isNotNull())
    numbered = dense_ids(levels, ["place", "level"], distinct=True)
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("place") + 1)
    path = scratch_path(df.sparkSession, "levels")
    with shuffles_dropped(df.sparkSession):
        numbered.select(name.alias("name"), "level", (F.col("Id") - 1).alias("at")).write.parquet(path)
    size = df.sparkSession.read.schema(LEVELS).parquet(path).count()
    if size > MOST_PLACES:
        raise ValueError(f"{size} levels, a vector has {MOST_PLACES} places at most")
    return VectorLevels(tuple(columns), into, size, path)


def one_hot_vectors(df: DataFrame, model: VectorLevels) -> DataFrame:
    """``df`` with the vector of ``learn_vectors`` in place of the encoded columns.

    The levels are joined to the rows, which stay on the left, and the outcome is stored: files are read back as
    vectors without a step in Python.
    """
    rows, places = df, []
    for n, c in enumerate(model.columns):
        levels = model.table().where(F.col("name") == c)
        # Stored, so that Spark knows its size.
        levels = store_and_reload(levels.select(F.col("level").alias(f"__level{n}"), F.col("at").cast("int").alias(f"__at{n}")), "level")
        match = F.col(c).cast("string") == F.col(f"__level{n}")
        rows = rows.join(levels, match, "left").drop(f"__level{n}")
        places.append(F.col(f"__at{n}"))
    at = F.array_compact(F.array(*places))
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(model.size).cast("int").alias("size"), at.alias("indices"),
        F.transform(at, lambda _: F.lit(1.0)).alias("values"),
    )
    kept = [c for c in df.columns if c not in model.columns]
    found = rows.select(*kept, parts.alias(model.into))
    path = scratch_path(df.sparkSession, "vectors")
    with shuffles_dropped(df.sparkSession):
        found.write.parquet(path)
    vector = T.StructField(model.into, VectorUDT(), True, {"levels": model.path})
    schema = T.StructType([*found.schema.fields[:-1], vector])
    return df.sparkSession.read.schema(schema).parquet(path)


def vector_levels(df: DataFrame, column: str = "features") -> DataFrame:
    """Place and name (``Column_value``) of the levels of a vector column, as ``at`` and ``level``."""
    table = df.sparkSession.read.schema(LEVELS).parquet(df.schema[column].metadata["levels"])
    return table.select(F.col("at").cast("int").alias("at"), F.concat("name", F.lit("_"), "level").alias("level"))


def vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """The level names of a vector column, in the order of its places, for sets that a driver can hold."""
    return [r["level"] for r in vector_levels(df, column).orderBy("at").collect()]
