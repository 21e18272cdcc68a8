"""Text, flag and code expressions, ``Column -> Column``."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold_case(value: Column, null_text: str = "nan", upper: bool = False) -> Column:
    """Lower (or upper) case text; null becomes the text ``nan`` first."""
    text = F.coalesce(value.cast("string"), F.lit(null_text))
    return F.upper(text) if upper else F.lower(text)


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True when one of the words is somewhere in the text, in any case; null text holds none."""
    low = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    return reduce(lambda a, b: a | b, [low.contains(w) for w in words], F.lit(False))


def keep_listed(value: Column, kept: Iterable[str], rest: str = "other") -> Column:
    """The value itself if listed, else ``rest``."""
    return F.when(value.isin(*kept), value).otherwise(F.lit(rest))


def engine_family(engine: Column, prefixes: Iterable[str] = ("pw", "pt")) -> Column:
    """First three letters of engines with a known prefix."""
    known = reduce(lambda a, b: a | b, [engine.startswith(p) for p in prefixes])
    return F.when(known, F.substring(engine, 1, 3)).otherwise(engine)


def int_or_na(df: DataFrame, name: str) -> Column:
    """Text form that marks null as ``NA``: text stays, numbers lose their fraction."""
    value = F.col(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        value = value.try_cast("bigint").cast("string")
    return F.coalesce(value, F.lit("NA"))


def to_flag(value: Column) -> Column:
    """Number to boolean; a missing number counts as true."""
    return F.coalesce(value.cast("boolean"), F.lit(True))


def blank_nulls(df: DataFrame) -> DataFrame:
    """Null becomes ``''`` in every text column."""
    return df.na.fill("")


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast by map; a value that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def fold_text_columns(df: DataFrame, null_text: str = "nan") -> DataFrame:
    """``fold_case`` on every text column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: fold_case(F.col(c), null_text) for c in names})
