"""Date expressions. All are time-zone free: they work on dates and timestamps without zone."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The stand-ins for "no date" and "for life", and the span a stored date may have.
MISSING_DATE = "1677-09-21"
LIFE_DATE = "2262-04-11"
LIFE_DATE_TEXT = "11-04-2262"
FIRST_INSTANT = "1677-09-21 00:12:43.145225"
LAST_INSTANT = "2262-04-11 23:47:16.854775"

# Fixed value: a day-first date whose year is made of the digits 7 to 9 means "for life".
LIFE_PATTERN = "^[0-9]{1,2}[-][0-9]{1,2}[-][7-9]{4}"

STAMP_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} ([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$"


def sentinel_date(text: Column, life_pattern: str = LIFE_PATTERN) -> Column:
    """``yyyy-MM-dd`` text for storage: missing and life dates become fixed dates.

    Null means the text is none of the three and cannot be read: the caller rejects the row.
    """
    day = F.when(
        text.rlike(STAMP_PATTERN),
        F.try_to_date(F.substring_index(text, " ", 1), "yyyy-M-d"),
    )
    return (
        F.when(text.isNull() | text.isin("", "nan"), F.lit(MISSING_DATE))
        .when(text.rlike(life_pattern), F.lit(LIFE_DATE))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )


def life_date_text(text: Column, life_pattern: str = LIFE_PATTERN) -> Column:
    """Life dates become the last day as ``dd-MM-yyyy``; all other text stays."""
    return F.when(text.rlike(life_pattern), F.lit(LIFE_DATE_TEXT)).otherwise(text)


def read_dates(df: DataFrame, columns: Iterable[str], null_out_of_range: bool = True) -> DataFrame:
    """Timestamps of slash or ISO text, or of date columns; null where a value cannot be read.

    The stored "no date" lies just below the allowed span, so it turns into null here; without
    that every open task would look completed. Later than the last instant is null as well,
    unless ``null_out_of_range`` is off.
    """
    first, last = (F.lit(v).cast("timestamp_ntz") for v in (FIRST_INSTANT, LAST_INSTANT))
    stamps = {c: _stamp(F.col(c), df.schema[c].dataType) for c in columns}
    # Two steps, so that the text is read once and not again for each bound.
    found = df.withColumns(stamps)
    return found.withColumns(
        {
            c: F.when(F.col(c).between(first, last) if null_out_of_range else F.col(c) >= first, F.col(c))
            for c in stamps
        }
    )


def _stamp(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("timestamp_ntz")
    # The cast reads yyyy-M-d with or without time; it would also take a lone year or month.
    text = F.translate(value.cast("string"), "/", "-")
    dashes = (F.substring(text, 5, 1) == "-") & F.substring(text, 7, 2).contains("-")
    return F.when(dashes, text).try_cast("timestamp_ntz")


def date_text(value: Column) -> Column:
    """``yyyy-MM-dd`` text, null stays null."""
    return F.date_format(value, "yyyy-MM-dd")


def whole_days(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, rounded down: -1 hour is -1 day."""
    start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    unfinished = _time_of_day(end) < _time_of_day(start)
    return F.datediff(end, start) - F.when(unfinished, 1).otherwise(0)


def day_span(start: Column, end: Column) -> Column:
    """Days touched from ``start`` to ``end``, both counted."""
    return whole_days(start, end) + 1


def _time_of_day(stamp: Column) -> Column:
    return F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.extract(F.lit("SECOND"), stamp)
