"""Date functions: day truncation and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerstar.constants import DAY_FORMAT


def format_day(ts: Column | str, fmt: str = DAY_FORMAT) -> Column:
    """Timestamp to a day string such as ``31-12-1998``."""
    return F.date_format(ts, fmt)


def parse_day(text: Column | str, fmt: str = DAY_FORMAT) -> Column:
    """Day string back to a DATE; NULL when the text does not parse."""
    return F.try_to_date(text, fmt)


def to_day(ts: Column | str) -> Column:
    """Truncate a timestamp to its calendar day.

    Same day as formatting with ``dd-MM-yyyy`` and parsing it back, without
    a string per row; stays inside whole-stage codegen.
    """
    return F.to_date(ts)


def calendar_parts(day: Column | str) -> list[Column]:
    """``year, month, day`` of a DATE, as INT columns."""
    return [
        F.year(day).cast("int").alias("year"),
        F.month(day).cast("int").alias("month"),
        F.dayofmonth(day).cast("int").alias("day"),
    ]
