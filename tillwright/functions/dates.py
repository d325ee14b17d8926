"""Date arithmetic shared by views and derived tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_before(as_of: str | date, days: int) -> Column:
    """A constant date; Spark folds it and pushes the comparison into the scan."""
    return F.date_sub(F.lit(as_of).cast("date"), days)


def month_number(day: Column) -> Column:
    """Months counted from year 0, so that a difference counts month boundaries."""
    return F.year(day) * 12 + F.month(day) - 1


def month_label(number: Column) -> Column:
    return F.format_string("%04d-%02d", F.floor(number / 12), number % 12 + 1)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def day_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def date_of_key(column: str | Column) -> Column:
    """Date of a ``yyyyMMdd`` or ``yyyyMMdd_HH`` string; null when it is no date."""
    c = F.col(column) if isinstance(column, str) else column
    return F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd")
