"""Column expressions. All are built-in Spark functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_compact_date(column: str | Column, strict: bool = False) -> Column:
    """A ``yyyyMMdd`` number or text as a date.

    A bad value gives null. With ``strict`` it fails the query instead, which
    is what Spark's ANSI mode does on its own.
    """
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.to_date(text, "yyyyMMdd") if strict else F.try_to_date(text, "yyyyMMdd")


def day(value: date) -> Column:
    """A date literal, also for years before 1000, which ``lit`` rejects."""
    return F.lit(value.isoformat()).cast("date")


def as_id(column: str) -> Column:
    return F.col(column).cast("string")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division as double that gives null, not an error, on a zero denominator."""
    up = F.col(numerator) if isinstance(numerator, str) else numerator
    down = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(up.cast("double"), down.cast("double"))


def days_around(column: str | Column, before: int, after: int) -> Column:
    """The dates from ``before`` days before to ``after`` days after, as an array."""
    return F.sequence(F.date_sub(column, before), F.date_add(column, after))


def days_from(column: str | Column, after: int) -> Column:
    """The date itself and the ``after`` days that follow, as an array."""
    return days_around(column, 0, after)
