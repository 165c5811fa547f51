"""Date repair."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_yyyymmdd(value: Column) -> Column:
    """Date held as an integer ``yyyyMMdd``; any other shape and impossible days become NULL.

    Arithmetic instead of a text pattern: a parser raises and catches an exception for each bad
    value, which is fifty times slower, and ``to_date`` ends the job under ANSI. The formula is
    kept short, because generated code of more than 8,000 bytes per method is not compiled.
    """
    number = whole_number(value)
    return date_of(number, month_and_day(number))


def whole_number(value: Column) -> Column:
    """The number of eight digits, or NULL."""
    number = value.try_cast("int")
    return F.when(number.between(1000_01_01, 9999_12_31), number)


def month_and_day(number: Column) -> Column:
    """So many days from the first of the month of :func:`whole_number`; NULL if there is no such month or day."""
    month, day = (number / 100).cast("int") % 100, number % 100
    first = F.add_months(F.make_date((number / 10_000).cast("int"), F.lit(1), F.lit(1)), month - 1)
    return F.when(month.between(1, 12) & day.between(1, 31), F.date_add(first, day - 1))


def date_of(number: Column, shifted: Column) -> Column:
    """The date, if counting days from the first of its month does not leave the month."""
    return F.when(F.dayofmonth(shifted) == number % 100, shifted)


def null_future(value: Column, as_of: dt.date | None = None) -> Column:
    """NULL for dates after ``as_of`` (default: the day of the run)."""
    limit = F.lit(as_of) if as_of else F.current_date()
    return F.when(value <= limit, value)
