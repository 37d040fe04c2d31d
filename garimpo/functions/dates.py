"""Dates: parsing, buckets and rolling windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from . import fixed_values as V

# Proleptic day number of 1970-01-01 with 0001-01-01 as day 1.
EPOCH_ORDINAL = date(1970, 1, 1).toordinal()


def as_date(value: date | str | Column) -> Column:
    """A date literal, or the column itself."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def since(day: Column, days: int, as_of: date | str | Column) -> Column:
    """True for dates not older than ``days`` before ``as_of``; NULL dates are not."""
    return day >= F.date_sub(as_date(as_of), days)


def older_than(day: Column, days: int, as_of: date | str | Column) -> Column:
    return day < F.date_sub(as_date(as_of), days)


def date_window(day: Column, width: int = V.DATE_WINDOW_DAYS) -> Column:
    """Number of the fixed bucket a date falls in, as text; ``unknown`` without a date."""
    ordinal = F.datediff(day, F.lit("1970-01-01").cast("date")) + F.lit(EPOCH_ORDINAL)
    return F.coalesce(F.floor(ordinal / width).cast("string"), F.lit(V.UNKNOWN))


def parse_date(text: Column) -> Column:
    """ISO date-time, ISO date or day/month/year within the first 19 characters."""
    head = F.substring(text, 1, 19)
    return F.coalesce(
        *[F.try_to_timestamp(head, F.lit(form)).cast("date") for form in V.DATE_FORMATS]
    )


def epoch_date(seconds: Column) -> Column:
    """UTC date of an epoch number; 0 counts as missing."""
    days = F.floor(seconds / 86400).cast("int")
    return F.when(seconds != 0, F.date_add(F.lit("1970-01-01").cast("date"), days))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, rounded; NULL when either is missing."""
    return F.round(end.cast("double") - start.cast("double")).cast("int")
