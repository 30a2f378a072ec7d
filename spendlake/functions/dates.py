"""Calendar helpers; the session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlake.functions.numbers import as_column


def month_of(day: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(as_column(day), "MM")


def day_name(day: Column | str) -> Column:
    """Full English weekday name."""
    return F.date_format(as_column(day), "EEEE")


def is_weekend(day: Column | str) -> Column:
    """Saturday or Sunday (Sunday is weekday 1, Saturday 7)."""
    return F.dayofweek(as_column(day)).isin(1, 7)


def utc_date(moment: Column | str) -> Column:
    return F.to_date(as_column(moment))


def month_boundaries(later: Column | str, earlier: Column | str) -> Column:
    """Month boundaries crossed between two dates: 31 Jan to 1 Feb counts as one.

    ``months_between`` and ``timestampdiff`` count elapsed months instead.
    """

    def months(day: Column) -> Column:
        return F.year(day).cast("long") * 12 + F.month(day).cast("long")

    return months(as_column(later)) - months(as_column(earlier))
