"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    """First day of the calendar month: the partition value of every dated table."""
    return F.trunc(day, "MM").alias("month")


def month_starts(start: Column, end: Column) -> Column:
    """Array of the first days of all months touched by [start, end]; empty when start > end.

    sequence() raises on a descending range, hence the guard.
    """
    first = F.trunc(start, "MM")
    months = F.sequence(first, F.greatest(first, end), F.expr("interval 1 month"))
    return F.when(start <= end, months).otherwise(F.array().cast("array<date>"))
