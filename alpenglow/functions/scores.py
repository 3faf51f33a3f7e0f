"""The score kit: every score is a decimal rounded to a whole number between 0 and 100.

greatest and least skip nulls, so a missing input gives the bound (a missing gust scores 100, a missing risk input 0).
That is the meaning the model is defined with; the null rules have their own tests.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def at_least_zero(x: Column) -> Column:
    return F.greatest(F.lit(0), x)


def at_most_hundred(x: Column) -> Column:
    return F.least(F.lit(100), x)


def falling(x: Column, zero_at: int, width: Decimal) -> Column:
    """0 from zero_at upwards, 100 from zero_at - width downwards, linear between."""
    return at_least_zero(at_most_hundred(F.round(100 * (F.lit(zero_at) - x) / F.lit(width))))


def risk(x: Column) -> Column:
    """A raw risk value as whole points within 0..100."""
    return at_most_hundred(at_least_zero(F.round(x)))


def plateau(full: Column, distance: Column, width: Decimal) -> Column:
    """100 while `full` holds, otherwise the distance to the zero point as a share of the ramp width."""
    return F.when(full, F.lit(100)).otherwise(at_least_zero(F.round(100 * distance / F.lit(width))))


def weighted(parts: Iterable[tuple[str, Decimal]]) -> Column:
    """Rounded weighted sum of score columns."""
    return F.round(reduce(add, (F.lit(weight) * F.col(name) for name, weight in parts)))
