"""Rates, shares and flags that stay NULL, not an error, when the denominator is zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnLike, as_column


def flag(condition: Column) -> Column:
    """1 when the condition is true, else 0 (also when it is NULL)."""
    return F.when(condition, 1).otherwise(0)


def rounded_avg(value: ColumnLike, digits: int = 2) -> Column:
    return F.round(F.avg(as_column(value)), digits)


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """``part / whole * 100``; also usable inside an aggregation."""
    value = F.try_divide(part, whole) * 100
    return value if digits is None else F.round(value, digits)


def percent_where(condition: Column, digits: int | None = 2) -> Column:
    """Share of the rows of a group that fulfil a condition, in percent."""
    return percent(F.sum(flag(condition)), F.count(F.lit(1)), digits)


def ratio(part: Column, whole: Column, digits: int | None = 2) -> Column:
    value = F.try_divide(part, whole)
    return value if digits is None else F.round(value, digits)


def nan_to_null(value: ColumnLike) -> Column:
    value = as_column(value)
    return F.when(~F.isnan(value), value)
