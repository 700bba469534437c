"""Money, ratios and literals that give the same value on every run and engine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def as_column(value) -> Column:
    """A literal for plain values; columns (for example scalar subqueries) pass through."""
    return value if isinstance(value, Column) else F.lit(value)


def as_timestamp(value: str | datetime | Column) -> Column:
    return as_column(value).cast("timestamp")


def ratio(numerator, denominator) -> Column:
    """numerator / denominator in double, NULL where the denominator is 0 or NULL."""
    top, bottom = (F.col(c) if isinstance(c, str) else c for c in (numerator, denominator))
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def mean_money(total: Column, count: Column) -> Column:
    """Average amount rounded half up to cents, computed on exact decimals."""
    return F.round(F.try_divide(total, count), 2).cast("decimal(12,2)")


def growth_percent(current, previous) -> Column:
    """Percent change; 0 in the first period, NULL when the previous value is 0."""
    now, before = (F.col(c).cast("double") for c in (current, previous))
    return F.when(before.isNotNull(), F.try_divide(now - before, before) * 100).otherwise(F.lit(0.0))


def as_number(column) -> Column:
    """Numeric-looking text (or any decimal) as a double; NULL where it is not a number."""
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("string").try_cast("double")


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast("double"))
