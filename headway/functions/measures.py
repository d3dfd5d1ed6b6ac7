"""Aggregate expressions used across gold tables and queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.text import _col


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded; NULL when the whole is 0."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("int")), F.lit(0))


def any_true(c: Column | str) -> Column:
    return F.bool_or(_col(c))


def all_true(c: Column | str) -> Column:
    return F.bool_and(_col(c))


def weighted_mean(value: Column | str, weight: Column | str, digits: int | None = None) -> Column:
    """Sum of value * weight over the sum of weights; NULL for a zero weight."""
    mean = F.try_divide(F.sum(_col(value) * _col(weight)), F.sum(_col(weight)))
    return mean if digits is None else F.round(mean, digits)


def sorted_set(c: Column | str) -> Column:
    """Distinct non-null values in order, so results do not depend on row order."""
    return F.sort_array(F.collect_set(_col(c)))
