"""Number handling shared by scoring and reporting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_double(value: Column) -> Column:
    """Bad text becomes null even under ANSI mode."""
    return value.try_cast("double")


def safe_double(value: Column, default: float = 0.0) -> Column:
    """Null, unparsable, NaN and infinite values become `default`."""
    number = try_double(value)
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    return F.when(finite, number).otherwise(F.lit(float(default)))


def number_or(value: Column, default: float = 0.0) -> Column:
    """Null and unparsable values become `default`; NaN and infinities pass."""
    return F.coalesce(try_double(value), F.lit(float(default)))


def integer_or(value: Column, default: int = 0) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(int(default)))


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))
