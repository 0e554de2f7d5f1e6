"""Null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL where the denominator is 0 or NULL."""
    return F.try_divide(numerator, denominator)


def percent(numerator: Column, denominator: Column) -> Column:
    """Share in percent, two decimals, NULL on an empty denominator."""
    return F.round(safe_divide(numerator, denominator) * 100, 2)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def is_one(indicator: Column) -> Column:
    """Boolean of a 0/1 number; NULL stays NULL."""
    return indicator.cast("double") == 1


def bin_number(value: Column, low: float, high: float, bins: int) -> Column:
    """1-based equal-width bin of a value clipped to [low, high]; the last bin is closed."""
    clipped = F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))
    return F.least(F.floor((clipped - low) * bins / (high - low)) + 1, F.lit(bins)).cast("long")
