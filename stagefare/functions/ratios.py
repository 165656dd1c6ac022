"""Ratios that are null, not an error, when the divisor is zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def premium_percent(price: Column, base: Column) -> Column:
    """How far ``price`` lies above ``base``, in percent of ``base``."""
    return F.try_divide(price - base, base) * 100


def percent_of(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100
