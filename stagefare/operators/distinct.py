"""Distinct counts that merge: sketches by month, stored once and added up for any span of time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTED = ("artist", "city", "state")
LOG_SLOTS = 12


def relative_error(log_slots: int = LOG_SLOTS) -> float:
    """Standard error of an estimate as a share of the count."""
    return 1.04 / 2 ** (log_slots / 2)


def distinct_sketches(
    cleaned: DataFrame, columns: tuple[str, ...] = COUNTED, log_slots: int = LOG_SLOTS
) -> DataFrame:
    """``year, month, n_events`` and a HyperLogLog sketch ``<column>_sketch`` of every column.

    A sketch has a few KB whatever it has seen; tasks combine theirs before the shuffle. Nulls are not counted.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), log_slots).alias(f"{c}_sketch") for c in columns]
    return cleaned.groupBy("year", "month").agg(F.count("*").alias("n_events"), *sketches)


def distinct_between(
    sketches: DataFrame,
    columns: tuple[str, ...] = COUNTED,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """``n_events`` and estimates ``unique_<column>`` over the stored months asked for, per group of ``by`` (or in all)."""
    rows = sketches
    if years is not None:
        rows = rows.filter(F.col("year").isin(*years))
    if months is not None:
        rows = rows.filter(F.col("month").isin(*months))
    merged = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"unique_{c}") for c in columns]
    return rows.groupBy(*by).agg(F.sum("n_events").alias("n_events"), *merged)
