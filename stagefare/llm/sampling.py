"""Bounded samples for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 30


def fold(key: str, parts: int) -> Column:
    """``crc32`` of a key's decimal text modulo ``parts``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def bounded(df: DataFrame, key: str, most: int) -> DataFrame:
    """Rows with the least hashes of ``key``, about ``most`` of them (all, if there are fewer).

    Whether a row is taken depends on its key and on how many rows there are, not on where it lies.
    """
    share = min(1.0, most / max(1, df.count()))
    return df.filter(F.pmod(F.xxhash64(key), F.lit(_PARTS)) < F.lit(int(share * _PARTS)))
