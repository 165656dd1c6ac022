"""Which rows stay: required values, usable labels, one row per key, train or test."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagefare.columns import FILL_VALUES, Label


def all_present(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows with a value in every given column; an empty text is a value."""
    return df.filter(all_present(columns))


def best_first(columns: Iterable[str], keys: list[str], prefer: Iterable[str] = ()) -> Column:
    """What rows of a key are compared by: all ``prefer`` columns present, those, then the others in order."""
    prefer = [c for c in prefer if c not in keys]
    rest = [c for c in columns if c not in keys and c not in prefer]
    ranked = [F.col(c) for c in (*prefer, *rest)]
    if prefer:
        ranked.insert(0, all_present(prefer).alias("__complete"))
    return F.struct(*ranked)


def unpack(df: DataFrame, columns: Iterable[str], keys: list[str], kept: str) -> DataFrame:
    """The rows that a struct of :func:`best_first` holds, in the order of ``columns``."""
    return df.select(*[F.col(c) if c in keys else F.col(f"{kept}.{c}").alias(c) for c in columns])


def dedup(df: DataFrame, keys: list[str], prefer: Iterable[str] = ()) -> DataFrame:
    """One row per key, the same one on every run.

    Rows with all ``prefer`` columns come first, then the row with the greatest
    values, compared column by column (``prefer`` columns, then the others in
    table order; nulls are least). Rows equal in all of it are copies. Being an
    aggregate, it drops copies before the shuffle, so a key that holds much of
    the table sends one row per task.
    """
    kept = df.groupBy(*keys).agg(F.max(best_first(df.columns, keys, prefer)).alias("__kept"))
    return unpack(kept, df.columns, keys, "__kept")


def valid_label(df: DataFrame, label: Label, artist: str = "artist") -> DataFrame:
    """Rows whose price can be learned from: present and positive (or zero if allowed)."""
    price = F.col(label.column)
    usable = price >= 0 if label.allow_zero else price > 0
    return df.filter(price.isNotNull() & usable & F.col(artist).isNotNull())


def fill_missing(df: DataFrame, values: dict | None = None) -> DataFrame:
    """Replace nulls by a constant per column (default: the model inputs')."""
    return df.fillna(FILL_VALUES if values is None else values)


def training_rows(df: DataFrame, label: Label) -> DataFrame:
    """Labelled rows with the model inputs filled."""
    return fill_missing(valid_label(df, label))


def in_train(key: str, train_pct: int = 80) -> Column:
    """Whether a row belongs to the training side, decided by its key alone.

    Unlike a random split it does not depend on row order or partitioning, and
    all rows of a key fall on one side.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100 < train_pct


def hash_split(df: DataFrame, key: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    side = in_train(key, train_pct)
    return df.filter(side), df.filter(~side)


def random_split(df: DataFrame, train_share: float = 0.8, seed: int = 42):
    """Training and test rows by Spark's random split."""
    return df.randomSplit([train_share, 1 - train_share], seed=seed)
