"""Raw listing files in, cleaned and partitioned listing table out."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stagefare.columns import RAW_COLUMNS
from stagefare.sources.scratch import new_path, remove, written_at


def read_raw(spark: SparkSession, path: str, infer: bool = False, **options: str) -> DataFrame:
    """Read delimited listing files with a header.

    Names come from the header and values stay text; ``infer=True`` types the
    columns instead, at the cost of one more pass over the files. Further
    ``options`` go to the CSV reader (``escape='"'`` for doubled quotes).
    """
    reader = spark.read.options(header=True, enforceSchema=False, inferSchema=infer, **options)
    raw = reader.csv(path)
    missing = [c for c in RAW_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"listing file lacks columns {missing}")
    return raw


def write_clean(
    df: DataFrame,
    path: str,
    by: tuple[str, ...] = ("year", "month"),
    only_touched: bool = False,
) -> None:
    """Write a cleaned table as Parquet partitioned by ``by``, replacing the old.

    ``only_touched`` replaces just the partitions present in ``df``. Rows are first written by
    partition as they come, each task its own files, then those files are merged into few, an oversized
    partition into several. Whole rows are a quarter of the size as Parquet that they are in
    a shuffle. Small tables, and those of very many partitions, are rebalanced by a shuffle instead.
    """
    spark = df.sparkSession
    first = new_path(spark, "by-partition")
    staged = written_at(df, first, by).select(*df.columns)
    write_merged(staged, path, partition_counts(staged, by), by, only_touched)
    remove(spark, first)


def partition_counts(staged: DataFrame, by: tuple[str, ...]) -> list[Row]:
    """One row per partition of a written table with its rows ``n``, counted by files' footers; of very many, the first."""
    return staged.groupBy(*by).agg(F.count("*").alias("n")).limit(MERGED_PARTITIONS + 1).collect()


def is_small(counts: list[Row]) -> bool:
    """Whether a table of these partitions is written by a shuffle, its files too few to be worth merging."""
    return sum(r["n"] for r in counts) < ROWS_PER_FILE


def write_merged(
    staged: DataFrame, path: str, counts: list[Row], by: tuple[str, ...] = ("year", "month"), only_touched: bool = False
) -> None:
    """The second half of :func:`write_clean`: rows that are read from files by partition, merged into few files.

    ``counts`` are the partitions as of :func:`partition_counts`, with at least as many rows as ``staged`` holds.
    """
    if len(counts) > MERGED_PARTITIONS or is_small(counts):
        merged = staged.hint("rebalance", *by)
    else:
        merged = reduce(DataFrame.unionAll, [_merged_files(staged, by, r) for r in counts])
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_touched else "static")
        .option("compression", "zstd")
        .partitionBy(*by)
        .parquet(path)
    )


# Rows that a file of a cleaned table holds at most, about, and partitions that are merged file by file.
ROWS_PER_FILE = 1_000_000
MERGED_PARTITIONS = 1000


def _merged_files(staged: DataFrame, by: tuple[str, ...], counted: Row) -> DataFrame:
    """The rows of one partition, in as many tasks as it shall have files.

    Two at least: a union of tables that each are one task is run as one task.
    """
    here = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(counted[c])) for c in by])
    return staged.filter(here).coalesce(2 + counted["n"] // ROWS_PER_FILE)


def read_clean(
    spark: SparkSession,
    path: str,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
) -> DataFrame:
    """Read a cleaned table; ``years`` and ``months`` prune whole partitions."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.filter(F.col("year").isin(*years))
    if months is not None:
        df = df.filter(F.col("month").isin(*months))
    return df
