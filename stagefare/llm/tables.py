"""Reading and naming shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagefare.sources.scratch import _hadoop, materialize
from stagefare.sources.ship import ship_package

__all__ = ["checksum", "discard", "materialize", "read", "ship_package", "texts"]


_BATCH, _SPARK_DEFAULT, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, for operators that run on executors that know this package.

    Arrow batches are limited by bytes, unless the session says otherwise: texts can be long,
    and a batch is held several times over in a task.
    """
    ship_package(spark)
    if spark.conf.get(_BATCH) == _SPARK_DEFAULT:
        spark.conf.set(_BATCH, str(_BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator uses, so that others cannot clash with its own."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more)


def discard(*written: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    for df in written:
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            files, folder = _hadoop(df.sparkSession, path)
            files.delete(folder, True)


def checksum(df: DataFrame) -> tuple:
    """Row count and an order-free hash of a small-row table, to see whether it changed."""
    row = df.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("hash"),
    ).first()
    return row["n"], row["hash"]
