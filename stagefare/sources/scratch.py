"""Intermediate tables in the folder all executors share.

A written table, unlike a cached one, survives the loss of executors and ends
the lineage of what reads it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; set here only for local runs.

    A cluster must name the folder itself, as a folder on one machine would not
    be seen by the others.
    """
    folder = spark.conf.get(_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{_CONF} must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stagefare-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def app_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/stagefare/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{app_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder, partitioned by ``by``, and read it back."""
    return written_at(df, new_path(df.sparkSession, name), by)


def written_at(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """:func:`materialize` at a path of the caller's, who can remove it after its last reader."""
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a written table is complete."""
    files, marker = _hadoop(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    files, folder = _hadoop(spark, path)
    files.delete(folder, True)


def clear(spark: SparkSession) -> None:
    """Delete the tables this application wrote, once nothing reads them."""
    remove(spark, app_dir(spark))
