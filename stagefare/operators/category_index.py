"""Category indices as a table: labels ranked by frequency without a list of them on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagefare.functions.joins import look_up, measure_dims
from stagefare.functions.running import running_total
from stagefare.sources.scratch import materialize

# Slots that one vector can have: MLlib counts them in an int.
SLOT_LIMIT = (1 << 31) - 1


def category_index(df: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """``dim, key, index, rows``: labels of each column from 0 on, most frequent first, ties by name; nulls have none."""
    entries = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("key")) for d in dims])
    counted = df.select(F.inline(entries)).filter("key is not null").groupBy("dim", "key").agg(F.count("*").alias("rows"))
    placed = running_total(counted, "dim", [-F.col("rows"), F.col("key")], F.lit(1), "place")
    return placed.select("dim", "key", (F.col("place") - 1).alias("index"), "rows")


def slots(index: DataFrame, dims: tuple[str, ...]) -> dict[str, int]:
    """How many labels each column has; refuses more than a vector can hold, one number for each column."""
    sizes = {r["dim"]: r["n"] for r in index.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    found = {d: sizes.get(d, 0) for d in dims}
    if sum(found.values()) + len(dims) > SLOT_LIMIT:
        raise ValueError(f"too many labels for one vector: {found}")
    return found


def apply_index(df: DataFrame, index: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """``df`` with ``<dim>_idx``; labels the index does not hold, and nulls, get the number after the last."""
    written = materialize(index, "category-index")
    sizes, tables = slots(written, dims), measure_dims(written, dims)
    out = df
    for dim in dims:
        found = f"{dim}_idx"
        table = tables[dim]
        one = type(table)(table.table.select("key", F.col("index").alias(found)), table.key, table.size_bytes)
        out = look_up(out, one, dim).withColumn(found, F.coalesce(F.col(found), F.lit(sizes[dim])).cast("double"))
    return out
