"""Table profile and data behind the actual-versus-predicted plot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagefare.columns import Label
from stagefare.functions.running import number, quantile_zones, quantiles

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def profile_shape(df: DataFrame) -> DataFrame:
    """One row per column: its type, with the table's row and column counts."""
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(n).alias("column_name"),
                F.lit(t).alias("data_type"),
            )
            for i, (n, t) in enumerate(df.dtypes, start=1)
        ]
    )
    return df.agg(F.count("*").alias("n_rows")).select(
        F.inline(entries), "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )


def profile_head(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def profile_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles per column."""
    columns = columns or numeric_columns(df)
    entries = []
    for c in columns:
        value = number(c)
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(value).alias("count"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
            )
        )
    stats = df.agg(F.array(*entries).alias("stats")).select(F.inline("stats"))
    probs = list(QUARTILES.values())
    found = quantiles(df, columns, probs, quantile_zones(df, columns, probs))
    wide = found.groupBy("column_name").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(q) for q, p in QUARTILES.items()]
    )
    return stats.join(F.broadcast(wide), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", *QUARTILES, "max"
    )


def profile_missing(df: DataFrame) -> DataFrame:
    """Missing count and percentage (2 decimals) of the columns that miss any value."""
    entries = []
    for field in df.schema.fields:
        missing = F.col(f"`{field.name}`").isNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(f"`{field.name}`")
        entries.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.count_if(missing).alias("missing_count"),
                F.round(F.try_divide(F.count_if(missing), F.count("*")) * 100, 2).alias(
                    "missing_pct"
                ),
            )
        )
    table = df.agg(F.array(*entries).alias("columns")).select(F.inline("columns"))
    return table.filter(F.col("missing_count") > 0)


def trim_outliers(
    predictions: DataFrame, label: Label | str, cap: float = 1000, prediction: str = "prediction"
) -> DataFrame:
    """Rows whose actual and predicted price are both at most ``cap``."""
    name = label.column if isinstance(label, Label) else label
    return predictions.filter((F.col(name) <= cap) & (F.col(prediction) <= cap))


def plot_pairs(
    predictions: DataFrame, label: Label | str, cap: float | None = None
) -> DataFrame:
    """Actual and predicted price of every row, optionally without outliers."""
    name = label.column if isinstance(label, Label) else label
    rows = predictions if cap is None else trim_outliers(predictions, name, cap)
    return rows.select(F.col(name).alias("actual"), F.col("prediction").alias("predicted"))


def plot_limits(pairs: DataFrame) -> DataFrame:
    """Ends of the diagonal: least and greatest actual price."""
    return pairs.agg(F.min("actual").alias("low"), F.max("actual").alias("high"))
