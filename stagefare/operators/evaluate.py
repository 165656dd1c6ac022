"""Prediction errors, model comparison, feature importance, prediction tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagefare.columns import Label

COMPARISON_SCHEMA = "model string, rmse double, mae double, r2 double"


def _name(label: Label | str) -> str:
    return label.column if isinstance(label, Label) else label


def error_measures(label: Label | str, prediction: str = "prediction") -> dict[str, Column]:
    """RMSE, MAE and R-squared (about the mean of these rows) as aggregates."""
    actual, predicted = F.col(_name(label)), F.col(prediction)
    square = F.pow(actual - predicted, F.lit(2))
    return {
        "rmse": F.sqrt(F.avg(square)),
        "mae": F.avg(F.abs(actual - predicted)),
        "r2": 1 - F.try_divide(F.sum(square), F.count(actual) * F.var_pop(actual)),
    }


def evaluate(predictions: DataFrame, label: Label | str) -> DataFrame:
    """One row ``rmse, mae, r2, n`` from one pass."""
    measures = error_measures(label)
    return predictions.agg(*[c.alias(n) for n, c in measures.items()], F.count("*").alias("n"))


def compare_predictions(
    predictions: DataFrame, label: Label | str, columns: dict[str, str]
) -> DataFrame:
    """``model, rmse, mae, r2`` of several prediction columns, from one pass.

    ``columns`` maps model name to prediction column.
    """
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            *[c.alias(n) for n, c in error_measures(label, column).items()],
        )
        for model, column in columns.items()
    ]
    one_row = predictions.agg(F.array(*rows).alias("models"))
    return one_row.select(F.inline("models"))


def metrics_long(evaluation: DataFrame, train_size: int, test_size: int) -> DataFrame:
    """Evaluation row as ``metric, value`` rows, with the sizes of both sides."""
    pairs = [
        ("RMSE", F.col("rmse")),
        ("MAE", F.col("mae")),
        ("R2", F.col("r2")),
        ("train_size", F.lit(float(train_size))),
        ("test_size", F.lit(float(test_size))),
    ]
    entries = [F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in pairs]
    return evaluation.select(F.inline(F.array(*entries)))


def best_model(comparison: DataFrame) -> DataFrame:
    """The row with the least RMSE, ties by name."""
    return comparison.orderBy("rmse", "model").limit(1)


def feature_names(model: PipelineModel, sample: DataFrame) -> list[str]:
    """Name of every slot of the feature vector, from the vector column's metadata."""
    schema = model.transform(sample.limit(0)).schema
    attributes = schema["features"].metadata["ml_attr"]["attrs"]
    slots = [(a["idx"], a["name"]) for kind in attributes.values() for a in kind]
    return [name for _, name in sorted(slots)]


def importance_values(model: PipelineModel, sample: DataFrame) -> dict[str, float]:
    """Importance of every feature of a tree model."""
    values = model.stages[-1].featureImportances.toArray()
    return {n: float(v) for n, v in zip(feature_names(model, sample), values, strict=True)}


def feature_importance(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """``feature, importance``, most important first; one row per vector slot."""
    rows = list(importance_values(model, sample).items())
    table = sample.sparkSession.createDataFrame(rows, "feature string, importance double")
    return sort_importance(table)


def sort_importance(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature")


def prediction_table(predictions: DataFrame, label: Label | str) -> DataFrame:
    """The saved prediction columns."""
    return predictions.select(
        "event_id",
        "artist",
        "genre",
        "event_date",
        _name(label),
        "prediction",
        "spotify_popularity",
    )


def prediction_sample(
    predictions: DataFrame, label: Label | str, n: int = 100, prediction: str = "prediction"
) -> DataFrame:
    """The first ``n`` predictions by event id, with their absolute error."""
    actual, predicted = F.col(_name(label)), F.col(prediction)
    return (
        predictions.select(
            "event_id",
            "artist",
            "genre",
            actual.alias("actual_price"),
            predicted.alias("predicted_price"),
            F.abs(actual - predicted).alias("error"),
        )
        .orderBy("event_id")
        .limit(n)
    )


def first_rows(df: DataFrame, order: str, n: int = 100) -> DataFrame:
    """The first ``n`` whole rows in a stated order."""
    return df.orderBy(order).limit(n)


def comparison_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Comparison rows of fits that were evaluated one by one."""
    return spark.createDataFrame(rows, COMPARISON_SCHEMA)
