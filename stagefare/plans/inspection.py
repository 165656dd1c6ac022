"""Looking at tables and models: profile, export, plot data, reference summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stagefare.columns import Label
from stagefare.operators import profile
from stagefare.operators.score import model_summary
from stagefare.plans.scoring import load_tables
from stagefare.sources.outputs import write_report, write_rows


def profile_job(table: DataFrame, target: str, order: list[str], head: int = 10) -> dict[str, DataFrame]:
    """Shape, first rows, numeric summary and missing values of any table, saved and returned.

    Each has a row per column of the table, or ``head`` rows.
    """
    missing_order = [c for c in order if c not in table.columns]
    if missing_order:
        raise ValueError(f"the table lacks columns {missing_order}")
    found = {
        "shape": profile.profile_shape(table),
        "head": profile.profile_head(table, order, head),
        "numeric": profile.profile_numeric(table),
        "missing": profile.profile_missing(table),
    }
    spark = table.sparkSession
    for name, report in found.items():
        write_report(report, f"{target}/{name}")
    return {n: spark.read.csv(f"{target}/{n}", schema=r.schema, header=True) for n, r in found.items()}


def plot_job(spark: SparkSession, predictions: str, label: Label, target: str, cap: float | None = None) -> dict[str, DataFrame]:
    """Actual and predicted prices of a training output's predictions, without prices over ``cap``, and the diagonal's ends."""
    schema = f"event_id string, artist string, genre string, event_date date, {label.column} double, prediction double, spotify_popularity int"
    pairs = profile.plot_pairs(spark.read.schema(schema).csv(predictions, header=True), label, cap)
    write_rows(pairs, f"{target}/pairs")
    limits = profile.plot_limits(pairs)
    write_report(limits, f"{target}/limits")
    return {"limits": limits}


def summary_job(spark: SparkSession, raw: DataFrame, max_dir: str, min_dir: str, target: str) -> dict[str, DataFrame]:
    """Sizes and overall means of the reference tables that two training outputs score with."""
    summary = model_summary(load_tables(spark, raw, max_dir, min_dir))
    write_report(summary, target, "json")
    return {"summary": summary}
