"""Scoring job: a table of price requests in, a table of answers out."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagefare.columns import MAX_PRICE, MIN_PRICE
from stagefare.operators.encoding import load_encoding
from stagefare.operators.evaluate import importance_values
from stagefare.operators.score import ScoringTables, rejected_requests, score_batch, score_features
from stagefare.sources.models import load_model, model_path


def load_tables(spark: SparkSession, raw: DataFrame, max_dir: str, min_dir: str) -> ScoringTables:
    """Reference tables from two training outputs and the raw listings."""
    highest = load_encoding(spark, f"{max_dir}/avg_encoding", MAX_PRICE)
    lowest = load_encoding(spark, f"{min_dir}/avg_encoding", MIN_PRICE)
    return ScoringTables.build(raw, highest, lowest)


def _kind(model: PipelineModel) -> str:
    return type(model.stages[-1]).__name__.removesuffix("Model")


def score_job(
    requests: DataFrame,
    raw: DataFrame,
    max_dir: str,
    min_dir: str,
    target: str,
    as_of: str,
    max_name: str | None = None,
    min_name: str | None = None,
) -> ScoringTables:
    """Score ``requests`` with the models below both folders.

    A folder is the output of a training, comparison or sweep job; a name picks one of the
    models of the latter two. Answers go to ``target`` as Parquet, with the kind and path of
    the models used; requests that lack a required field go to ``<target>_rejected`` with the
    reason, so every request is in one of the two.
    """
    spark = requests.sparkSession
    tables = load_tables(spark, raw, max_dir, min_dir)
    paths = model_path(max_dir, max_name), model_path(min_dir, min_name)
    models = load_model(paths[0]), load_model(paths[1])
    importances = None
    if hasattr(models[0].stages[-1], "featureImportances"):
        sample = score_features(requests, tables, as_of)
        for dim in ("state", "city", "genre", "subgenre"):
            sample = sample.withColumn(f"{dim}_avg_price", sample[f"{dim}_avg_max"])
        importances = importance_values(models[0], sample)
    keep = tuple(c for c in requests.columns if c not in ("date", "genre"))
    answers = score_batch(requests, tables, models, as_of, importances, keep)
    used = {}
    for end, model, path in zip(("max", "min"), models, paths, strict=True):
        used |= {f"{end}_model": F.lit(_kind(model)), f"{end}_model_path": F.lit(path)}
    answers.withColumns(used).write.mode("overwrite").parquet(target)
    rejected_requests(requests).write.mode("overwrite").parquet(f"{target}_rejected")
    return tables
