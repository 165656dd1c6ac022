"""Fitted models on disk: always whole pipelines, so scoring can start from columns."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def model_path(folder: str, name: str | None = None) -> str:
    """Where a training output keeps its model; ``name`` picks one of a comparison or sweep."""
    return f"{folder}/models/{name}" if name else f"{folder}/model"


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
