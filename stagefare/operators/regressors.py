"""Regressors by name, their presets, and the parameter grid of the sweep."""

from __future__ import annotations

from itertools import product

from pyspark.ml.regression import (
    DecisionTreeRegressor,
    LinearRegression,
    RandomForestRegressor,
)

from stagefare.columns import Label
from stagefare.operators.boosted import BoostedRegressor
from stagefare.operators.sparse_tree import SparseTreeRegressor

SEED = 42

_CLASSES = {
    "linear_regression": LinearRegression,
    "lasso_regression": LinearRegression,
    "elastic_net": LinearRegression,
    "decision_tree": DecisionTreeRegressor,
    "random_forest": RandomForestRegressor,
    "gbt": BoostedRegressor,
}

# Settings per kind of model. ``one_hot`` lists what differs there.
SETTINGS = {
    "linear_regression": {"maxIter": 100},
    "lasso_regression": {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 1.0},
    "elastic_net": {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.7},
    "decision_tree": {"maxDepth": 8},
    "random_forest": {"numTrees": 100, "maxDepth": 20},
    "gbt": {"maxIter": 50, "maxDepth": 2},
}
ONE_HOT_SETTINGS = {
    "random_forest": {"maxDepth": 10},
    "gbt": {"maxDepth": 4},
}
# Settings small enough for a quick check of every kind on a workstation.
QUICK_SETTINGS = {
    "random_forest": {"numTrees": 10, "maxDepth": 5},
    "gbt": {"maxIter": 5},
    "decision_tree": {"maxDepth": 5},
}
# Full settings but for the forest, whose 100 trees of depth 20 a workstation does not fit in minutes.
PROBE_SETTINGS = {"random_forest": {"numTrees": 20, "maxDepth": 6}}
PRESETS = {"mean": {}, "one_hot": ONE_HOT_SETTINGS, "quick": QUICK_SETTINGS, "probe": PROBE_SETTINGS}

# Short names of the single-model job.
SHORT_NAMES = {"rf": "random_forest", "gbt": "gbt", "lr": "lasso_regression"}

KINDS = tuple(_CLASSES)


def make_regressor(kind: str, label: Label | str, preset: str = "mean", one_hot: bool = False, **params):
    """A regressor on ``features``; ``params`` override the preset's settings.

    On ``one_hot`` vectors, which have a slot for every category, a single tree is learnt from the slots that are set.
    """
    kind = SHORT_NAMES.get(kind, kind)
    settings = {**SETTINGS[kind], **PRESETS[preset].get(kind, {}), **params}
    if not issubclass(_CLASSES[kind], LinearRegression):
        settings.setdefault("seed", SEED)
    column = label.column if isinstance(label, Label) else label
    made = SparseTreeRegressor if one_hot and kind == "decision_tree" else _CLASSES[kind]
    return made(featuresCol="features", labelCol=column, **settings)


def sweep_grid() -> dict[str, tuple[str, dict]]:
    """The full parameter grid: model name to (kind, settings)."""
    families = {
        "lr": ("linear_regression", [{"maxIter": i} for i in (100, 200)]),
        "lasso": (
            "lasso_regression",
            [
                {"maxIter": i, "regParam": r, "elasticNetParam": 1.0}
                for i, r in product((100, 200), (0.1, 0.01, 0.05))
            ],
        ),
        "elastic_net": (
            "elastic_net",
            [
                {"maxIter": i, "regParam": r, "elasticNetParam": a}
                for i, a, r in product((100, 200), (0.5, 0.3, 0.7), (0.1, 0.05, 0.01))
            ],
        ),
        "dt": ("decision_tree", [{"maxDepth": d} for d in (6, 8, 10, 12, 15, 20)]),
        "rf": (
            "random_forest",
            [{"numTrees": 100, "maxDepth": d} for d in (6, 10, 15, 20)]
            + [{"numTrees": 200, "maxDepth": d} for d in (8, 10, 15, 20)],
        ),
        "gbt": (
            "gbt",
            [{"maxIter": 100, "maxDepth": d} for d in (6, 10, 4, 2)]
            + [{"maxIter": 50, "maxDepth": d} for d in (4, 2, 6, 10)],
        ),
    }
    return {
        f"{short}_{i}": (kind, settings)
        for short, (kind, choices) in families.items()
        for i, settings in enumerate(choices, start=1)
    }
