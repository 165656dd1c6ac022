"""Training jobs: one model, six models compared, the parameter sweep."""

from __future__ import annotations

import itertools
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagefare.columns import ENCODED_DIMS, MEAN_FEATURES, Label, mean_column
from stagefare.operators import evaluate as ev
from stagefare.operators.encoding import MeanEncoder, MeanEncoding, save_encoding, with_joint_key
from stagefare.operators.features import dense_assembler, one_hot_stages, slot_count
from stagefare.operators.moments import from_moments, moment_rows
from stagefare.operators.regressors import KINDS, SHORT_NAMES, make_regressor
from stagefare.operators.rows import hash_split, in_train, training_rows
from stagefare.operators.trees import cut_trees
from stagefare.sources.models import model_path, save_model
from stagefare.sources.outputs import write_report, write_rows, write_sorted
from stagefare.sources.scratch import exists, materialize

# What the training jobs read of a cleaned table besides the label.
ID_COLUMNS = ("event_id", "artist", "event_date")
INPUT_COLUMNS = ("spotify_popularity", "year", "month", "weekday", *ENCODED_DIMS)

SIDE = "in_train"


def split_by_id(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return hash_split(df, "event_id")


@dataclass
class Prepared:
    """Both sides of a split with their features, and the encoding they carry."""

    train: DataFrame
    test: DataFrame
    encoding: MeanEncoding | None


def labelled(cleaned: DataFrame, label: Label) -> DataFrame:
    """Only the columns that training reads, of usable rows."""
    columns = [*ID_COLUMNS, *INPUT_COLUMNS, label.column]
    return training_rows(cleaned.select(*columns), label)


# A city told apart from those of the same name in other states, in the place of the city alone.
JOINT_CITY = "city_state"
JOINT_DIMS = tuple(JOINT_CITY if d == "city" else d for d in ENCODED_DIMS)
JOINT_FEATURES = tuple(mean_column(JOINT_CITY) if f == mean_column("city") else f for f in MEAN_FEATURES)


def _both_sides(rows: DataFrame, encoding: MeanEncoding | None) -> Prepared:
    side = F.col(SIDE)
    return Prepared(rows.filter(side).drop(SIDE), rows.filter(~side).drop(SIDE), encoding)


def _encoded(
    cleaned: DataFrame, label: Label, leave_one_out: bool, joint_city: bool
) -> tuple[DataFrame, MeanEncoding]:
    """Mean-encoded rows of both sides, marked by SIDE."""
    rows = labelled(cleaned, label).withColumn(SIDE, in_train("event_id"))
    if joint_city:
        rows = with_joint_key(rows, ("city", "state"), JOINT_CITY)
    encoding = MeanEncoder(label, JOINT_DIMS if joint_city else ENCODED_DIMS).fit(rows.filter(SIDE))
    return encoding.transform(rows, F.col(SIDE) if leave_one_out else False), encoding


def prepare_means(
    cleaned: DataFrame,
    label: Label,
    leave_one_out: bool = False,
    written: bool = False,
    joint_city: bool = False,
) -> Prepared:
    """Split and mean-encode; means come from the training side only.

    ``written`` stores the encoded rows, for jobs that fit many models: one
    write for both sides, each then read without the other. ``joint_city`` takes
    the mean of a city in its state (``city_state``) for that of the city.
    """
    encoded, encoding = _encoded(cleaned, label, leave_one_out, joint_city)
    if written:
        encoded = materialize(encoded, "encoded", by=(SIDE,))
    return _both_sides(encoded, encoding)


def store_vectors(rows: DataFrame, features: PipelineModel, label: Label, path: str) -> DataFrame:
    """Write the assembled vectors of both sides as Parquet, and read them back.

    A row keeps what predictions show, the label and ``features``, whose slot names stay with the column.
    Fits and predictions that follow read vectors instead of assembling them again.
    """
    shown = [*ID_COLUMNS, "genre", "spotify_popularity", label.column]
    vectors = features.transform(rows).select(*shown, "features", SIDE)
    vectors.write.mode("overwrite").partitionBy(SIDE).parquet(path)
    return rows.sparkSession.read.schema(vectors.schema).parquet(path)


def vector_sizes(vectors: DataFrame) -> DataFrame:
    """``side, n_rows, vector_size`` of stored vectors; the size is that of the longest and shortest alike."""
    slots = slot_count(F.col("features"))
    return vectors.groupBy(F.when(F.col(SIDE), "train").otherwise("test").alias("side")).agg(
        F.count("*").alias("n_rows"), F.max(slots).alias("vector_size"), F.min(slots).alias("least_size")
    )


def mean_baseline(
    train: DataFrame, test: DataFrame, label: Label, dims: tuple[str, ...] = ("city",)
) -> DataFrame:
    """Test rows with the mean price of their category as the prediction."""
    encoding = MeanEncoder(label, dims).fit(train)
    return encoding.transform(test).withColumn("prediction", F.col(mean_column(dims[0])))


def mean_model(kind: str, label: Label, preset: str = "mean", features=MEAN_FEATURES, **params):
    """Unfitted pipeline of assembler and regressor over mean-encoded features."""
    regressor = make_regressor(kind, label, preset, **params)
    return Pipeline(stages=[dense_assembler(features), regressor])


def one_hot_model(kind: str, label: Label, preset: str = "one_hot", **params) -> Pipeline:
    """Unfitted pipeline of indexers, one-hot encoders, assembler and regressor."""
    return Pipeline(stages=[*one_hot_stages(), make_regressor(kind, label, preset, one_hot=True, **params)])


def fit_all(
    train: DataFrame, models: dict[str, Pipeline], parallelism: int = 1
) -> dict[str, PipelineModel]:
    """Fit several models on one table; ``parallelism`` jobs at a time.

    Models that can be had from the same passes over the table share them: linear models of the same features are fitted on rows with
    the table's moments (see ``moment_rows``), and of trees that differ in depth only the deepest is fitted and cut.
    """

    def fit(names: tuple[str, ...]) -> dict[str, PipelineModel]:
        stages = [models[n].getStages() for n in names]
        last = stages[0][-1]
        if len(names) > 1 and from_moments(last):
            columns = [*stages[0][0].getInputCols(), last.getLabelCol()]
            rows = moment_rows(train, columns)
            return {n: models[n].fit(train if rows is None else rows) for n in names}
        if len(names) > 1:
            depths = [s[-1].getMaxDepth() for s in stages]
            deepest = depths.index(max(depths))
            whole = models[names[deepest]].fit(train)
            others = [(n, d) for i, (n, d) in enumerate(zip(names, depths, strict=True)) if i != deepest]
            cut = cut_trees(train.sparkSession, whole.stages[-1], [d for _, d in others])
            fitted = {n: PipelineModel([*whole.stages[:-1], tree]) for (n, _), tree in zip(others, cut, strict=True)}
            return {**fitted, names[deepest]: whole}
        return {n: models[n].fit(train) for n in names}

    together = list(_together(models))
    if parallelism <= 1:
        found = map(fit, together)
    else:
        with ThreadPoolExecutor(parallelism) as pool:
            in_session = inheritable_thread_target(train.sparkSession)
            found = list(pool.map(in_session(fit), together))
    fitted = {n: m for group in found for n, m in group.items()}
    return {n: fitted[n] for n in models}


def _together(models: dict[str, Pipeline]) -> Iterable[tuple[str, ...]]:
    """Names of the models that share a fit, the others one by one."""
    groups: dict[tuple, list[str]] = {}
    for name, pipeline in models.items():
        *before, last = pipeline.getStages()
        key: tuple = (name,)
        if len(before) == 1 and isinstance(before[0], VectorAssembler):
            columns = (*before[0].getInputCols(), before[0].getHandleInvalid())
            if from_moments(last) and before[0].getHandleInvalid() == "error":
                key = ("linear", columns, last.getLabelCol())
            elif type(last) is DecisionTreeRegressor:
                settings = {p.name: v for p, v in last.extractParamMap().items() if p.name != "maxDepth"}
                key = ("tree", columns, str(sorted(settings.items())))
        groups.setdefault(key, []).append(name)
    return [tuple(names) for names in groups.values()]


def predict_all(
    test: DataFrame, fitted: dict[str, PipelineModel]
) -> tuple[DataFrame, dict[str, str]]:
    """Predictions of all models as columns of one table; its columns by model."""
    out, columns = test, {}
    kept, assembled = list(test.columns), {}
    for name, model in fitted.items():
        column = f"prediction_{name}"
        *before, last = model.stages
        if len(before) == 1 and isinstance(before[0], VectorAssembler) and last.getFeaturesCol() == before[0].getOutputCol():
            # Models of the same features read the same vectors, assembled once.
            inputs = (*before[0].getInputCols(), before[0].getHandleInvalid())
            if inputs not in assembled:
                assembled[inputs] = f"__features_{len(assembled)}"
                vectors = before[0].copy({before[0].outputCol: assembled[inputs]})
                out = vectors.transform(out)
            made = last.copy({last.featuresCol: assembled[inputs]}).transform(out)
        else:
            made = model.transform(out)
        out = made.select(*kept, *assembled.values(), F.col("prediction").alias(column))
        kept.append(column)
        columns[name] = column
    return out.drop(*assembled.values()), columns


def compare_fitted(test: DataFrame, fitted: dict[str, PipelineModel], label: Label) -> DataFrame:
    """``model, rmse, mae, r2`` of all models from one pass over the test rows."""
    predictions, columns = predict_all(test, fitted)
    return ev.compare_predictions(predictions, label, columns)


def compare_models(
    data: Prepared, label: Label, preset: str = "mean", kinds=KINDS, parallelism: int = 1
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit one model of every kind; their comparison and the models."""
    models = {k: mean_model(k, label, preset) for k in kinds}
    fitted = fit_all(data.train, models, parallelism)
    return compare_fitted(data.test, fitted, label), fitted


def sweep(
    data: Prepared, label: Label, grid: dict[str, tuple[str, dict]], parallelism: int = 1
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit every entry of a parameter grid (see ``sweep_grid``)."""
    models = {n: mean_model(kind, label, **params) for n, (kind, params) in grid.items()}
    fitted = fit_all(data.train, models, parallelism)
    return compare_fitted(data.test, fitted, label), fitted


def train_job(
    cleaned: DataFrame,
    label: Label,
    target: str,
    kind: str = "rf",
    one_hot: bool = False,
    preset: str | None = None,
    leave_one_out: bool = False,
    joint_city: bool = False,
    **params,
) -> DataFrame:
    """Train one model; save it with its vectors, encoding, predictions, metrics and importances.

    The regressor is fitted on the stored vectors; the saved model has the feature stages before it, so
    scoring starts from columns. A model with ``joint_city`` is for comparison: requests are scored by city, and it refuses them.
    """
    if one_hot:
        if leave_one_out or joint_city:
            raise ValueError("leave_one_out and joint_city are for mean-encoded features")
        rows = labelled(cleaned, label).withColumn(SIDE, in_train("event_id"))
        stages = one_hot_stages()
    else:
        rows, encoding = _encoded(cleaned, label, leave_one_out, joint_city)
        save_encoding(encoding, f"{target}/avg_encoding")
        stages = [dense_assembler(JOINT_FEATURES if joint_city else MEAN_FEATURES)]
    features = Pipeline(stages=stages).fit(rows.filter(SIDE))
    vectors = store_vectors(rows, features, label, f"{target}/features")
    data = _both_sides(vectors, None)
    regressor = make_regressor(kind, label, preset or ("one_hot" if one_hot else "mean"), one_hot, **params)
    fitted = regressor.fit(data.train)
    model = PipelineModel([*features.stages, fitted])
    save_model(model, model_path(target))
    predictions = materialize(fitted.transform(data.test).drop("features"), "predictions")
    write_rows(ev.prediction_table(predictions, label), f"{target}/predictions")
    sizes = vector_sizes(vectors)
    write_report(sizes, f"{target}/feature_sizes")
    counts = {r["side"]: r["n_rows"] for r in sizes.collect()}
    metrics = ev.metrics_long(ev.evaluate(predictions, label), counts.get("train", 0), counts.get("test", 0))
    write_report(metrics, f"{target}/metrics")
    if SHORT_NAMES.get(kind, kind) in ("decision_tree", "random_forest", "gbt"):
        table = ev.feature_importance(PipelineModel([fitted]), data.test)
        # One-hot features have a slot for every category, so their table grows.
        order = ("-importance", "feature")
        write_sorted(table, f"{target}/feature_importance", order) if one_hot else write_report(table, f"{target}/feature_importance")
    return cleaned.sparkSession.read.csv(f"{target}/metrics", header=True, inferSchema=True)


# Models whose predictions share a pass over the test rows, and which the driver holds at a time.
MODELS_PER_PASS = 8


def passes(models: dict[str, Pipeline]) -> list[tuple[str, ...]]:
    """Names by pass: MODELS_PER_PASS at a time, but every forest by itself, as deep forests are large."""
    forests = [n for n, m in models.items() if isinstance(m.getStages()[-1], RandomForestRegressor)]
    others = [n for n in models if n not in forests]
    return [*itertools.batched(others, MODELS_PER_PASS), *((n,) for n in forests)]


def ledger_path(target: str, name: str) -> str:
    """Where a finished entry of a comparison or sweep leaves its metrics, after all its other outputs."""
    return f"{target}/ledger/{name}"


def _finish(data: Prepared, label: Label, target: str, fitted: dict[str, PipelineModel]) -> None:
    """Save models with their samples and importances; their ledger entries come last."""
    predictions, columns = predict_all(data.test, fitted)
    metrics = {r["model"]: r for r in ev.compare_predictions(predictions, label, columns).collect()}
    sample = materialize(ev.first_rows(predictions, "event_id"), "sample")
    for name, model in fitted.items():
        save_model(model, model_path(target, name))
        shown = ev.prediction_sample(sample, label, prediction=columns[name])
        write_report(shown, f"{target}/predictions_sample/{name}")
        if hasattr(model.stages[-1], "featureImportances"):
            importance = ev.feature_importance(model, data.test)
            write_report(importance, f"{target}/feature_importance/{name}")
        row = ev.comparison_table(sample.sparkSession, [tuple(metrics[name])])
        row.coalesce(1).write.mode("overwrite").parquet(ledger_path(target, name))


def _fit_and_save(
    cleaned: DataFrame, label: Label, target: str, models: dict[str, Pipeline], parallelism: int
) -> DataFrame:
    """Fit models pass by pass and save each, then all metrics.

    A restart on the same target fits only the models that have no ledger entry; split, encoding and seeds do not depend
    on the run, so the result is that of a run without a stop.
    """
    spark = cleaned.sparkSession
    left = {n: m for n, m in models.items() if not exists(spark, ledger_path(target, n))}
    if left:
        data = prepare_means(cleaned, label, written=True)
        save_encoding(data.encoding, f"{target}/avg_encoding")
        for names in passes(left):
            _finish(data, label, target, fit_all(data.train, {n: left[n] for n in names}, parallelism))
    ledger = spark.read.schema(ev.COMPARISON_SCHEMA).parquet(*[ledger_path(target, n) for n in models])
    found = {r["model"]: tuple(r) for r in ledger.collect()}
    comparison = ev.comparison_table(spark, [found[n] for n in models])
    write_report(comparison, f"{target}/metrics_comparison_csv")
    write_report(comparison, f"{target}/metrics_comparison_json", "json")
    return comparison


def compare_job(
    cleaned: DataFrame, label: Label, target: str, preset: str = "mean", parallelism: int = 1
) -> DataFrame:
    """Train the six models; save models, samples, importances and the comparison."""
    models = {k: mean_model(k, label, preset) for k in KINDS}
    return _fit_and_save(cleaned, label, target, models, parallelism)


def sweep_job(
    cleaned: DataFrame,
    label: Label,
    target: str,
    grid: dict[str, tuple[str, dict]],
    parallelism: int = 1,
) -> DataFrame:
    """Train a parameter grid and save the same outputs as :func:`compare_job`."""
    models = {n: mean_model(kind, label, **params) for n, (kind, params) in grid.items()}
    return _fit_and_save(cleaned, label, target, models, parallelism)
