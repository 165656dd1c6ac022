"""Encoding, regressors, evaluation and training jobs."""

import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from stagefare.columns import MAX_PRICE, MEAN_FEATURES, MIN_PRICE, Label
from stagefare.operators import evaluate as ev
from stagefare.operators.encoding import MeanEncoder, load_encoding, save_encoding, with_joint_key
from stagefare.operators.features import dense_assembler
from stagefare.operators.regressors import KINDS, make_regressor, sweep_grid
from stagefare.operators.rows import random_split, valid_label
from stagefare.plans import training
from stagefare.sources.models import load_model

LABEL = Label("y")


@pytest.fixture(scope="module")
def known(spark):
    """Rows whose label follows from their features, but for little noise."""
    return spark.range(4000).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"),
        F.lit("A").alias("artist"),
        F.lit("2024-01-01").cast("date").alias("event_date"),
        (F.col("id") * 7 % 50).cast("int").alias("spotify_popularity"),
        (F.col("id") % 3 + 2020).cast("int").alias("year"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
        (F.col("id") % 7 + 1).cast("int").alias("weekday"),
        F.concat(F.lit("s"), F.col("id") % 5).alias("state"),
        F.concat(F.lit("c"), F.col("id") % 25).alias("city"),
        F.concat(F.lit("g"), F.col("id") % 4).alias("genre"),
        F.concat(F.lit("b"), F.col("id") % 8).alias("subgenre"),
        (F.col("id") * 7 % 50 * 2.0 + F.col("id") % 25 * 10.0 + F.col("id") % 2 + 5.0).alias("y"),
    )


@pytest.fixture(scope="module")
def data(known):
    return training.prepare_means(known, LABEL, written=True)


def test_valid_label(spark):
    df = spark.createDataFrame([(1.0, "a"), (0.0, "a"), (-1.0, "a"), (None, "a"), (1.0, None)], "p double, artist string")
    assert valid_label(df, Label("p")).count() == 1
    assert valid_label(df, Label("p", allow_zero=True)).count() == 2


def test_encoding_unseen_and_empty(spark):
    train = spark.createDataFrame([("x", 10.0), ("x", 20.0), ("y", 60.0)], "city string, y double")
    encoding = MeanEncoder(LABEL, ("city",)).fit(train)
    test = spark.createDataFrame([("x",), ("z",), (None,)], "city string")
    assert [r.city_avg_price for r in encoding.transform(test).collect()] == [15.0, 30.0, 30.0]
    none = MeanEncoder(LABEL, ("city",)).fit(train.filter("y < 0"))
    assert [r.city_avg_price for r in none.transform(test).collect()] == [0.0, 0.0, 0.0]


def test_encoding_leave_one_out(spark):
    train = spark.createDataFrame([("x", 10.0), ("x", 20.0), ("y", 60.0)], "city string, y double")
    encoding = MeanEncoder(LABEL, ("city",)).fit(train)
    got = {r.y: r.city_avg_price for r in encoding.transform(train, leave_one_out=True).collect()}
    assert got == {10.0: 20.0, 20.0: 10.0, 60.0: 30.0}


def test_joint_key_keeps_equal_names_apart(spark):
    rows = [("X", "A", 10.0), ("X", "B", 30.0)]
    df = with_joint_key(spark.createDataFrame(rows, "city string, state string, y double"), ("city", "state"), "place")
    encoding = MeanEncoder(LABEL, ("city", "place")).fit(df)
    got = [(r.city_avg_price, r.place_avg_price) for r in encoding.transform(df).orderBy("y").collect()]
    assert got == [(20.0, 10.0), (20.0, 30.0)]


def test_encoding_saved_and_loaded(spark, data, tmp_path):
    save_encoding(data.encoding, f"{tmp_path}/map")
    back = load_encoding(spark, f"{tmp_path}/map", LABEL)
    assert back.global_mean == data.encoding.global_mean
    a, b = back.table.select("dim", "key", "n"), data.encoding.table.select("dim", "key", "n")
    assert a.exceptAll(b).count() == 0 and a.count() == 5 + 25 + 4 + 8 + 1


def test_assembler_fails_on_null_by_default(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with pytest.raises(Exception):
        dense_assembler(["x"]).transform(df).collect()
    assert dense_assembler(["x"], "skip").transform(df).count() == 1


def test_measures_agree_with_mllib(data):
    model = training.mean_model("linear_regression", LABEL).fit(data.train)
    predictions = model.transform(data.test)
    ours = ev.evaluate(predictions, LABEL).first()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="y", metricName=name).evaluate(predictions)
        assert math.isclose(ours[name], theirs, rel_tol=1e-9)


@pytest.mark.parametrize("kind", KINDS)
def test_every_kind_learns_a_known_label(kind, data):
    model = training.mean_model(kind, LABEL, "quick").fit(data.train)
    result = ev.evaluate(model.transform(data.test), LABEL).first()
    assert result.r2 > 0.8
    baseline = training.mean_baseline(data.train.drop("city_avg_price"), data.test.drop("city_avg_price"), LABEL, ("genre",))
    assert result.rmse < ev.evaluate(baseline, LABEL).first().rmse


@pytest.mark.parametrize("kind", ["decision_tree", "random_forest"])
def test_trees_stay_in_range_and_repeat(kind, data):
    low, high = data.train.agg(F.min("y"), F.max("y")).first()
    fits = [training.mean_model(kind, LABEL, "quick").fit(data.train) for _ in range(2)]
    first, second = (m.transform(data.test).select("event_id", "prediction") for m in fits)
    assert first.exceptAll(second).count() == 0
    assert first.filter((F.col("prediction") < low) | (F.col("prediction") > high)).count() == 0
    values = ev.importance_values(fits[0], data.test)
    assert tuple(values) == MEAN_FEATURES and math.isclose(sum(values.values()), 1.0)


def test_one_hot_names_match_slots(known):
    model = training.one_hot_model("decision_tree", LABEL, maxDepth=4).fit(known)
    values = ev.importance_values(model, known)
    assert len(values) == 4 + 4 + 8 + 5 + 25
    assert set(values) >= {"spotify_popularity", "genre_vec_g0", "city_vec_c24", "state_vec_s4"}
    assert math.isclose(sum(values.values()), 1.0)


def test_short_names_and_presets():
    lasso = make_regressor("lr", MAX_PRICE)
    assert lasso.getElasticNetParam() == 1.0 and lasso.getRegParam() == 0.1
    assert make_regressor("rf", MAX_PRICE).getMaxDepth() == 20
    assert make_regressor("rf", MAX_PRICE, "one_hot").getMaxDepth() == 10
    assert make_regressor("gbt", MIN_PRICE).getLabelCol() == "tm_min_price"


def test_sweep_grid_is_full():
    grid = sweep_grid()
    kinds = [k for k, _ in grid.values()]
    assert len(grid) == 48
    assert [kinds.count(k) for k in KINDS] == [2, 6, 18, 6, 8, 8]
    assert len({(k, tuple(sorted(p.items()))) for k, p in grid.values()}) == 48


def test_compare_and_best(data):
    table, fitted = training.compare_models(data, LABEL, "quick", parallelism=3)
    rows = {r.model: r for r in table.collect()}
    assert set(rows) == set(KINDS) == set(fitted)
    single = ev.evaluate(fitted["gbt"].transform(data.test), LABEL).first()
    assert math.isclose(rows["gbt"].rmse, single.rmse, rel_tol=1e-12)
    best = ev.best_model(table).first()
    assert best.rmse == min(r.rmse for r in rows.values())


def test_sweep(data):
    grid = {k: v for k, v in sweep_grid().items() if k in ("lr_1", "lasso_2", "dt_1")}
    table, _ = training.sweep(data, LABEL, grid)
    assert {r.model for r in table.collect()} == set(grid)


def test_prediction_sample_is_ordered(data):
    model = training.mean_model("linear_regression", LABEL).fit(data.train)
    sample = ev.prediction_sample(model.transform(data.test), LABEL, n=10).collect()
    ids = sorted(r.event_id for r in data.test.select("event_id").collect())[:10]
    assert [r.event_id for r in sample] == ids
    assert all(math.isclose(r.error, abs(r.actual_price - r.predicted_price)) for r in sample)


def test_random_split_option(known):
    train, test = random_split(known)
    assert train.count() + test.count() == 4000


def test_train_job_saves_everything(spark, known, tmp_path):
    for one_hot in (False, True):
        out = f"{tmp_path}/{one_hot}"
        metrics = training.train_job(known, LABEL, out, "rf", one_hot, preset="quick")
        values = {r.metric: r.value for r in metrics.collect()}
        assert set(values) == {"RMSE", "MAE", "R2", "train_size", "test_size"}
        assert values["train_size"] + values["test_size"] == 4000
        predictions = spark.read.csv(f"{out}/predictions", header=True)
        assert predictions.count() == values["test_size"]
        names = spark.read.csv(f"{out}/feature_importance", header=True)
        assert names.count() == (46 if one_hot else 8)
        assert load_model(f"{out}/model").stages


def test_compare_job_saves_everything(spark, known, tmp_path):
    table = training.compare_job(known, LABEL, f"{tmp_path}/c", "quick", parallelism=3)
    assert table.count() == 6
    assert spark.read.json(f"{tmp_path}/c/metrics_comparison_json").count() == 6
    assert spark.read.csv(f"{tmp_path}/c/metrics_comparison_csv", header=True).count() == 6
    assert spark.read.csv(f"{tmp_path}/c/predictions_sample/gbt", header=True).count() == 100
    assert spark.read.csv(f"{tmp_path}/c/feature_importance/gbt", header=True).count() == 8
    assert load_model(f"{tmp_path}/c/models/lasso_regression").stages


def test_sweep_job_runs_in_batches(spark, known, tmp_path, monkeypatch):
    monkeypatch.setattr(training, "MODELS_PER_PASS", 2)
    grid = {k: v for k, v in sweep_grid().items() if k in ("lr_1", "lasso_2", "dt_1")}
    table = training.sweep_job(known, LABEL, f"{tmp_path}/s", grid)
    assert {r.model for r in table.collect()} == set(grid)
    assert spark.read.csv(f"{tmp_path}/s/predictions_sample/dt_1", header=True).count() == 100


def test_sweep_job_resumes_where_it_stopped(spark, known, tmp_path, monkeypatch):
    monkeypatch.setattr(training, "MODELS_PER_PASS", 1)
    grid = {k: v for k, v in sweep_grid().items() if k in ("lr_1", "lasso_1", "lasso_2", "dt_1")}
    whole = training.sweep_job(known, LABEL, f"{tmp_path}/whole", grid).collect()
    fits, fit_all = [], training.fit_all

    def stopped(train, models, parallelism=1):
        if len(fits) == 2:
            raise RuntimeError("stopped")
        fits.extend(models)
        return fit_all(train, models, parallelism)

    monkeypatch.setattr(training, "fit_all", stopped)
    with pytest.raises(RuntimeError):
        training.sweep_job(known, LABEL, f"{tmp_path}/s", grid)
    again = []
    monkeypatch.setattr(training, "fit_all", lambda t, m, p=1: (again.extend(m), fit_all(t, m, p))[1])
    resumed = training.sweep_job(known, LABEL, f"{tmp_path}/s", grid).collect()
    assert fits == ["lr_1", "lasso_1"] and again == ["lasso_2", "dt_1"]
    assert resumed == whole
    training.sweep_job(known, LABEL, f"{tmp_path}/s", grid)
    assert again == ["lasso_2", "dt_1"]


def test_forests_are_fitted_one_at_a_time():
    models = {n: training.mean_model(kind, LABEL, **params) for n, (kind, params) in sweep_grid().items()}
    found = training.passes(models)
    assert sorted(n for names in found for n in names) == sorted(models)
    assert all(len(names) == 1 for names in found if names[0].startswith("rf")) and max(map(len, found)) <= 8
