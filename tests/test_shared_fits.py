"""Models that share the passes of a fit, against the same models fitted one by one."""

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from stagefare.columns import MEAN_FEATURES, Label
from stagefare.operators import moments, trees
from stagefare.operators.regressors import sweep_grid
from stagefare.plans import training

LABEL = Label("y")


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(3000).select(
        *[(F.xxhash64("id", F.lit(i)) % 97 * (i + 1) + 2000.0 * (i == 1)).alias(c) for i, c in enumerate(MEAN_FEATURES)]
    )
    noise = F.xxhash64(*MEAN_FEATURES) % 50
    return made.withColumn("y", F.col("year") * 2 - F.col("month") * 0.3 + noise).localCheckpoint()


def models(*kinds):
    return {n: training.mean_model(k, LABEL, **settings) for n, (k, settings) in sweep_grid().items() if k in kinds}


def test_linear_models_share_two_passes_and_are_the_same(rows, monkeypatch):
    read, fit = [], LinearRegression._fit

    def counted(self, dataset):
        read.append(dataset.count())
        return fit(self, dataset)

    grid = models("linear_regression", "lasso_regression", "elastic_net")
    alone = {n: m.fit(rows) for n, m in grid.items()}
    monkeypatch.setattr(LinearRegression, "_fit", counted)
    shared = training.fit_all(rows, grid)
    assert list(shared) == list(grid) and set(read) == {2 * (len(MEAN_FEATURES) + 1)}
    for n in grid:
        got, want = shared[n].stages[-1], alone[n].stages[-1]
        assert got.intercept == pytest.approx(want.intercept, rel=1e-6)
        assert list(got.coefficients) == pytest.approx(list(want.coefficients), rel=1e-6, abs=1e-9)


def test_cut_trees_are_the_lesser_fits(rows, monkeypatch):
    grid = models("decision_tree")
    alone = {n: m.fit(rows) for n, m in grid.items()}
    cut, depths = trees.cut_trees, []
    monkeypatch.setattr(training, "cut_trees", lambda spark, whole, some: depths.extend(some) or cut(spark, whole, some))
    shared = training.fit_all(rows, grid, parallelism=2)
    assert sorted(depths) == [6, 8, 10, 12, 15]
    for n in grid:
        got, want = shared[n].stages[-1], alone[n].stages[-1]
        assert got.toDebugString.split("\n")[1:] == want.toDebugString.split("\n")[1:]
        assert (got.getMaxDepth(), got.depth, got.numNodes) == (want.getMaxDepth(), want.depth, want.numNodes)
        assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray())


def test_rows_that_rounding_decides_are_fitted_whole(rows):
    columns = [*MEAN_FEATURES, "y"]
    assert moments.moment_rows(rows, columns) is not None
    assert moments.moment_rows(rows.filter("false"), columns) is None
    assert moments.moment_rows(rows.withColumn("month", F.lit(3.0)), columns) is None
    assert moments.moment_rows(rows.withColumn("month", F.col("year") * 2 + F.col("weekday")), columns) is None
    assert moments.moment_rows(rows.withColumn("month", F.when(F.col("month") > 3, F.col("month"))), columns) is None
    assert moments.moment_rows(rows.withColumn("month", F.when(F.col("month") > 3, F.lit(float("nan"))).otherwise(F.col("month"))), columns) is None
    flat = rows.withColumn("month", F.lit(3.0))
    grid = {n: m for n, m in models("linear_regression", "lasso_regression").items() if n in ("lr_1", "lasso_1")}
    fitted = training.fit_all(flat, grid)
    assert [fitted["lasso_1"].stages[-1].coefficients[2]] == [0.0]


def test_predictions_read_vectors_assembled_once(rows):
    fitted = training.fit_all(rows, {n: m for n, m in models("linear_regression", "decision_tree").items() if n in ("lr_1", "dt_1", "dt_2")})
    made, columns = training.predict_all(rows, fitted)
    assert made.columns == [*rows.columns, *columns.values()]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("VectorAssembler") <= 1 and plan.count("struct(spotify_popularity") <= 1
    for n, model in fitted.items():
        want = model.transform(rows).agg(F.sum("prediction")).first()[0]
        assert made.agg(F.sum(columns[n])).first()[0] == pytest.approx(want)
