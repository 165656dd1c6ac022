"""Boosted trees from sums over pairs of bins, against MLlib's own fit."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from stagefare.columns import Label
from stagefare.operators import boosted, trees
from stagefare.operators.boosted import BoostedRegressor
from stagefare.plans import training

FEATURES = ("x", "w", "z")


@pytest.fixture(scope="module")
def rows(spark):
    """More rows than MLlib reads to cut features, zeros and negative values, rows of equal features and other labels."""
    k = F.col("id")
    made = spark.range(0, 16000, 1, 4).select(
        "id", (k * 37 % 4001 - 300).cast("double").alias("x"), (k * 11 % 12).cast("double").alias("w"), (F.xxhash64("id") % 50 / 7).alias("z")
    )
    noise = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 50.0
    return made.withColumn("y", F.col("x") * 3 + F.when(F.col("w") > 6, F.col("z") * 90).otherwise(0.0) + noise)


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(boosted, "LEAST_ROWS", 0)


def vectors(rows, features=FEATURES):
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(rows)


@pytest.mark.parametrize("features, settings", [
    (FEATURES, dict(maxDepth=2, maxIter=12)),
    (FEATURES, dict(maxDepth=1, maxIter=4, stepSize=0.3, minInstancesPerNode=40)),
    (("w",), dict(maxDepth=2, maxIter=3)),
    ((*FEATURES, "flat"), dict(maxDepth=2, maxIter=3, maxBins=8)),
])
def test_it_is_mllibs_model_without_mllib_reading_the_rows(rows, few, monkeypatch, features, settings):
    made = vectors(rows.withColumn("flat", F.lit(2.0)), features)
    settings = dict(featuresCol="features", labelCol="y", seed=42, **settings)
    told = GBTRegressor(**settings).fit(made)
    given, fit = [], GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: given.append(df.count()) or fit(self, df))
    own = BoostedRegressor(**settings).fit(made)
    assert given == [2]
    assert (own.getNumTrees, own.treeWeights, own.numFeatures, own.getMaxIter()) == (told.getNumTrees, told.treeWeights, told.numFeatures, told.getMaxIter())
    assert [t.numNodes for t in own.trees] == [t.numNodes for t in told.trees]
    assert own.featureImportances.toArray() == pytest.approx(told.featureImportances.toArray(), abs=1e-9)
    both = told.transform(own.transform(made).select("features", F.col("prediction").alias("own")))
    assert both.agg(F.max(F.abs(F.col("own") - F.col("prediction")))).first()[0] < 1e-8


def test_nodes_hold_what_mllibs_hold(spark, rows, few):
    settings = dict(featuresCol="features", labelCol="y", maxDepth=2, maxIter=5, seed=42)
    made = vectors(rows)
    found = []
    for kind in (BoostedRegressor, GBTRegressor):
        model = training.Pipeline(stages=[kind(**settings)]).fit(made)
        nodes = trees.all_nodes(spark, {"one": model}).orderBy("tree", "node").collect()
        found.append([(r["tree"], r["node"], r["left"], r["right"], r["feature"], r["rows"]) for r in nodes])
        found.append([[r["held"], r["prediction"], r["impurity"], r["gain"]] for r in nodes])
    assert found[0] == found[2]
    for own, told in zip(found[1], found[3], strict=True):
        assert own == pytest.approx(told, rel=1e-6, abs=1e-6)


def test_other_settings_and_small_tables_are_mllibs(rows, monkeypatch):
    made, given = vectors(rows), []
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: given.append(df.count()))
    settings = dict(featuresCol="features", labelCol="y", maxIter=1, maxDepth=2)
    BoostedRegressor(**settings).fit(made)
    monkeypatch.setattr(boosted, "LEAST_ROWS", 0)
    for other in (dict(maxDepth=3), dict(subsamplingRate=0.5), dict(lossType="absolute"), dict(featureSubsetStrategy="2"), dict(weightCol="w")):
        BoostedRegressor(**{**settings, **other}).fit(made)
    assert given == [16000] * 6


def test_bad_labels_are_refused(rows, few):
    regressor = BoostedRegressor(featuresCol="features", labelCol="y", maxIter=1, maxDepth=2)
    for bad in (None, float("nan"), float("inf")):
        with pytest.raises(Exception, match="labels"):
            regressor.fit(vectors(rows.withColumn("y", F.when(F.col("id") == 3, F.lit(bad).cast("double")).otherwise(F.col("y")))))


def test_the_job_takes_it(rows):
    assert type(training.mean_model("gbt", Label("y")).getStages()[-1]) is BoostedRegressor
