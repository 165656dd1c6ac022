"""The tree on sparse one-hot vectors, against MLlib's own fit on the same vectors."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from stagefare.columns import Label
from stagefare.operators import trees
from stagefare.operators.features import one_hot_stages, slot_value
from stagefare.operators.sparse_tree import SparseTreeRegressor, thresholds
from stagefare.plans import training

LABEL = Label("y")
DIMS, NUMBERS = ("c", "d"), ("x", "w")


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers of few and of more than 32 values, one with negative values and zeros; categories of one row each."""
    k = F.col("id")
    made = spark.range(1500).select(
        "id",
        (k * 37 % 101 - 20).cast("double").alias("x"),
        (k * 11 % 12).cast("double").alias("w"),
        F.when(k % 50 == 0, F.concat(F.lit("rare "), k.cast("string"))).otherwise((k % 7).cast("string")).alias("c"),
        F.when(k % 13 == 0, None).otherwise((k * 29 % 17).cast("string")).alias("d"),
    )
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 50.0
    return made.withColumn("y", F.col("x") * 3 + F.when(F.col("c") == "3", 400.0).otherwise(0.0) + F.when(F.col("d") == "5", F.col("w") * 40).otherwise(0.0) + noise)


@pytest.fixture(scope="module")
def vectors(rows):
    return Pipeline(stages=one_hot_stages(DIMS, NUMBERS)).fit(rows).transform(rows)


@pytest.mark.parametrize("depth", [0, 1, 4, 8])
def test_it_is_mllibs_tree(vectors, depth):
    settings = dict(featuresCol="features", labelCol="y", maxDepth=depth)
    own, told = SparseTreeRegressor(**settings).fit(vectors), DecisionTreeRegressor(**settings).fit(vectors)
    assert (own.numNodes, own.depth, own.numFeatures) == (told.numNodes, told.depth, told.numFeatures)
    # Equal gains may go to other slots, which moves importance between them but parts no rows otherwise.
    assert own.featureImportances.toArray() == pytest.approx(told.featureImportances.toArray(), abs=1e-9 if depth < 8 else 1e-3)
    both = own.transform(vectors).select("id", "y", "features", F.col("prediction").alias("own"))
    both = told.transform(both)
    if depth < 8:
        assert both.agg(F.max(F.abs(F.col("own") - F.col("prediction")))).first()[0] < 1e-6
    found = both.agg(*[F.avg((F.col("y") - F.col(c)) ** 2).alias(c) for c in ("own", "prediction")]).first()
    assert found["own"] == pytest.approx(found["prediction"], rel=0.02)


def test_mllib_never_gets_a_row_with_all_its_slots(rows, monkeypatch):
    given, fit = [], DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, df, *a: given.append(df.count()) or fit(self, df, *a))
    renamed = rows.select("y", F.col("c").alias("genre"), F.col("d").alias("city"), F.lit("s").alias("subgenre"), F.lit("t").alias("state"),
                          F.col("x").alias("spotify_popularity"), F.col("w").alias("year"), F.lit(1).alias("month"), F.lit(2).alias("weekday"))
    model = training.one_hot_model("decision_tree", LABEL).fit(renamed)
    assert model.stages[-1].numNodes > 3 and sum(given) <= 2


def test_nodes_walk_sparse_vectors(spark, rows, vectors):
    model = Pipeline(stages=[SparseTreeRegressor(featuresCol="features", labelCol="y", maxDepth=5)]).fit(vectors)
    nodes = trees.all_nodes(spark, {"one": model})
    walked = trees.predict_by_nodes(model.transform(vectors), nodes)
    assert walked.agg(F.max(F.abs(F.col("prediction") - F.col("walked_one")))).first()[0] < 1e-9


def test_a_slot_is_looked_up(spark):
    from pyspark.ml.linalg import Vectors

    made = spark.createDataFrame([(0, Vectors.sparse(5, {1: 2.0, 4: -1.0})), (1, Vectors.dense([7.0, 0.0, 3.0]))], ["id", "v"])
    found = made.orderBy("id").select(*[slot_value(F.col("v"), F.lit(i)).alias(f"s{i}") for i in range(3)]).collect()
    assert [tuple(r) for r in found] == [(0.0, 2.0, 0.0), (7.0, 0.0, 3.0)]


def test_bad_labels_and_empty_tables_are_refused(vectors):
    regressor = SparseTreeRegressor(featuresCol="features", labelCol="y")
    with pytest.raises(Exception, match="labels"):
        regressor.fit(vectors.withColumn("y", F.when(F.col("id") > 3, F.col("y"))))
    with pytest.raises(ValueError, match="rows"):
        regressor.fit(vectors.filter("id < 0"))


def test_a_heavy_value_pushes_cuts_to_the_values_after_it():
    counts = [(0.0, 1000), *[(float(v), 1) for v in range(1, 60)]]
    assert thresholds(counts, 4) == [0.5, 1.5, 2.5]
    assert thresholds([(1.0, 5)], 32) == []


def test_a_level_reads_the_rows_once_and_shuffles_sums(vectors, monkeypatch):
    plans, best = [], SparseTreeRegressor._best_splits

    def seen(self, *given):
        found = best(self, *given)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(SparseTreeRegressor, "_best_splits", seen)
    SparseTreeRegressor(featuresCol="features", labelCol="y", maxDepth=3).fit(vectors)
    assert len(plans) == 3
    for plan in plans:
        initial = plan.rpartition("== Initial Plan ==")[-1]
        assert initial.count("FileScan parquet") == 1 and "Generate" not in initial and "aggregate(" not in initial


def test_sums_by_blocks_are_the_same(vectors, monkeypatch):
    """More slots than a task holds sums of; the workers take the limits from the function's arguments."""
    from stagefare.operators import slot_sums as ss
    from stagefare.operators import sparse_tree

    settings = dict(featuresCol="features", labelCol="y", maxDepth=4)
    want = SparseTreeRegressor(**settings).fit(vectors).toDebugString.split("\n")[1:]
    sums, given = ss.slot_sums, []
    monkeypatch.setattr(sparse_tree, "slot_sums", lambda *a: given.append(a) or sums(*a, most=1, block=100))
    assert SparseTreeRegressor(**settings).fit(vectors).toDebugString.split("\n")[1:] == want and given


def test_dense_vectors_and_null_ones(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([float(k % 5), float(k % 2), 0.0]) if k % 3 else Vectors.sparse(3, {0: float(k % 5), 1: float(k % 2)}), float(k % 5 + 10 * (k % 2))) for k in range(60)]
    made = spark.createDataFrame(rows, ["features", "y"])
    own, told = (kind(featuresCol="features", labelCol="y", maxDepth=5).fit(made) for kind in (SparseTreeRegressor, DecisionTreeRegressor))
    assert own.toDebugString.split("\n")[1:] == told.toDebugString.split("\n")[1:]
    with pytest.raises(Exception, match="vectors null"):
        SparseTreeRegressor(featuresCol="features", labelCol="y").fit(made.withColumn("features", F.when(F.col("y") != 3, F.col("features"))))
