"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagefare.catalog.fixture import DECIMALS, NUDGE, cleaned_listings, raw_listings
from stagefare.catalog.fixture import requests as request_table
from stagefare.columns import (
    ENCODED_DIMS,
    MAX_PRICE,
    MEAN_FEATURES,
    MIN_PRICE,
    ONE_HOT_DIMS,
    Label,
    mean_column,
)
from stagefare.operators import evaluate as ev
from stagefare.operators import distinct, profile, reports, score, trees
from stagefare.operators.category_index import apply_index, category_index
from stagefare.operators.clean import clean_listings, typed_listings, with_derived
from stagefare.operators.encoding import (
    MeanEncoder,
    encoding_map,
    load_encoding,
    save_encoding,
)
from stagefare.operators.features import dense_assembler, indexer, one_hot_encoder
from stagefare.operators.regressors import sweep_grid
from stagefare.operators.rows import dedup, in_train, require
from stagefare.operators.rows import fill_missing as fill_constants
from stagefare.plans import training
from stagefare.plans.cleaning import GROWING, clean_job, clean_table
from stagefare.sources.listings import read_clean, read_raw, write_clean
from stagefare.sources.models import load_model, save_model
from stagefare.sources.outputs import export_csv, read_sorted, write_report, write_rows, write_sorted
from stagefare.sources.scratch import materialize, new_path, remove

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-06-15"

_queries: dict[str, Query] = {}


def shown(df: DataFrame) -> DataFrame:
    """Doubles rounded and dates as text, so results compare across engines."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c + NUDGE, DECIMALS)
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(fn: Query) -> Query:
    _queries[fn.__name__] = lambda spark, sf_dir: shown(fn(spark, sf_dir))
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_listings(raw_listings(spark, sf_dir))


# -- sources and sinks ------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "raw-csv")
    write_rows(raw_listings(spark, sf_dir), path)
    return clean_listings(read_raw(spark, path))


@query
def clean_partitioned_roundtrip(spark, sf_dir):
    path = new_path(spark, "cleaned-copy")
    write_clean(clean_table(raw_listings(spark, sf_dir)), path)
    return read_clean(spark, path)


@query
def clean_incremental(spark, sf_dir):
    """Two batches merged; ids of even hash come back 40 days later, those of odd hash 40 days earlier, which loses."""
    raw = raw_listings(spark, sf_dir)
    earlier = F.coalesce(F.date_sub(F.col("date").try_cast("date"), 40).cast("string"), "date")
    later_wins = F.pmod(F.xxhash64("TM_id"), F.lit(2)) == 0
    path, target = new_path(spark, "batch"), new_path(spark, "merged-months")
    for number, shifted in enumerate((later_wins, ~later_wins)):
        batch = raw.withColumn("date", F.when(shifted, earlier).otherwise(F.col("date")))
        # The ids come in both batches, except those of a third, which come in one.
        third = F.pmod(F.xxhash64("TM_id"), F.lit(3))
        write_rows(batch.filter(F.col("TM_id").isNull() | (third != 0) | ~shifted), f"{path}-{number}")
        clean_job(spark, f"{path}-{number}", target, only_touched=True)
        # A batch that is merged is not read again.
        remove(spark, f"{path}-{number}")
    return read_clean(spark, target)


@query
def quality_counts_one_pass(spark, sf_dir):
    path, target = new_path(spark, "raw-counted"), new_path(spark, "counted")
    write_rows(raw_listings(spark, sf_dir), path)
    return clean_job(spark, path, target)["quality_counts"]


@query
def report_order_roundtrip(spark, sf_dir):
    path = new_path(spark, "report-parts")
    report = reports.report_year_genre(cleaned_listings(spark, sf_dir))
    write_sorted(report, path, GROWING["events_per_year_genre"], parts=5)
    schema = "year int, genre string, event_count bigint, avg_price double, avg_popularity double"
    return read_sorted(spark, path, schema).select("position", "year", "genre", "event_count")


@query
def metrics_json_roundtrip(spark, sf_dir):
    path = new_path(spark, "metrics-json")
    write_report(_baseline_comparison(spark, sf_dir), path, "json")
    return spark.read.schema(ev.COMPARISON_SCHEMA).json(path)


@query
def report_csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "report-csv")
    write_report(reports.report_secondary_market(cleaned_listings(spark, sf_dir)), path)
    schema = (
        "genre string, event_count bigint, avg_seatgeek_price double, avg_stubhub_max double,"
        " avg_tm_price double, avg_premium_pct double"
    )
    return spark.read.schema(schema).csv(path, header=True)


@query
def parquet_to_csv(spark, sf_dir):
    source, target = new_path(spark, "to-export"), new_path(spark, "exported")
    cleaned = cleaned_listings(spark, sf_dir)
    cleaned.write.parquet(source)
    export_csv(spark, source, target)
    return spark.read.schema(cleaned.schema).csv(target, header=True)


@query
def encoding_map_roundtrip(spark, sf_dir):
    path = new_path(spark, "encoding-copy")
    save_encoding(MeanEncoder(MAX_PRICE).fit(_train(spark, sf_dir, MAX_PRICE)), path)
    return load_encoding(spark, path, MAX_PRICE).table.select("dim", "key", "avg_price", "n")


@query
def model_roundtrip(spark, sf_dir):
    train, test = _sides(spark, sf_dir, MAX_PRICE)
    path = new_path(spark, "model")
    save_model(_linear(train, MAX_PRICE, ("spotify_popularity",)), path)
    return load_model(path).transform(test).select("event_id", "prediction")


# -- cleaning ---------------------------------------------------------------


@query
def clean_artist(spark, sf_dir):
    return _typed(spark, sf_dir).select("event_id", "artist")


@query
def clean_artist_first(spark, sf_dir):
    return clean_listings(raw_listings(spark, sf_dir), "first").select("event_id", "artist")


@query
def clean_popularity(spark, sf_dir):
    return _typed(spark, sf_dir).select("event_id", "spotify_popularity", "spotify_followers")


@query
def clean_dates(spark, sf_dir):
    return _typed(spark, sf_dir).select("event_id", "event_date")


@query
def clean_timestamps(spark, sf_dir):
    return _typed(spark, sf_dir).select("event_id", "presale_start", "presale_end", "sale_start")


@query
def clean_numeric(spark, sf_dir):
    return _typed(spark, sf_dir).select(
        "event_id",
        "venue_lat",
        "venue_long",
        "tm_max_price",
        "tm_min_price",
        "sg_avg_price",
        "sg_min_price",
        "sg_max_price",
        "sg_artist_score",
        "sg_venue_score",
        "sh_max_price",
        "sh_min_price",
    )


@query
def clean_counts(spark, sf_dir):
    return _typed(spark, sf_dir).select(
        "event_id", "sg_listing_count", "sh_total_postings", "sh_total_tickets"
    )


@query
def derive_price_range(spark, sf_dir):
    return _typed(spark, sf_dir).select("event_id", "price_range")


@query
def derive_flags(spark, sf_dir):
    return _typed(spark, sf_dir).select("event_id", "has_spotify_data", "has_secondary_market")


@query
def derive_calendar(spark, sf_dir):
    return _typed(spark, sf_dir).select("event_id", "year", "month", "weekday", "is_weekend")


@query
def clean_listing(spark, sf_dir):
    return clean_table(raw_listings(spark, sf_dir))


@query
def filter_required(spark, sf_dir):
    rows = require(_typed(spark, sf_dir), ("event_id", "event_date", "artist"))
    return rows.select("event_id", "event_date", "artist", "venue")


@query
def dedup_events(spark, sf_dir):
    typed = typed_listings(raw_listings(spark, sf_dir))
    return with_derived(dedup(typed, ["event_id"], prefer=("event_date", "artist")))


@query
def fill_missing(spark, sf_dir):
    filled = fill_constants(_typed(spark, sf_dir))
    return filled.select("event_id", "spotify_popularity", "genre", "subgenre", "city", "state")


# -- reports ----------------------------------------------------------------


def _report(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    _queries[name] = lambda spark, sf_dir: shown(build(cleaned_listings(spark, sf_dir)))


for _name in (
    "report_year_genre",
    "report_top_cities",
    "report_top_artists",
    "report_weekday",
    "report_secondary_market",
    "report_price_by_state",
    "summary_overall",
    "summary_genre_top10",
    "coverage",
    "clean_stats",
):
    _report(_name, getattr(reports, _name))


@query
def distinct_by_year_estimated(spark, sf_dir):
    """Whether estimates from stored monthly sketches are within three standard errors (one at least) of the counts."""
    cleaned = cleaned_listings(spark, sf_dir)
    sketches = materialize(distinct.distinct_sketches(cleaned), "sketches")
    found = distinct.distinct_between(sketches, by=("year",))
    exact = cleaned.groupBy("year").agg(*[F.count_distinct(c).alias(f"exact_{c}") for c in distinct.COUNTED])
    near = [
        (F.abs(F.col(f"unique_{c}") - F.col(f"exact_{c}"))
         <= F.greatest(F.lit(1.0), 3 * distinct.relative_error() * F.col(f"exact_{c}"))).alias(f"{c}_near")
        for c in distinct.COUNTED
    ]
    return found.join(exact, "year").select("year", "n_events", *[f"exact_{c}" for c in distinct.COUNTED], *near)


@query
def quality_counts(spark, sf_dir):
    return reports.quality_counts(_typed(spark, sf_dir))


# -- training rows, split, encoding -----------------------------------------


def _base(spark, sf_dir, label: Label) -> DataFrame:
    return training.labelled(cleaned_listings(spark, sf_dir), label)


def _sides(spark, sf_dir, label: Label) -> tuple[DataFrame, DataFrame]:
    return training.split_by_id(_base(spark, sf_dir, label))


def _train(spark, sf_dir, label: Label) -> DataFrame:
    return _sides(spark, sf_dir, label)[0]


@query
def ml_base_max(spark, sf_dir):
    return _base(spark, sf_dir, MAX_PRICE)


@query
def ml_base_min(spark, sf_dir):
    return _base(spark, sf_dir, MIN_PRICE)


@query
def split_counts(spark, sf_dir):
    side = F.when(in_train("event_id"), "train").otherwise("test")
    base = _base(spark, sf_dir, MAX_PRICE)
    return base.groupBy(side.alias("side")).agg(F.count("*").alias("n"))


@query
def split_train(spark, sf_dir):
    return _train(spark, sf_dir, MAX_PRICE).select("event_id", "tm_max_price")


@query
def encoding_map_max(spark, sf_dir):
    return encoding_map(_train(spark, sf_dir, MAX_PRICE), MAX_PRICE).drop("total")


@query
def encoding_map_min(spark, sf_dir):
    return encoding_map(_train(spark, sf_dir, MIN_PRICE), MIN_PRICE).drop("total")


_MEANS = [mean_column(d) for d in ENCODED_DIMS]


@query
def encode_train(spark, sf_dir):
    train = _train(spark, sf_dir, MAX_PRICE)
    return MeanEncoder(MAX_PRICE).fit(train).transform(train).select("event_id", *_MEANS)


@query
def encode_train_leave_one_out(spark, sf_dir):
    train = _train(spark, sf_dir, MAX_PRICE)
    encoded = MeanEncoder(MAX_PRICE).fit(train).transform(train, leave_one_out=True)
    return encoded.select("event_id", *_MEANS)


@query
def encode_test(spark, sf_dir):
    train, test = _sides(spark, sf_dir, MIN_PRICE)
    return MeanEncoder(MIN_PRICE).fit(train).transform(test).select("event_id", *_MEANS)


@query
def encode_joint_city(spark, sf_dir):
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MAX_PRICE, joint_city=True)
    return data.test.select("event_id", "city_state", mean_column("city_state"))


@query
def stored_vector_sizes(spark, sf_dir):
    target = new_path(spark, "trained")
    training.train_job(cleaned_listings(spark, sf_dir), MAX_PRICE, target, "lr")
    return spark.read.schema("side string, n_rows bigint, vector_size int, least_size int").csv(f"{target}/feature_sizes", header=True)


@query
def stored_vectors(spark, sf_dir):
    """The slots of the stored test vectors, as columns named by the vector column's own attributes."""
    target = new_path(spark, "trained")
    training.train_job(cleaned_listings(spark, sf_dir), MAX_PRICE, target, "lr")
    test = spark.read.parquet(f"{target}/features").filter(f"{training.SIDE} = 'false'")
    names = [a["name"] for a in test.schema["features"].metadata["ml_attr"]["attrs"]["numeric"]]
    slots = vector_to_array("features")
    return test.select("event_id", *[slots[i].alias(n) for i, n in enumerate(names)])


# -- MLlib features ---------------------------------------------------------


@query
def string_index(spark, sf_dir):
    train, test = _sides(spark, sf_dir, MAX_PRICE)
    indexed = apply_index(test, category_index(train, ONE_HOT_DIMS), ONE_HOT_DIMS)
    entries = [
        F.struct(F.lit(d).alias("dim"), F.col(d).alias("label"), F.col(f"{d}_idx").alias("idx"))
        for d in ONE_HOT_DIMS
    ]
    return indexed.select(F.inline(F.array(*entries))).groupBy("dim", "label", "idx").count()


@query
def string_index_models(spark, sf_dir):
    """Rows whose index by the table differs from that of MLlib's indexer, by column."""
    train, test = _sides(spark, sf_dir, MAX_PRICE)
    own = apply_index(test, category_index(train, ONE_HOT_DIMS), ONE_HOT_DIMS)
    own = own.withColumnsRenamed({f"{d}_idx": f"{d}_own" for d in ONE_HOT_DIMS})
    both = indexer().fit(train).transform(own)
    entries = [F.struct(F.lit(d).alias("dim"), (F.col(f"{d}_idx") != F.col(f"{d}_own")).alias("off")) for d in ONE_HOT_DIMS]
    return both.select(F.inline(F.array(*entries))).groupBy("dim").agg(F.count_if("off").alias("n_off"), F.count("*").alias("n_rows"))


@query
def one_hot_counts(spark, sf_dir):
    train, test = _sides(spark, sf_dir, MAX_PRICE)
    coded = Pipeline(stages=[indexer(), one_hot_encoder()]).fit(train).transform(test)
    sums = coded.agg(*[Summarizer.sum(F.col(f"{d}_vec")).alias(d) for d in ONE_HOT_DIMS])
    entries = [
        F.struct(F.lit(d).alias("dim"), vector_to_array(F.col(d)).alias("totals"))
        for d in ONE_HOT_DIMS
    ]
    rows = sums.select(F.inline(F.array(*entries)))
    return rows.select("dim", F.posexplode("totals").alias("slot", "total"))


@query
def assemble_dense(spark, sf_dir):
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MAX_PRICE)
    made = dense_assembler().transform(data.test)
    values = made.select("event_id", vector_to_array("features").alias("v"))
    return values.select("event_id", *[F.col("v")[i].alias(n) for i, n in enumerate(MEAN_FEATURES)])


@query
def assemble_skip(spark, sf_dir):
    columns = ("spotify_popularity", "tm_max_price", "month")
    rows = cleaned_listings(spark, sf_dir).select("event_id", *columns)
    made = dense_assembler(columns, "skip").transform(rows)
    values = made.select("event_id", vector_to_array("features").alias("v"))
    return values.select("event_id", *[F.col("v")[i].alias(n) for i, n in enumerate(columns)])


# -- regressors -------------------------------------------------------------


def _linear(train, label: Label, features, kind="linear_regression", **params) -> PipelineModel:
    model = training.mean_model(kind, label, features=features, solver="normal", **params)
    return model.fit(train.select(*features, label.column))


def _coefficients(spark, train, kinds: dict[str, tuple[str, tuple[str, ...]]]) -> DataFrame:
    rows = []
    for name, (kind, features) in kinds.items():
        fitted = _linear(train, MAX_PRICE, features, kind).stages[-1]
        for feature, weight in zip(features, fitted.coefficients):
            rows.append((name, feature, float(weight)))
        rows.append((name, "intercept", float(fitted.intercept)))
    return spark.createDataFrame(rows, "model string, term string, weight double")


@query
def fit_linear(spark, sf_dir):
    kinds = {
        "one": ("linear_regression", ("spotify_popularity",)),
        "two": ("linear_regression", ("spotify_popularity", "month")),
    }
    return _coefficients(spark, _train(spark, sf_dir, MAX_PRICE), kinds)


@query
def fit_lasso(spark, sf_dir):
    kinds = {"lasso": ("lasso_regression", ("spotify_popularity",))}
    return _coefficients(spark, _train(spark, sf_dir, MAX_PRICE), kinds)


@query
def fit_elastic_net(spark, sf_dir):
    kinds = {"elastic_net": ("elastic_net", ("spotify_popularity",))}
    return _coefficients(spark, _train(spark, sf_dir, MAX_PRICE), kinds)


def _breaches(rows: DataFrame, label: Label, model: PipelineModel) -> dict[str, float]:
    """By term, how far a linear model is from the conditions that the best coefficients meet.

    The error of the best model does not vary with a feature, but for the pull of its
    penalties; a coefficient that the L1 penalty holds at zero has a weaker pull on it.
    """
    fitted, y = model.stages[-1], F.col(label.column)
    spread = rows.agg(*[F.stddev_pop(c).alias(c) for c in (*MEAN_FEATURES, label.column)]).first()
    missed = model.transform(rows).withColumn("missed", y - F.col("prediction"))
    pull = missed.agg(
        F.avg("missed").alias("intercept"), *[F.covar_pop(f, "missed").alias(f) for f in MEAN_FEATURES]
    ).first()
    of_label = spread[label.column]
    strength, l1 = fitted.getRegParam() / of_label, fitted.getElasticNetParam()
    found = {"intercept": abs(pull["intercept"]) / of_label}
    for feature, weight in zip(MEAN_FEATURES, fitted.coefficients, strict=True):
        if not spread[feature]:
            found[feature] = abs(float(weight))
            continue
        slope = pull[feature] / (spread[feature] * of_label)
        scaled = float(weight) * spread[feature] / of_label
        slope -= strength * (1 - l1) * scaled
        held = strength * l1
        found[feature] = abs(slope - math.copysign(held, scaled)) if scaled else max(0.0, abs(slope) - held)
    return found


@query
def linear_optimality(spark, sf_dir):
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MAX_PRICE, written=True)
    rows = data.train.select(*MEAN_FEATURES, MAX_PRICE.column)
    found = []
    for kind in ("linear_regression", "lasso_regression", "elastic_net"):
        model = training.mean_model(kind, MAX_PRICE, solver="normal").fit(rows)
        found += [(kind, term, breach) for term, breach in _breaches(rows, MAX_PRICE, model).items()]
    return spark.createDataFrame(found, "model string, term string, breach double")


def _month_predictions(spark, sf_dir, kind: str, **params) -> DataFrame:
    train, test = _sides(spark, sf_dir, MAX_PRICE)
    model = training.mean_model(kind, MAX_PRICE, features=("month",), **params)
    fitted = model.fit(train.select("month", "tm_max_price"))
    return fitted.transform(test).select("event_id", "month", "prediction")


@query
def fit_decision_tree(spark, sf_dir):
    return _month_predictions(spark, sf_dir, "decision_tree", maxDepth=2)


@query
def forest_without_bootstrap(spark, sf_dir):
    return _month_predictions(
        spark,
        sf_dir,
        "random_forest",
        numTrees=3,
        maxDepth=2,
        bootstrap=False,
        featureSubsetStrategy="all",
    )


@query
def fit_gbt(spark, sf_dir):
    return _month_predictions(spark, sf_dir, "gbt", maxIter=2, maxDepth=1)


@query
def fit_random_forest(spark, sf_dir):
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MAX_PRICE, written=True)
    model = training.mean_model("random_forest", MAX_PRICE, "probe").fit(data.train)
    return ev.evaluate(model.transform(data.test), MAX_PRICE)


@query
def one_hot_linear(spark, sf_dir):
    train, test = _sides(spark, sf_dir, MAX_PRICE)
    model = training.one_hot_model("lr", MAX_PRICE).fit(train)
    return ev.evaluate(model.transform(test), MAX_PRICE)


@query
def compare_models(spark, sf_dir):
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MAX_PRICE, written=True)
    return training.compare_models(data, MAX_PRICE, "probe", parallelism=3)[0]


# Families of the sweep that a workstation fits in a short time; forests and boosted trees are left to ``sweep_job``.
_SWEPT = ("linear_regression", "lasso_regression", "elastic_net", "decision_tree")


@query
def sweep_models(spark, sf_dir):
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MIN_PRICE, written=True)
    grid = {name: entry for name, entry in sweep_grid().items() if entry[0] in _SWEPT}
    return training.sweep(data, MIN_PRICE, grid, parallelism=4)[0]


# -- trees as tables: differences between what node rows say and what the models say ---------


def _tree_models(spark, sf_dir):
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MAX_PRICE, written=True)
    models = {k: training.mean_model(k, MAX_PRICE, "probe") for k in ("decision_tree", "gbt", "random_forest")}
    fitted = training.fit_all(data.train, models, parallelism=3)
    return data, fitted, trees.all_nodes(spark, fitted)


def _prediction_off(test: DataFrame, fitted: dict[str, PipelineModel], nodes: DataFrame) -> DataFrame:
    predictions, columns = training.predict_all(test, fitted)
    assembled = PipelineModel(next(iter(fitted.values())).stages[:-1]).transform(predictions)
    walked = trees.predict_by_nodes(assembled, nodes)
    off = [F.struct(F.lit(n).alias("model"), F.max(F.abs(F.col(c) - F.col(f"walked_{n}"))).alias("prediction_off")) for n, c in columns.items()]
    counted = walked.agg(F.count("*").alias("n_rows"), F.array(*off).alias("models"))
    return counted.select("n_rows", F.inline("models")).select("model", "n_rows", "prediction_off")


@query
def tree_predictions_check(spark, sf_dir):
    data, fitted, nodes = _tree_models(spark, sf_dir)
    return _prediction_off(data.test, fitted, nodes)


@query
def tree_leaves_check(spark, sf_dir):
    """Leaves of the full tree against the training rows that end in them."""
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MAX_PRICE, written=True)
    model = training.mean_model("decision_tree", MAX_PRICE).fit(data.train)
    nodes = trees.all_nodes(spark, {"decision_tree": model})
    rows = PipelineModel(model.stages[:-1]).transform(data.train)
    found = trees.leaf_statistics(rows, nodes, MAX_PRICE.column).withColumnsRenamed({"rows": "n", "model": "of"})
    leaves = nodes.filter("left < 0").join(found.drop("tree", "of"), "node", "full")
    return leaves.agg(
        F.sum(F.col("n")).alias("n_rows"),
        F.sum(F.when(F.col("n").eqNullSafe(F.col("rows")), 0).otherwise(1)).alias("rows_off"),
        F.max(F.abs(F.col("mean") - F.col("prediction"))).alias("mean_off"),
    )


@query
def tree_importance_check(spark, sf_dir):
    data, fitted, nodes = _tree_models(spark, sf_dir)
    names = list(MEAN_FEATURES)
    single = trees.importance_by_nodes(nodes.filter("model <> 'gbt'"), names)
    found = single.unionByName(trees.importance_by_nodes(nodes.filter("model = 'gbt'"), names, normalise_trees=False))
    told = [(m, f, v) for m, model in fitted.items() for f, v in ev.importance_values(model, data.test).items()]
    told = spark.createDataFrame(told, "model string, feature string, told double")
    return found.join(told, ["model", "feature"], "full").select("model", "feature", (F.col("importance") - F.col("told")).alias("importance_off"))


# The kinds whose full settings a workstation fits in a short time.
_CHECKED_KINDS = ("linear_regression", "lasso_regression", "elastic_net", "decision_tree", "gbt")


@query
def compare_models_check(spark, sf_dir):
    """Differences between the metrics of fitted models and the same by other formulas."""
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MAX_PRICE, written=True)
    models = {k: training.mean_model(k, MAX_PRICE) for k in _CHECKED_KINDS}
    fitted = training.fit_all(data.train, models, parallelism=3)
    predictions, columns = training.predict_all(data.test, fitted)
    compared = ev.compare_predictions(predictions, MAX_PRICE, columns)
    pairs = [F.struct(F.lit(m).alias("model"), F.col(c).alias("p")) for m, c in columns.items()]
    long = predictions.select(F.col(MAX_PRICE.column).alias("y"), F.inline(F.array(*pairs)))
    again = long.groupBy("model").agg(
        F.expr("avg(y * y) - 2 * avg(y * p) + avg(p * p)").alias("square"),
        F.expr("avg(greatest(y, p)) - avg(least(y, p))").alias("other_mae"),
        F.expr("avg(y * y) - avg(y) * avg(y)").alias("variance"),
    )
    return compared.join(again, "model").select(
        "model",
        (F.col("rmse") - F.sqrt("square")).alias("rmse_off"),
        (F.col("mae") - F.col("other_mae")).alias("mae_off"),
        (F.col("r2") - (1 - F.col("square") / F.col("variance"))).alias("r2_off"),
    )


# -- evaluation on the mean baseline, which SQL can repeat ------------------


def _baseline(spark, sf_dir, label: Label = MAX_PRICE) -> DataFrame:
    return training.mean_baseline(*_sides(spark, sf_dir, label), label)


def _baseline_comparison(spark, sf_dir) -> DataFrame:
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MAX_PRICE)
    columns = {f"{d}_mean": mean_column(d) for d in ENCODED_DIMS}
    return ev.compare_predictions(data.test, MAX_PRICE, columns)


@query
def baseline_eval(spark, sf_dir):
    return ev.evaluate(_baseline(spark, sf_dir), MAX_PRICE)


@query
def baseline_comparison(spark, sf_dir):
    return _baseline_comparison(spark, sf_dir)


@query
def best_model(spark, sf_dir):
    return ev.best_model(_baseline_comparison(spark, sf_dir))


@query
def metrics_long(spark, sf_dir):
    train, test = _sides(spark, sf_dir, MAX_PRICE)
    evaluation = ev.evaluate(training.mean_baseline(train, test, MAX_PRICE), MAX_PRICE)
    return ev.metrics_long(evaluation, train.count(), test.count())


@query
def prediction_table(spark, sf_dir):
    return ev.prediction_table(_baseline(spark, sf_dir), MAX_PRICE)


@query
def prediction_sample(spark, sf_dir):
    return ev.prediction_sample(_baseline(spark, sf_dir, MIN_PRICE), MIN_PRICE)


def _tree(spark, sf_dir) -> tuple[PipelineModel, DataFrame]:
    data = training.prepare_means(cleaned_listings(spark, sf_dir), MAX_PRICE, written=True)
    return training.mean_model("decision_tree", MAX_PRICE).fit(data.train), data.test


@query
def feature_importance(spark, sf_dir):
    return ev.feature_importance(*_tree(spark, sf_dir))


@query
def one_hot_importance(spark, sf_dir):
    train, test = _sides(spark, sf_dir, MAX_PRICE)
    model = training.one_hot_model("decision_tree", MAX_PRICE).fit(train)
    return ev.feature_importance(model, test)


def _facts(importance: DataFrame) -> DataFrame:
    """What holds of any importances: the slots by name, shares of at least 0 that sum to 1."""
    total = importance.agg(F.sum("importance").alias("importance")).select(F.lit("(sum)").alias("feature"), "importance")
    shares = importance.select("feature", F.when(F.col("importance").between(0, 1), 0.0).alias("importance"))
    return shares.unionByName(total)


@query
def one_hot_tree_check(spark, sf_dir):
    """A tree on one-hot vectors, whose splits are categories: its predictions and importances by node rows."""
    train, test = _sides(spark, sf_dir, MAX_PRICE)
    model = training.one_hot_model("decision_tree", MAX_PRICE).fit(train)
    nodes = trees.all_nodes(spark, {"one_hot": model})
    off = _prediction_off(test, {"one_hot": model}, nodes)
    names = ev.feature_names(model, test)
    told = spark.createDataFrame(list(ev.importance_values(model, test).items()), "feature string, told double")
    found = trees.importance_by_nodes(nodes, names).join(told, "feature", "full")
    apart = found.agg(F.max(F.abs(F.col("importance") - F.col("told"))).alias("importance_off"))
    return off.join(F.broadcast(apart.withColumn("model", F.lit("one_hot"))), "model").drop("n_rows")


@query
def feature_importance_facts(spark, sf_dir):
    return _facts(feature_importance(spark, sf_dir))


@query
def one_hot_importance_facts(spark, sf_dir):
    return _facts(one_hot_importance(spark, sf_dir))


# -- batch scoring ----------------------------------------------------------


def _tables(spark, sf_dir) -> score.ScoringTables:
    highest = MeanEncoder(MAX_PRICE).fit(_train(spark, sf_dir, MAX_PRICE))
    lowest = MeanEncoder(MIN_PRICE).fit(_train(spark, sf_dir, MIN_PRICE))
    return score.ScoringTables.build(raw_listings(spark, sf_dir), highest, lowest)


def _features(spark, sf_dir, tables) -> DataFrame:
    return score.score_features(request_table(spark, sf_dir), tables, AS_OF)


@query
def artist_reference(spark, sf_dir):
    return score.artist_reference(raw_listings(spark, sf_dir))


@query
def default_popularity(spark, sf_dir):
    return score.default_popularity(score.artist_reference(raw_listings(spark, sf_dir)))


@query
def score_validate(spark, sf_dir):
    return score.validate(request_table(spark, sf_dir)).select("request_id", "missing")


@query
def score_calendar(spark, sf_dir):
    dated = score.add_calendar(request_table(spark, sf_dir), AS_OF)
    return dated.select("request_id", "event_date", "year", "month", "weekday", "weekday_name")


@query
def score_artist_lookup(spark, sf_dir):
    found = score.add_artist(request_table(spark, sf_dir), _tables(spark, sf_dir))
    return found.select("request_id", "spotify_popularity", "artist_genre", "artist_subgenre")


@query
def score_genre(spark, sf_dir):
    found = score.add_artist(request_table(spark, sf_dir), _tables(spark, sf_dir))
    return score.add_genre(found).select("request_id", "genre", "subgenre")


@query
def score_features(spark, sf_dir):
    made = _features(spark, sf_dir, _tables(spark, sf_dir))
    means = [f"{d}_avg_{end}" for d in ENCODED_DIMS for end in ("max", "min")]
    return made.select("request_id", "spotify_popularity", *means)


_CITY = (mean_column("city"),)


def _price_models(spark, sf_dir) -> tuple[PipelineModel, PipelineModel]:
    models = []
    for label in (MAX_PRICE, MIN_PRICE):
        train = _train(spark, sf_dir, label)
        encoded = MeanEncoder(label, ("city",)).fit(train).transform(train)
        models.append(_linear(encoded, label, _CITY))
    return models[0], models[1]


@query
def score_dual(spark, sf_dir):
    made = _features(spark, sf_dir, _tables(spark, sf_dir))
    scored = score.predict_both(made, *_price_models(spark, sf_dir))
    return scored.select("request_id", "pred_max", "pred_min")


@query
def score_repair(spark, sf_dir):
    # The models change places, so that the highest price falls below the lowest.
    made = _features(spark, sf_dir, _tables(spark, sf_dir))
    highest, lowest = _price_models(spark, sf_dir)
    scored = score.predict_both(made, lowest, highest)
    return score.repair(scored).select("request_id", "pred_max", "pred_min")


@query
def score_probability(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    made = _features(spark, sf_dir, tables)
    return made.select("request_id", score.probability(tables).alias("probability"))


@query
def score_output(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    scored = score.repair(score.predict_means(_features(spark, sf_dir, tables)))
    return score.output(scored, tables)


@query
def score_band(spark, sf_dir):
    answers = score.score_batch(request_table(spark, sf_dir), _tables(spark, sf_dir), None, AS_OF)
    return answers.select("request_id", "band", "spread")


@query
def score_explain(spark, sf_dir):
    importances = ev.importance_values(*_tree(spark, sf_dir))
    made = _features(spark, sf_dir, _tables(spark, sf_dir))
    listed = score.explanation(importances, k=len(MEAN_FEATURES))
    return made.select(F.inline(listed)).groupBy("name").count()


# Stated importances with ties, so that order, scores and the cut to six can be checked.
_STATED = dict(zip(MEAN_FEATURES, (0.3, 0.05, 0.1, 0.1, 0.05, 0.25, 0.1, 0.05), strict=True))


@query
def score_explain_top(spark, sf_dir):
    made = _features(spark, sf_dir, _tables(spark, sf_dir))
    listed = made.select(F.posexplode(score.explanation(_STATED)).alias("place", "entry"))
    return listed.groupBy("place", F.col("entry.name").alias("name"), F.col("entry.score").alias("score")).count()


@query
def score_rejected(spark, sf_dir):
    return score.rejected_requests(request_table(spark, sf_dir)).select("request_id", "missing")


@query
def score_accounted(spark, sf_dir):
    """Every request is either answered or rejected."""
    asked = request_table(spark, sf_dir)
    answers = score.score_batch(asked, _tables(spark, sf_dir), None, AS_OF)
    both = answers.select("request_id", F.lit("answered").alias("side")).unionByName(
        score.rejected_requests(asked).select("request_id", F.lit("rejected").alias("side"))
    )
    return both.groupBy("side").agg(F.count("*").alias("n"), F.countDistinct("request_id").alias("ids"))


@query
def score_full(spark, sf_dir):
    data = {
        label: training.prepare_means(cleaned_listings(spark, sf_dir), label, written=True)
        for label in (MAX_PRICE, MIN_PRICE)
    }
    models = tuple(
        training.mean_model("gbt", label).fit(d.train)
        for label, d in data.items()
    )
    tables = score.ScoringTables.build(
        raw_listings(spark, sf_dir), data[MAX_PRICE].encoding, data[MIN_PRICE].encoding
    )
    importances = ev.importance_values(models[0], data[MAX_PRICE].test)
    answers = score.score_batch(
        request_table(spark, sf_dir), tables, models, AS_OF, importances
    )
    return answers.withColumn("top_features", F.to_json("top_features"))


@query
def model_summary(spark, sf_dir):
    return score.model_summary(_tables(spark, sf_dir))


# -- profile and plot data --------------------------------------------------


@query
def profile_shape(spark, sf_dir):
    return profile.profile_shape(cleaned_listings(spark, sf_dir)).drop("position")


@query
def profile_head(spark, sf_dir):
    rows = profile.profile_head(cleaned_listings(spark, sf_dir), ["event_id"])
    return rows.select("event_id", "artist", "event_date", "city", "tm_max_price")


@query
def profile_numeric(spark, sf_dir):
    return profile.profile_numeric(cleaned_listings(spark, sf_dir))


@query
def profile_missing(spark, sf_dir):
    return profile.profile_missing(_typed(spark, sf_dir))


@query
def plot_trim(spark, sf_dir):
    trimmed = profile.trim_outliers(_baseline(spark, sf_dir), MAX_PRICE, cap=35_000)
    return trimmed.select("event_id", "tm_max_price", "prediction")


@query
def plot_pairs(spark, sf_dir):
    return profile.plot_pairs(_baseline(spark, sf_dir), MAX_PRICE)


@query
def plot_limits(spark, sf_dir):
    return profile.plot_limits(profile.plot_pairs(_baseline(spark, sf_dir), MAX_PRICE))
