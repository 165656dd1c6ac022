"""Time the headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

The order tables are first turned into listing CSV files, untimed: that is the
input the jobs start from. Then every step is timed as a user would run it:
clean the files into a partitioned table, report on it, train, score. Prints one
JSON line.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stagefare.catalog import fixture  # noqa: E402
from stagefare.columns import MAX_PRICE, MIN_PRICE  # noqa: E402
from stagefare.operators import evaluate as ev  # noqa: E402
from stagefare.operators import profile, reports, score  # noqa: E402
from stagefare.operators.clean import clean_listings  # noqa: E402
from stagefare.plans import training  # noqa: E402
from stagefare.plans.cleaning import clean_table  # noqa: E402
from stagefare.sources.listings import read_clean, read_raw, write_clean  # noqa: E402
from stagefare.sources.outputs import write_rows  # noqa: E402


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stagefare bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stagefare-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_whole(df: DataFrame) -> None:
    """Compute every row and column of a result, keeping none."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus)
    work = tempfile.mkdtemp(prefix="stagefare-bench-")
    times: dict[str, float] = {}

    @contextlib.contextmanager
    def timed(name: str):
        start = time.perf_counter()
        yield
        times[name] = round(time.perf_counter() - start, 3)

    write_rows(fixture.raw_listings(spark, sf_dir), f"{work}/raw", rows_per_file=20_000)
    requests_path = f"{work}/requests"
    fixture.requests(spark, sf_dir).repartition(cpus).write.parquet(requests_path)

    with timed("clean_write"):
        raw = read_raw(spark, f"{work}/raw")
        write_clean(clean_table(raw), f"{work}/clean")
    with timed("quality_counts"):
        run_whole(reports.quality_counts(clean_listings(raw)))
    cleaned = read_clean(spark, f"{work}/clean")
    for name in (
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
        with timed(name):
            run_whole(getattr(reports, name)(cleaned))
    with timed("profile_numeric"):
        run_whole(profile.profile_numeric(cleaned))
    with timed("profile_missing"):
        run_whole(profile.profile_missing(cleaned))

    data = {}
    with timed("encode_max"):
        data[MAX_PRICE] = training.prepare_means(cleaned, MAX_PRICE, written=True)
    with timed("encode_min"):
        data[MIN_PRICE] = training.prepare_means(cleaned, MIN_PRICE, written=True)
    with timed("baseline_eval"):
        train, test = training.split_by_id(training.labelled(cleaned, MAX_PRICE))
        run_whole(ev.evaluate(training.mean_baseline(train, test, MAX_PRICE), MAX_PRICE))
    models = {}
    for label, d in data.items():
        with timed(f"fit_linear_{label.column}"):
            models[label] = training.mean_model("linear_regression", label).fit(d.train)
    with timed("fit_random_forest_20x6"):
        forest = training.mean_model("random_forest", MAX_PRICE, numTrees=20, maxDepth=6)
        forest = forest.fit(data[MAX_PRICE].train)
    with timed("fit_gbt_10x2"):
        training.mean_model("gbt", MAX_PRICE, maxIter=10).fit(data[MAX_PRICE].train)
    with timed("evaluate_forest"):
        run_whole(ev.evaluate(forest.transform(data[MAX_PRICE].test), MAX_PRICE))
    with timed("score_tables"):
        tables = score.ScoringTables.build(
            raw, data[MAX_PRICE].encoding, data[MIN_PRICE].encoding
        )
    with timed("score_batch"):
        importances = ev.importance_values(forest, data[MAX_PRICE].test)
        answers = score.score_batch(
            spark.read.parquet(requests_path),
            tables,
            (forest, models[MIN_PRICE]),
            "2024-06-15",
            importances,
        )
        run_whole(answers)

    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "listing jobs, total wall time",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
