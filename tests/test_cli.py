"""The command line, from listing files to answers."""

import pytest

from stagefare.__main__ import parse, run
from stagefare.catalog.fixture import raw_listings, requests
from stagefare.columns import MAX_PRICE, MIN_PRICE
from stagefare.operators.regressors import sweep_grid
from stagefare.plans import training
from stagefare.sources import scratch
from stagefare.sources.outputs import write_rows


def test_clean_report_train_score(spark, sf_dir, tmp_path):
    write_rows(raw_listings(spark, sf_dir), f"{tmp_path}/raw")
    write_rows(requests(spark, sf_dir), f"{tmp_path}/asked")

    def job(*args):
        return run(spark, parse([str(a) for a in args]))

    counts = job("clean", "--input", tmp_path / "raw", "--output", tmp_path / "clean")
    kept = counts["quality_counts"].first().after_filter
    assert kept == counts["clean_stats"].first().total_records > 0
    summary = job("report", "--input", tmp_path / "clean", "--output", tmp_path / "reports")
    assert summary["coverage"].first().total == kept
    for label in ("max", "min"):
        out = tmp_path / label
        job("train", "--input", tmp_path / "clean", "--output", out, "--label", label, "--model-type", "lr")
    answers = job(
        "score", "--input", tmp_path / "asked", "--output", tmp_path / "answers",
        "--listings", tmp_path / "raw", "--max-model", tmp_path / "max",
        "--min-model", tmp_path / "min", "--as-of", "2024-06-15",
    )
    assert answers["answers"].count() == 20
    scored = spark.read.parquet(f"{tmp_path}/answers").count()
    rejected = spark.read.parquet(f"{tmp_path}/answers_rejected")
    asked = spark.read.csv(f"{tmp_path}/asked", header=True).count()
    assert scored + rejected.count() == asked and rejected.count() > 0
    assert rejected.filter("missing is null").count() == 0
    assert {r["missing"] for r in answers["rejected"].collect()} == {r.missing for r in rejected.collect()}


def test_score_with_swept_models(spark, sf_dir, cleaned, tmp_path):
    write_rows(raw_listings(spark, sf_dir), f"{tmp_path}/raw")
    write_rows(requests(spark, sf_dir), f"{tmp_path}/asked")
    grid = sweep_grid()
    for label, name in ((MAX_PRICE, "dt_1"), (MIN_PRICE, "lr_1")):
        training.sweep_job(cleaned, label, f"{tmp_path}/{label.column}", {name: grid[name]})
    run(spark, parse([
        "score", "--input", f"{tmp_path}/asked", "--output", f"{tmp_path}/answers",
        "--listings", f"{tmp_path}/raw", "--as-of", "2024-06-15",
        "--max-model", f"{tmp_path}/tm_max_price", "--max-name", "dt_1",
        "--min-model", f"{tmp_path}/tm_min_price", "--min-name", "lr_1",
    ]))
    answers = spark.read.parquet(f"{tmp_path}/answers")
    assert answers.count() > 0 and answers.filter("pred_max is null or pred_min is null").count() == 0
    used = answers.select("max_model", "min_model", "max_model_path").distinct().collect()
    assert [tuple(r) for r in used] == [
        ("DecisionTreeRegression", "LinearRegression", f"{tmp_path}/tm_max_price/models/dt_1")
    ]


def test_clear_removes_only_own_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_dir", lambda _: str(tmp_path))
    spark.range(3).write.parquet(f"{tmp_path}/other")
    table = scratch.materialize(spark.range(5).toDF("id"), "mine")
    assert table.count() == 5
    scratch.clear(spark)
    assert spark.read.parquet(f"{tmp_path}/other").count() == 3
    assert not (tmp_path / "stagefare" / spark.sparkContext.applicationId).exists()


def test_inspection_jobs_and_training_flags(spark, sf_dir, cleaned, tmp_path):
    def job(*args):
        return run(spark, parse([str(a) for a in args]))

    write_rows(raw_listings(spark, sf_dir), f"{tmp_path}/raw")
    cleaned.write.partitionBy("year", "month").parquet(f"{tmp_path}/clean")
    seen = job("profile", "--input", tmp_path / "clean", "--output", tmp_path / "seen", "--head", 3)
    assert seen["head"].count() == 3 and seen["shape"].count() == len(cleaned.columns)
    assert seen["numeric"].filter("column_name = 'year' and count > 0").count() == 1
    assert seen["missing"].filter("missing_count > 0").count() == seen["missing"].count() > 0
    job("export", "--input", tmp_path / "clean", "--output", tmp_path / "csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).count() == cleaned.count()
    year = cleaned.agg({"year": "min"}).first()[0] + 1
    for label in ("max", "min"):
        job("train", "--input", tmp_path / "clean", "--output", tmp_path / label, "--label", label,
            "--model-type", "lr", "--years", year, year + 1, "--leave-one-out")
    predicted = spark.read.csv(f"{tmp_path}/max/predictions", header=True, inferSchema=True)
    assert {r[0] for r in predicted.selectExpr("year(event_date)").distinct().collect()} <= {year, year + 1}
    cap = predicted.approxQuantile("tm_max_price", [0.5], 0)[0]
    limits = job("plot", "--input", tmp_path / "max/predictions", "--output", tmp_path / "plot", "--cap", cap)
    pairs = spark.read.csv(f"{tmp_path}/plot/pairs", header=True, inferSchema=True)
    assert 0 < pairs.count() == predicted.filter(f"tm_max_price <= {cap} and prediction <= {cap}").count()
    assert limits["limits"].first().high <= cap
    summary = job("summary", "--input", tmp_path / "raw", "--output", tmp_path / "summary",
                  "--max-model", tmp_path / "max", "--min-model", tmp_path / "min")
    assert summary["summary"].first().total_artists == spark.read.json(f"{tmp_path}/summary").first().total_artists > 0


def test_joint_city_model_is_refused_for_scoring(spark, sf_dir, cleaned, tmp_path):
    write_rows(raw_listings(spark, sf_dir), f"{tmp_path}/raw")
    write_rows(requests(spark, sf_dir), f"{tmp_path}/asked")
    for label, joint in ((MAX_PRICE, True), (MIN_PRICE, False)):
        training.train_job(cleaned, label, f"{tmp_path}/{label.column}", "lr", joint_city=joint)
    vectors = spark.read.parquet(f"{tmp_path}/tm_max_price/features")
    names = [a["name"] for a in vectors.schema["features"].metadata["ml_attr"]["attrs"]["numeric"]]
    assert "city_state_avg_price" in names and "city_avg_price" not in names
    with pytest.raises(Exception, match="city_state"):
        run(spark, parse([
            "score", "--input", f"{tmp_path}/asked", "--output", f"{tmp_path}/answers", "--listings", f"{tmp_path}/raw",
            "--as-of", "2024-06-15", "--max-model", f"{tmp_path}/tm_max_price", "--min-model", f"{tmp_path}/tm_min_price",
        ]))
