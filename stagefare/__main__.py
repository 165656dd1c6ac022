"""Jobs from the command line, for ``spark-submit`` or ``python -m stagefare``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stagefare.columns import MAX_PRICE, MIN_PRICE
from stagefare.operators.regressors import SHORT_NAMES, sweep_grid
from stagefare.plans import cleaning, inspection, scoring, training
from stagefare.sources.listings import read_clean, read_raw
from stagefare.sources.outputs import export_csv
from stagefare.sources.scratch import clear

LABELS = {"max": MAX_PRICE, "min": MIN_PRICE}


def build_session(name: str) -> SparkSession:
    return SparkSession.builder.appName(f"stagefare {name}").getOrCreate()


def parse(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stagefare", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--input", required=True)
        sub.add_argument("--output", required=True)
        return sub

    clean = job("clean", "listing CSV to cleaned Parquet")
    clean.add_argument("--artist-mode", choices=("strict_single", "first"), default="strict_single")
    clean.add_argument(
        "--only-touched", action="store_true", help="merge into the output, writing only months that change"
    )
    job("report", "cleaned Parquet to the six CSV reports")
    for name, text in (
        ("train", "train one price model"),
        ("compare", "train and compare six models"),
        ("sweep", "train the whole parameter grid"),
    ):
        sub = job(name, text)
        sub.add_argument("--label", choices=tuple(LABELS), default="max")
        sub.add_argument("--years", type=int, nargs="+", help="learn from these years only")
        sub.add_argument("--months", type=int, nargs="+", help="learn from these months of a year only")
        if name == "train":
            sub.add_argument("--model-type", choices=tuple(SHORT_NAMES), default="rf")
            sub.add_argument("--one-hot", action="store_true")
            sub.add_argument(
                "--leave-one-out", action="store_true", help="take a row's own price out of its means"
            )
            sub.add_argument(
                "--joint-city", action="store_true", help="means by city and state (not for scoring)"
            )
        else:
            sub.add_argument("--parallelism", type=int, default=1)
    score = job("score", "request CSV to scored Parquet")
    score.add_argument("--listings", required=True, help="raw listing CSV")
    score.add_argument("--max-model", required=True, help="output of train, compare or sweep --label max")
    score.add_argument("--min-model", required=True, help="output of train, compare or sweep --label min")
    score.add_argument("--max-name", help="which model of a comparison or sweep, such as gbt or rf_3")
    score.add_argument("--min-name", help="the same for the lowest price")
    score.add_argument("--as-of", required=True, help="day for requests without one")
    seen = job("profile", "shape, first rows, numbers and missing values of a Parquet table")
    seen.add_argument("--order", nargs="+", default=["event_id"], help="columns the first rows follow")
    seen.add_argument("--head", type=int, default=10)
    job("export", "Parquet table to CSV")
    plot = job("plot", "predictions of a training output to actual and predicted pairs")
    plot.add_argument("--label", choices=tuple(LABELS), default="max")
    plot.add_argument("--cap", type=float, help="leave out prices over this")
    summary = job("summary", "raw listing CSV and two training outputs to sizes of the reference tables")
    summary.add_argument("--max-model", required=True)
    summary.add_argument("--min-model", required=True)
    return parser.parse_args(args)


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Run one job; returns the small tables it has to show, by name."""
    if args.job == "clean":
        return cleaning.clean_job(spark, args.input, args.output, args.artist_mode, args.only_touched)
    if args.job == "profile":
        return inspection.profile_job(spark.read.parquet(args.input), args.output, args.order, args.head)
    if args.job == "export":
        export_csv(spark, args.input, args.output)
        return {}
    if args.job == "plot":
        return inspection.plot_job(spark, args.input, LABELS[args.label], args.output, args.cap)
    if args.job == "summary":
        raw = read_raw(spark, args.input)
        return inspection.summary_job(spark, raw, args.max_model, args.min_model, args.output)
    if args.job == "score":
        requests = spark.read.csv(args.input, header=True)
        raw = read_raw(spark, args.listings)
        folders, names = (args.max_model, args.min_model), (args.max_name, args.min_name)
        scoring.score_job(requests, raw, *folders, args.output, args.as_of, *names)
        rejected = spark.read.parquet(f"{args.output}_rejected").groupBy("missing").count()
        return {"answers": spark.read.parquet(args.output).limit(20), "rejected": rejected}
    if args.job == "report":
        return cleaning.report_job(read_clean(spark, args.input), args.output)
    cleaned = read_clean(spark, args.input, args.years, args.months)
    label = LABELS[args.label]
    if args.job == "train":
        ways = {"leave_one_out": args.leave_one_out, "joint_city": args.joint_city}
        metrics = training.train_job(cleaned, label, args.output, args.model_type, args.one_hot, **ways)
        return {"metrics": metrics}
    if args.job == "compare":
        table = training.compare_job(cleaned, label, args.output, parallelism=args.parallelism)
    else:
        table = training.sweep_job(cleaned, label, args.output, sweep_grid(), args.parallelism)
    return {"comparison": table.orderBy("rmse")}


def main() -> None:
    args = parse()
    spark = build_session(args.job)
    try:
        for name, table in run(spark, args).items():
            print(name)
            table.show(truncate=False)
    finally:
        clear(spark)
        spark.stop()


if __name__ == "__main__":
    main()
