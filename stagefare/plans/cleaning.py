"""Raw listings to the cleaned, partitioned table, and the reports on it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stagefare.columns import ListingColumns
from stagefare.functions.joins import measure
from stagefare.functions.rowsets import in_set, row_set
from stagefare.operators import reports
from stagefare.operators.clean import CLEAN_COLUMNS, TYPED_COLUMNS, typed_listings, with_derived
from stagefare.operators.rows import all_present, best_first, dedup, require, unpack
from stagefare.sources.listings import is_small, partition_counts, read_clean, read_raw, write_clean, write_merged
from stagefare.sources.outputs import write_report, write_sorted
from stagefare.sources.scratch import exists, materialize, new_path, remove, written_at

LISTING = ListingColumns()


def clean_table(
    raw: DataFrame, artist_mode: str = "strict_single", c: ListingColumns = LISTING
) -> DataFrame:
    """Typed, complete listings with one row per id.

    De-duplication prefers complete rows, so dropping incomplete ones before it
    keeps the same rows as dropping them after it, and shuffles less: rows
    without an id, all of which share one key, never reach the shuffle. Nor do columns that follow from others.
    """
    complete = require(typed_listings(raw, artist_mode), c.required)
    return with_derived(dedup(complete, [c.event_id], prefer=(c.event_date, c.artist)))


MONTHS = ("year", "month")
_ROW = "__row"


def write_cleaned(
    raw: DataFrame, path: str, artist_mode: str = "strict_single", c: ListingColumns = LISTING
) -> None:
    """Write the rows of :func:`clean_table` by month, as :func:`write_clean` does, without shuffling whole rows.

    All complete rows are written by month with a number each. Ids, dates and numbers alone then tell which stay: of an id
    the row of its latest date. Where an id has several rows on that date, copies or not, those
    are compared whole. The rows that stay are a set of bits that is broadcast while month files are merged.
    """
    spark = raw.sparkSession
    complete = with_derived(require(typed_listings(raw, artist_mode), c.required))
    paths = _scratch_paths(spark)
    kept, counts = _latest_rows(complete, paths, c)
    write_merged(kept, path, counts)
    for done in paths:
        remove(spark, done)


def _scratch_paths(spark: SparkSession) -> list[str]:
    """Where :func:`_latest_rows` writes what its result is read from."""
    return [new_path(spark, n) for n in ("complete", "latest", "ties")]


def _latest_rows(rows: DataFrame, paths: list[str], c: ListingColumns = LISTING) -> tuple[DataFrame, list[Row]]:
    """Of cleaned rows, all complete, the one of each id that :func:`dedup` keeps, without shuffling whole rows; and counts of all by month."""
    all_path, last_path, ties_path = paths
    staged = written_at(rows.withColumn(_ROW, F.monotonically_increasing_id()), all_path, MONTHS)
    counts = partition_counts(staged, MONTHS)
    if is_small(counts):
        return with_derived(dedup(staged.select(*TYPED_COLUMNS), [c.event_id], (c.event_date, c.artist))), counts
    by_day = staged.groupBy(c.event_id, c.event_date).agg(F.count("*").alias("n"), F.max(_ROW).alias(_ROW))
    latest = by_day.groupBy(c.event_id).agg(F.max(F.struct(c.event_date, "n", _ROW)).alias("last"))
    tied = F.col("last.n") > 1
    # An id is read again only where it is tied.
    latest = written_at(
        latest.select(
            F.when(tied, F.col(c.event_id)).alias(c.event_id),
            F.when(tied, F.col("last")[c.event_date]).alias(c.event_date),
            F.when(~tied, F.col("last")[_ROW]).alias(_ROW),
        ),
        last_path,
    )
    kept = in_set(staged, row_set(latest.filter(F.col(_ROW).isNotNull()), _ROW), _ROW).select(*CLEAN_COLUMNS)
    ties = measure(latest.filter(F.col(_ROW).isNull()).select(c.event_id, c.event_date), c.event_id)
    if not ties.size_bytes:
        return kept, counts
    met = F.broadcast(ties.table) if ties.fits() else ties.table.hint("merge")
    numbers = staged.select(c.event_id, c.event_date, _ROW).join(met, [c.event_id, c.event_date], "left_semi")
    rivals = in_set(staged, row_set(numbers, _ROW), _ROW).select(*TYPED_COLUMNS)
    won = written_at(with_derived(dedup(rivals, [c.event_id], (c.event_date, c.artist))), ties_path, MONTHS)
    return kept.unionAll(won.select(*CLEAN_COLUMNS)), counts


def listings_by_id(
    raw: DataFrame, artist_mode: str = "strict_single", c: ListingColumns = LISTING
) -> DataFrame:
    """One row per id: the counts of its rows, and in ``kept`` the one that stays, null if none is complete.

    The counts ride on the aggregate that de-duplicates, so cleaning and counting read the raw files once.
    """
    typed = with_derived(typed_listings(raw, artist_mode))
    best = best_first(TYPED_COLUMNS, [c.event_id], (c.event_date, c.artist))
    kept = F.max(F.when(all_present(c.required), best)).alias("kept")
    return typed.groupBy(c.event_id).agg(*reports.id_counts(c), kept)


def kept_listings(by_id: DataFrame, c: ListingColumns = LISTING) -> DataFrame:
    """The rows of :func:`clean_table` from :func:`listings_by_id`."""
    return with_derived(unpack(by_id.filter("kept is not null"), TYPED_COLUMNS, [c.event_id], "kept"))


def clean_job(
    spark: SparkSession,
    source: str,
    target: str,
    artist_mode: str = "strict_single",
    only_touched: bool = False,
    **read,
) -> dict[str, DataFrame]:
    """Clean listing files into ``target``; returns counts and closing statistics.

    Raw files are read once: what is left of them by id is written to the shared folder, and the
    table, its merge and the counts (of these files) follow from that. ``only_touched`` merges the files into an
    existing ``target`` (see :func:`merge_clean`) instead of replacing it.
    """
    by_id_path = new_path(spark, "by-id")
    by_id = written_at(listings_by_id(read_raw(spark, source, **read), artist_mode), by_id_path)
    fresh = kept_listings(by_id)
    if only_touched and exists(spark, target):
        merge_clean(spark, fresh, target)
    else:
        write_clean(fresh, target)
    # Only their sums are read of the rows by id from here on.
    quality_counts = materialize(reports.sum_id_counts(by_id), "quality-counts")
    remove(spark, by_id_path)
    return {
        "quality_counts": quality_counts,
        "clean_stats": reports.clean_stats(read_clean(spark, target)),
    }


def _in_months(months: list[tuple[int, int]]) -> Column:
    """Whether a row lies in one of the months; prunes partitions."""
    by_year: dict[int, list[int]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    tests = [(F.col("year") == y) & F.col("month").isin(*m) for y, m in sorted(by_year.items())]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def merge_clean(
    spark: SparkSession, fresh: DataFrame, target: str, c: ListingColumns = LISTING
) -> list[tuple[int, int]]:
    """Merge cleaned rows, one per id, into a written table; returns the months that were written.

    The table becomes what cleaning all files ever merged at once would give: survivors are the
    greatest of a total order, so it does not matter when a row came. Touched are the months of fresh rows and
    those where the table holds their ids now, which may differ when an id moves; of the others only ids
    are read. A month that loses all its rows loses its folder.

    The rows of both are written to the shared folder before any month is replaced, so lost executors change
    nothing, and told apart by ids, dates and numbers as in :func:`write_cleaned`. If the driver is lost while months are replaced, merging the same files again, with the files of those months, repairs it.
    """
    old = read_clean(spark, target)
    ids_path = new_path(spark, "fresh-ids")
    ids = measure(written_at(fresh.select(c.event_id), ids_path), c.event_id)
    met = F.broadcast(ids.table) if ids.fits() else ids.table.hint("merge")
    held = old.select(c.event_id, "year", "month").join(met, c.event_id, "left_semi")
    both = held.select("year", "month").union(fresh.select("year", "month")).distinct()
    # One row per partition of the table.
    touched = sorted((r["year"], r["month"]) for r in both.collect())
    remove(spark, ids_path)
    if not touched:
        return []
    held_rows = old.filter(_in_months(touched)).select(*TYPED_COLUMNS)
    paths = _scratch_paths(spark)
    kept, counts = _latest_rows(with_derived(held_rows.unionByName(fresh.select(*TYPED_COLUMNS))), paths, c)
    filled = {(r["year"], r["month"]) for r in kept.select("year", "month").distinct().collect()}
    write_merged(kept, target, counts, only_touched=True)
    for year, month in touched:
        if (year, month) not in filled:
            remove(spark, f"{target}/year={year}/month={month}")
    for done in paths:
        remove(spark, done)
    return touched


# Folder of each saved report.
REPORTS = {
    "events_per_year_genre": reports.report_year_genre,
    "top_cities": reports.report_top_cities,
    "top_artists": reports.report_top_artists,
    "events_per_weekday": reports.report_weekday,
    "secondary_market_by_genre": reports.report_secondary_market,
    "price_by_state": reports.report_price_by_state,
}


# Reports with a row for every genre, which is free text, and what they are sorted by; the others hold k rows or days of the week.
GROWING = {
    "events_per_year_genre": ("year", "-event_count", "genre"),
    "secondary_market_by_genre": ("-event_count", "genre"),
}


def report_job(cleaned: DataFrame, target: str) -> dict[str, DataFrame]:
    """Save the six reports as CSV below ``target``; returns the three summaries."""
    for folder, report in REPORTS.items():
        if folder in GROWING:
            write_sorted(report(cleaned), f"{target}/{folder}", GROWING[folder])
        else:
            write_report(report(cleaned), f"{target}/{folder}")
    return {
        "summary_overall": reports.summary_overall(cleaned),
        "summary_genre_top10": reports.summary_genre_top10(cleaned),
        "coverage": reports.coverage(cleaned),
    }
