"""Cleaning functions on hand-made rows."""

import datetime as dt
import pathlib
import time

import pytest
from pyspark.sql import functions as F

from stagefare.columns import RAW_COLUMNS, RAW_SCHEMA
from stagefare.functions.calendar import calendar_parts, full_date, weekday_name
from stagefare.functions.text import (
    first_list_item,
    first_number_in_list,
    strip_list_marks,
    to_int,
)
from stagefare.operators.clean import CLEAN_COLUMNS, clean_listings
from stagefare.operators.reports import quality_counts
from stagefare.operators.rows import dedup, require
from stagefare.plans import cleaning
from stagefare.plans.cleaning import clean_job, clean_table, listings_by_id, report_job, write_cleaned
from stagefare.sources.listings import read_clean, read_raw, write_clean
from stagefare.sources.scratch import app_dir
from stagefare.sources.outputs import read_sorted, write_rows, write_sorted


def apply(spark, texts, fn):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(fn(F.col("t"))).collect()]


def listings(spark, *rows):
    filled = [tuple(r.get(c) for c in RAW_COLUMNS) for r in rows]
    return spark.createDataFrame(filled, RAW_SCHEMA)


def test_first_list_item_strict(spark):
    texts = ["['A']", "['A', 'B']", "[]", '["O\'Neil"]', None, "['Guns N Roses']"]
    assert apply(spark, texts, first_list_item) == ["A", "", "", "", None, "Guns N Roses"]


def test_first_list_item_first(spark):
    texts = ["['A']", "['A', 'B']", "[]", '["O\'Neil", \'B\']', None]
    got = apply(spark, texts, lambda c: first_list_item(c, "first"))
    assert got == ["A", "A", "", "O'Neil", None]


def test_first_list_item_rejects_unknown_mode(spark):
    with pytest.raises(ValueError):
        first_list_item("t", "last")


def test_first_number_in_list(spark):
    texts = ["[64]", "[63, 49]", "['NaN', 70, 67]", "['NaN']", "['70']", "[]", None, "[64.0]", "12"]
    assert apply(spark, texts, first_number_in_list) == [64, 63, 70, None, None, None, None, 64, 12]


def test_to_int(spark):
    texts = ["7", " 7 ", "7.0", "7.9", "-3", "x", "", "NaN", "3000000000", None]
    assert apply(spark, texts, to_int) == [7, 7, 7, 7, -3, None, None, None, None, None]


def test_strip_list_marks(spark):
    assert apply(spark, ["['A', 'B']", None], strip_list_marks) == ["A, B", None]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 15),), (dt.date(2024, 6, 16),), (None,)], "d date")
    rows = df.select(*[c.alias(n) for n, c in calendar_parts(F.col("d")).items()]).collect()
    assert tuple(rows[0]) == (2024, 6, 7, True)
    assert tuple(rows[1]) == (2024, 6, 1, True)
    assert tuple(rows[2]) == (None, None, None, None)


def test_weekday_name(spark):
    df = spark.createDataFrame([(1,), (7,), (8,), (None,)], "w int")
    names = [r[0] for r in df.select(weekday_name(F.col("w"))).collect()]
    assert names == ["Sunday", "Saturday", None, None]


def test_full_date(spark):
    got = apply(spark, ["2024-06-15", "2024-6-5", "2024", "tomorrow", "2024-13-01", None], full_date)
    assert got == [dt.date(2024, 6, 15), dt.date(2024, 6, 5), None, None, None, None]


def test_clean_listings_types_and_flags(spark):
    raw = listings(
        spark,
        {
            "TM_id": "1",
            "artists": "['A']",
            "date": "2024-06-15",
            "TM_max": "100.5",
            "TM_min": "40",
            "SG_listing_count": "0",
            "SH_total_postings": "3.0",
            "spotify_followers": "[12]",
            "presale_date_start": "2024-01-02 10:00:00",
        },
        {"TM_id": "2", "artists": "['A']", "date": "TBA", "TM_max": "N/A", "SG_listing_count": "0"},
        {"TM_id": "3", "artists": "['A']", "date": "2024-06-15", "SG_listing_count": "0", "SH_total_postings": "0"},
    )
    cleaned = clean_listings(raw)
    assert tuple(cleaned.columns) == CLEAN_COLUMNS and len(CLEAN_COLUMNS) == 38
    first, second, third = cleaned.orderBy("event_id").collect()
    assert first.price_range == 60.5 and first.has_spotify_data and first.has_secondary_market
    assert first.sh_total_postings == 3 and first.presale_start == dt.datetime(2024, 1, 2, 10)
    assert second.event_date is None and second.tm_max_price is None and second.year is None
    assert second.has_secondary_market is None and second.has_spotify_data is False
    assert third.has_secondary_market is False


def test_dedup_is_total_and_prefers_complete(spark):
    rows = [("1", None, 9), ("1", "a", 1), ("1", "a", 2), ("2", None, 5), (None, "x", 1), (None, "y", 1)]
    df = spark.createDataFrame(rows, "id string, artist string, n int")
    for partitions in (1, 4):
        kept = dedup(df.repartition(partitions), ["id"], prefer=("artist",)).collect()
        assert sorted(map(tuple, kept), key=str) == [("1", "a", 2), ("2", None, 5), (None, "y", 1)]


def test_require_keeps_empty_text(spark):
    df = spark.createDataFrame([("1", ""), ("2", None)], "id string, artist string")
    assert [r.id for r in require(df, ["id", "artist"]).collect()] == ["1"]


def test_filtering_before_or_after_dedup_is_the_same(spark):
    raw = listings(
        spark,
        {"TM_id": "1", "artists": "['A']", "date": "TBA", "venue": "z"},
        {"TM_id": "1", "artists": "['A']", "date": "2024-01-01", "venue": "a"},
        {"TM_id": "2", "artists": "['B']", "date": "TBA"},
        {"TM_id": None, "artists": "['C']", "date": "2024-01-01"},
    )
    before = clean_table(raw).collect()
    required = ("event_id", "event_date", "artist")
    one = dedup(clean_listings(raw), ["event_id"], prefer=("event_date", "artist"))
    assert before == require(one, required).collect()
    counts = quality_counts(clean_listings(raw)).first()
    assert (counts.total, counts.valid_date, counts.after_dedup, counts.after_filter) == (4, 2, 3, 1)


def test_read_raw_checks_columns(spark, tmp_path):
    spark.createDataFrame([("1",)], "TM_id string").write.option("header", True).csv(f"{tmp_path}/few")
    with pytest.raises(ValueError):
        read_raw(spark, f"{tmp_path}/few")


def test_inferred_types_clean_to_the_same(spark, tmp_path):
    raw = listings(
        spark,
        {"TM_id": "1", "artists": "['A']", "date": "2024-06-15", "TM_max": "10.5", "TM_min": "4",
         "SG_listing_count": "3.0", "spotify_popularity": "64", "spotify_followers": "[5, 6]",
         "presale_date_start": "2024-01-02 10:00:00"},
        {"TM_id": "2", "artists": "['A', 'B']", "date": "2024-06-16", "TM_max": "7"},
    )
    write_rows(raw, f"{tmp_path}/raw")
    plain = clean_listings(read_raw(spark, f"{tmp_path}/raw")).orderBy("tm_max_price").collect()
    typed = clean_listings(read_raw(spark, f"{tmp_path}/raw", infer=True)).orderBy("tm_max_price").collect()
    for a, b in zip(plain, typed):
        for name in ("artist", "event_date", "price_range", "sg_listing_count", "spotify_popularity",
                     "spotify_followers", "presale_start", "has_secondary_market", "weekday"):
            assert a[name] == b[name], name


def test_partition_pruning(spark, tmp_path):
    rows = [("1", 2023, 5), ("2", 2024, 5), ("3", 2024, 6)]
    write_clean(spark.createDataFrame(rows, "event_id string, year int, month int"), f"{tmp_path}/t")
    pruned = read_clean(spark, f"{tmp_path}/t", years=[2024], months=[6])
    assert [r.event_id for r in pruned.collect()] == ["3"]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    partition_part = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "year" in partition_part and "month" in partition_part


def test_write_only_touched_partitions(spark, tmp_path):
    schema = "event_id string, year int, month int"
    write_clean(spark.createDataFrame([("1", 2023, 5), ("2", 2024, 5)], schema), f"{tmp_path}/t")
    write_clean(spark.createDataFrame([("9", 2024, 5)], schema), f"{tmp_path}/t", only_touched=True)
    assert sorted(r.event_id for r in read_clean(spark, f"{tmp_path}/t").collect()) == ["1", "9"]


def test_clean_and_report_jobs(spark, tmp_path):
    raw = listings(
        spark,
        *[
            {"TM_id": str(i), "artists": "['A']", "date": "2024-06-15", "TM_min": "10", "TM_max": "30",
             "venue_city": "X", "venue_state": "S", "genre": "G", "spotify_popularity": "[5]",
             "SG_listing_count": "2", "SG_average_price": "15"}
            for i in range(5)
        ],
    )
    write_rows(raw, f"{tmp_path}/raw")
    result = clean_job(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    assert result["clean_stats"].first().total_records == 5
    assert result["quality_counts"].first().after_filter == 5
    summaries = report_job(read_clean(spark, f"{tmp_path}/clean"), f"{tmp_path}/reports")
    assert summaries["summary_overall"].first().total_events == 5
    saved = spark.read.csv(f"{tmp_path}/reports/secondary_market_by_genre", header=True).first()
    assert float(saved.avg_premium_pct) == 50.0


def test_to_int_reads_plain_numbers_only(spark):
    from stagefare.functions.text import to_int

    given = {"7.0": 7, "+5": 5, " 70": 70, "-3.9": -3, "1e3": None, "70d": None, "7f": None, "0x1p3": None, "": None, "NaN": None, "3000000000": None}
    rows = spark.createDataFrame([(t,) for t in given], "t string").select("t", to_int("t").alias("n")).collect()
    assert {r.t: r.n for r in rows} == given
    wide = spark.createDataFrame([(12345678.0,)], "x double").select(to_int("x").alias("n")).first()
    assert wide.n == 12345678


def _files(folder):
    """Parquet files by month folder."""
    found = {}
    for file in folder.glob("year=*/month=*/*.parquet"):
        found.setdefault(f"{file.parent.parent.name}/{file.parent.name}", set()).add(file.name)
    return found


def _listing(event_id, day, **more):
    return {"TM_id": event_id, "artists": "['A']", "date": day, **more}


def test_merged_batches_equal_one_clean(spark, tmp_path):
    first = [
        _listing("stays", "2024-01-10"), _listing("moves", "2024-02-10"), _listing("kept", "2024-03-10", venue="b"),
        _listing("other", "2024-03-11"), _listing("unread", "TBA"),
    ]
    second = [
        _listing("moves", "2024-04-10"), _listing("kept", "2024-03-10", venue="a"), _listing("kept", "2023-05-01"),
        _listing("new", "2024-06-01"), _listing("new", "2024-06-01"), _listing("stays", "TBA"), _listing(None, "2024-07-01"),
        _listing("unread", "2022-01-01"),
    ]
    for name, rows in (("first", first), ("second", second), ("both", first + second)):
        write_rows(listings(spark, *rows), f"{tmp_path}/raw-{name}")
    clean_job(spark, f"{tmp_path}/raw-first", f"{tmp_path}/merged", only_touched=True)
    before = _files(tmp_path / "merged")
    result = clean_job(spark, f"{tmp_path}/raw-second", f"{tmp_path}/merged", only_touched=True)
    after = _files(tmp_path / "merged")
    clean_job(spark, f"{tmp_path}/raw-both", f"{tmp_path}/whole")
    merged, whole = read_clean(spark, f"{tmp_path}/merged"), read_clean(spark, f"{tmp_path}/whole")
    assert merged.orderBy("event_id").collect() == whole.orderBy("event_id").collect()
    assert before["year=2024/month=1"] == after["year=2024/month=1"]
    assert "year=2024/month=2" in before and "year=2024/month=2" not in after
    assert before["year=2024/month=3"] != after["year=2024/month=3"]
    assert result["quality_counts"].first().total == len(second)
    # The same files again change no row.
    clean_job(spark, f"{tmp_path}/raw-second", f"{tmp_path}/merged", only_touched=True)
    merged = read_clean(spark, f"{tmp_path}/merged")
    assert merged.orderBy("event_id").collect() == whole.orderBy("event_id").collect()


def test_large_batches_are_merged_by_numbers_and_leave_no_rows_behind(spark, tmp_path, monkeypatch):
    """As tables of many rows are: whole rows are not shuffled to merge them, and tables that nothing reads are deleted."""
    shuffled, best, started = [], cleaning.dedup, time.time()
    monkeypatch.setattr("stagefare.sources.listings.ROWS_PER_FILE", 1)
    monkeypatch.setattr(cleaning, "dedup", lambda df, *a, **k: shuffled.append(df.count()) or best(df, *a, **k))
    ids = range(40)
    first = [_listing(f"e{i}", f"2024-0{1 + i % 5}-10", venue=f"a{i}") for i in ids]
    second = [_listing(f"e{i}", f"2024-0{1 + i % 7}-1{i % 3}", venue=f"b{i}") for i in ids if i % 4]
    second += [_listing("e3", "2024-04-10", venue="c"), _listing("new", "2024-09-01"), _listing("new", "2024-09-01")]
    for name, rows in (("first", first), ("second", second), ("both", first + second)):
        write_rows(listings(spark, *rows), f"{tmp_path}/raw-{name}")
    for name in ("first", "second"):
        result = clean_job(spark, f"{tmp_path}/raw-{name}", f"{tmp_path}/merged", only_touched=True)
    assert 0 < sum(shuffled) < 20  # only rows of one id and one day
    found = read_clean(spark, f"{tmp_path}/merged").orderBy("event_id").collect()
    monkeypatch.setattr(cleaning, "dedup", best)
    assert found == clean_table(listings(spark, *first, *second)).select(*read_clean(spark, f"{tmp_path}/merged").columns).orderBy("event_id").collect()
    assert result["quality_counts"].first().total == len(second)
    kept = {p.name.rpartition("-")[0] for p in pathlib.Path(app_dir(spark)).iterdir() if p.stat().st_mtime > started}
    assert not kept & {"by-id", "merged", "complete", "latest", "ties", "fresh-ids", "by-partition"}


def test_merging_nothing_changes_nothing(spark, tmp_path):
    write_rows(listings(spark, _listing("1", "2024-01-10")), f"{tmp_path}/raw")
    write_rows(listings(spark, _listing("2", "TBA")), f"{tmp_path}/none")
    clean_job(spark, f"{tmp_path}/raw", f"{tmp_path}/t")
    before = _files(tmp_path / "t")
    clean_job(spark, f"{tmp_path}/none", f"{tmp_path}/t", only_touched=True)
    assert before == _files(tmp_path / "t")


def test_counts_and_table_come_from_one_raw_scan(spark, tmp_path):
    write_rows(listings(spark, _listing("1", "2024-01-10"), _listing("1", "TBA")), f"{tmp_path}/raw")
    by_id = listings_by_id(read_raw(spark, f"{tmp_path}/raw"))
    plan = by_id._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
    result = clean_job(spark, f"{tmp_path}/raw", f"{tmp_path}/t")
    assert not any("/raw" in f for table in result.values() for f in table.inputFiles())
    assert result["quality_counts"].first().total == 2


def test_sorted_parts_read_back_in_order(spark, tmp_path):
    rows = [(i % 7, f"name {i}") for i in range(500)] + [(None, "x")]
    table = spark.createDataFrame(rows, "n int, name string")
    write_sorted(table, f"{tmp_path}/parts", ("-n", "name"), parts=4)
    assert len(list((tmp_path / "parts").glob("part-*.csv"))) > 1
    found = read_sorted(spark, f"{tmp_path}/parts", "n int, name string").orderBy("position").collect()
    wanted = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -1), r[1]))
    assert [(r.position, r.n, r.name) for r in found] == [(i, *r) for i, r in enumerate(wanted, 1)]


def test_distinct_sketches_merge(spark):
    from stagefare.operators.distinct import distinct_between, distinct_sketches, relative_error

    rows = [(2023 + i % 2, 1 + i % 12, f"a{i % 9000}", None if i % 3 else f"c{i % 50}") for i in range(40_000)]
    table = spark.createDataFrame(rows, "year int, month int, artist string, city string")
    sketches = distinct_sketches(table, ("artist", "city"))
    assert sketches.count() == 12
    whole = distinct_between(sketches, ("artist", "city")).first()
    assert whole.n_events == 40_000 and abs(whole.unique_artist - 9000) <= 3 * relative_error() * 9000
    cities = len({r[3] for r in rows if r[3]})
    assert abs(whole.unique_city - cities) <= 1
    one = distinct_between(sketches, ("artist",), years=[2023], months=[1, 3]).first()
    exact = len({r[2] for r in rows if r[0] == 2023 and r[1] in (1, 3)})
    assert abs(one.unique_artist - exact) <= max(1, 3 * relative_error() * exact)
    assert distinct_between(sketches, ("artist",), years=[1999]).first().n_events is None


def test_growing_csv_is_compressed(spark, tmp_path):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.lit("the same text").alias("t"))
    write_rows(rows, f"{tmp_path}/rows", rows_per_file=2000)
    files = [*tmp_path.glob("rows/part-*")]
    assert len(files) > 2 and all(f.name.endswith(".csv.gz") for f in files)
    back = spark.read.csv(f"{tmp_path}/rows", header=True)
    assert back.count() == 5000 and back.subtract(rows).count() == 0


def test_clean_table_merges_files_without_a_shuffle_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("stagefare.sources.listings.ROWS_PER_FILE", 100)
    months = [(2023, 5), (2024, 5), (2024, None)]
    rows = [(str(i), *months[i % 3]) for i in range(1500)]
    df = spark.createDataFrame(rows, "event_id string, year int, month int").repartition(12)
    write_clean(df, f"{tmp_path}/t")
    back = read_clean(spark, f"{tmp_path}/t")
    assert sorted(map(tuple, back.select("event_id", "year", "month").collect()), key=str) == sorted(rows, key=str)
    files = [*(tmp_path / "t").glob("year=*/month=*/*.parquet")]
    assert 3 <= len(files) <= 3 * (2 + 500 // 100)


@pytest.mark.parametrize("rows_per_file", [20, 1_000_000])
@pytest.mark.parametrize("limit", [None, -1])
def test_write_cleaned_holds_the_rows_of_clean_table(spark, tmp_path, monkeypatch, rows_per_file, limit):
    monkeypatch.setattr("stagefare.sources.listings.ROWS_PER_FILE", rows_per_file)
    if limit:
        monkeypatch.setattr("stagefare.functions.joins.BROADCAST_LIMIT_BYTES", limit)
    rows = [_listing(f"e{i}", f"2023-0{1 + i % 5}-03") for i in range(60)]
    rows += [_listing(f"e{i}", f"2023-0{1 + i % 7}-09", venue=f"v{i}") for i in range(0, 60, 2)]
    rows += [_listing(f"e{i}", f"2023-0{1 + i % 7}-09", venue=f"w{i % 3}") for i in range(0, 60, 6)]
    rows += rows[:40] + [_listing("hot", "2023-02-02", venue=f"v{i % 9}") for i in range(200)]
    rows += [_listing(None, "2023-01-01"), _listing("none", None), _listing("odd", "TBA"), _listing("mute", "2023-01-01", artists=None)]
    raw = listings(spark, *rows).repartition(5)
    write_cleaned(raw, str(tmp_path))
    want = clean_table(raw)
    got = read_clean(spark, str(tmp_path)).select(*CLEAN_COLUMNS)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 61


def test_write_cleaned_shuffles_no_whole_rows(spark, tmp_path, monkeypatch):
    """What decides which row of an id stays is its date and number; the rest of a row meets a shuffle only in a tie."""
    monkeypatch.setattr("stagefare.sources.listings.ROWS_PER_FILE", 20)
    seen = []
    frame = type(spark.range(0))
    write = frame.write.fget

    def noted(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.extend(line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Sort [" in line)
        return write(df)

    monkeypatch.setattr(frame, "write", property(noted))
    rows = [_listing(f"e{i % 50}", f"2023-0{1 + i % 3}-{1 + i // 50:02d}", venue=f"v{i}") for i in range(200)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_cleaned(listings(spark, *rows).coalesce(2), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert read_clean(spark, str(tmp_path)).count() == 50
    assert seen and not any("venue" in line for line in seen)
