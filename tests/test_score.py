"""Scoring against a plain Python calculation on a small fixture."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from stagefare.columns import ENCODED_DIMS, MAX_PRICE, MIN_PRICE, RAW_COLUMNS, RAW_SCHEMA
from stagefare.operators import score
from stagefare.operators.encoding import MeanEncoder
from stagefare.operators.evaluate import importance_values
from stagefare.plans import scoring, training
from stagefare.plans.cleaning import clean_table

AS_OF = "2024-06-15"

LISTED = [
    # artists, popularity, genre, subgenre, date, city, state, min, max
    ("['Taylor Swift']", "[90]", "Pop", "Dance", "2024-06-01", "New York", "NY", 50.0, 400.0),
    ("['Taylor Swift']", "[95]", "Country", None, "2024-01-01", "New York", "NY", 60.0, 300.0),
    ("['Bad Bunny']", "['NaN', 88]", "Hip-Hop / Rap", "Latin", "2024-07-01", "Miami", "FL", 40.0, 200.0),
    ("['A', 'B']", "[10]", None, "Indie", "2024-03-01", "Miami", "FL", 20.0, 30.0),
    ("['A', 'B']", "['NaN']", "Rock", "Metal", "2024-05-01", "Tampa", "FL", 25.0, 35.0),
    ("['Quiet']", "[]", None, None, "2024-05-01", "Albany", "NY", 15.0, 16.0),
]
ASKED = [
    ("1", "Taylor Swift", "New York", "NY", "2024-06-15", "Pop"),
    ("2", " Bad Bunny ", "Miami", "FL", "2024-07-20", None),
    ("3", "Mannheim Steamroller Christmas", "Huntsville", "AL", None, "New Age"),
    ("4", "A, B", "Orlando", "FL", "2024-13-40", ""),
    ("5", "Quiet", "Albany", "NY", "2024-02-05", None),
    ("6", "", "Albany", "NY", "2024-02-05", None),
    ("7", "Quiet", None, "", "2024-02-05", None),
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = []
    for i, (artists, pop, genre, sub, date, city, state, low, high) in enumerate(LISTED):
        given = {
            "TM_id": f"e{i}", "artists": artists, "spotify_popularity": pop, "genre": genre,
            "subGenre": sub, "date": date, "venue_city": city, "venue_state": state,
            "TM_min": str(low), "TM_max": str(high),
        }
        rows.append(tuple(given.get(c) for c in RAW_COLUMNS))
    return spark.createDataFrame(rows, RAW_SCHEMA)


@pytest.fixture(scope="module")
def tables(raw):
    cleaned = clean_table(raw)
    made = [MeanEncoder(x).fit(training.labelled(cleaned, x)) for x in (MAX_PRICE, MIN_PRICE)]
    return score.ScoringTables.build(raw, *made)


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(
        ASKED, "request_id string, artist string, city string, state string, date string, genre string"
    )


def mean(rows, column):
    return statistics.fmean(r[column] for r in rows)


def expected(request, end):
    """City, state, genre and subgenre means by the fall-back rules, in plain Python."""
    _, artist, city, state, _, genre = request
    column = 8 if end == "max" else 7
    overall = mean(LISTED, column)

    def of(position, value, fallback):
        rows = [r for r in LISTED if (r[position] or "Unknown") == value]
        return mean(rows, column) if rows else fallback

    known = {
        "Taylor Swift": ("Country", "Dance"),
        "Bad Bunny": ("Hip-Hop / Rap", "Latin"),
        "A, B": ("Rock", "Indie"),
    }.get(artist.strip(), (None, None))
    key, sub = (genre, genre) if genre else known
    at_state = of(6, state, overall)
    at_genre = of(2, key, overall)
    return {
        "state": at_state,
        "city": of(5, city, at_state),
        "genre": at_genre,
        "subgenre": of(3, sub, at_genre),
    }


def test_artist_reference(raw):
    rows = {r.artist: (r.popularity, r.genre, r.subgenre) for r in score.artist_reference(raw).collect()}
    assert rows == {
        "Taylor Swift": (95, "Country", "Dance"),
        "Bad Bunny": (88, "Hip-Hop / Rap", "Latin"),
        "A, B": (10, "Rock", "Indie"),
        "Quiet": (None, None, None),
    }


def test_default_popularity(spark, tables):
    assert tables.default_popularity == 88.0
    none = spark.createDataFrame([(None,)], "popularity int")
    assert score.default_popularity(none).first()[0] == 50.0


def test_validate_names_what_is_missing(asked):
    got = {r.request_id: r.missing for r in score.validate(asked).collect()}
    assert got == {**{str(i): None for i in range(1, 6)}, "6": "artist", "7": "city, state"}


def test_features_match_plain_python(asked, tables):
    rows = {r.request_id: r for r in score.score_features(asked, tables, AS_OF).collect()}
    assert set(rows) == {"1", "2", "3", "4", "5"}
    for request in ASKED[:5]:
        for end in ("max", "min"):
            for dim, value in expected(request, end).items():
                assert rows[request[0]][f"{dim}_avg_{end}"] == pytest.approx(value), (request, dim)
    assert [rows[str(i)].spotify_popularity for i in range(1, 6)] == [95, 88, 88, 10, 88]
    assert [rows[str(i)].genre for i in range(1, 6)] == ["Pop", "Hip-Hop / Rap", "New Age", "Rock", "Unknown"]
    assert [rows[str(i)].subgenre for i in range(1, 6)] == ["Pop", "Latin", "New Age", "Indie", "Unknown"]
    assert rows["3"].event_date == rows["4"].event_date == dt.date(2024, 6, 15)


def test_look_ups_by_shuffle_give_the_same(asked, tables):
    dated = score.add_calendar(score.valid_requests(asked), AS_OF)
    small = score.add_means(score.add_genre(score.add_artist(dated, tables)), tables)
    large = score.add_artist(dated, tables, broadcast_limit=0)
    large = score.add_means(score.add_genre(large), tables, broadcast_limit=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_weekday_conventions(asked):
    sunday = {r.request_id: r.weekday for r in score.add_calendar(asked, AS_OF).collect()}
    monday = {r.request_id: r.weekday for r in score.add_calendar(asked, AS_OF, True).collect()}
    assert (sunday["1"], monday["1"]) == (7, 5)
    assert (sunday["5"], monday["5"]) == (2, 0)


def test_probability_matches_plain_python(asked, tables):
    overall = mean(LISTED, 8)
    days = {"1": dt.date(2024, 6, 15), "2": dt.date(2024, 7, 20), "3": dt.date(2024, 6, 15),
            "4": dt.date(2024, 6, 15), "5": dt.date(2024, 2, 5)}
    popularity = {"1": 95, "2": 88, "3": 88, "4": 10, "5": 88}
    for monday in (False, True):
        made = score.score_features(asked, tables, AS_OF, monday)
        got = made.select("request_id", score.probability(tables, monday).alias("p")).collect()
        for r in got:
            request = next(a for a in ASKED if a[0] == r.request_id)
            city = expected(request, "max")["city"]
            day = days[r.request_id]
            p = 0.4 + popularity[r.request_id] / 100 * 0.3 + min(1, city / overall) * 0.15
            p += 0.1 * (day.weekday() in (4, 5, 6)) + 0.05 * (day.month in (6, 7, 8, 12))
            assert r.p == pytest.approx(min(0.95, max(0.1, p)))


def test_probability_bounds(spark, tables):
    row = "select 'a' request_id, {p}D spotify_popularity, 1e9D city_avg_max, 7 weekday, 7 month"
    for popularity, value in ((1000.0, 0.95), (-1000.0, 0.10)):
        df = spark.sql(row.format(p=popularity))
        assert df.select(score.probability(tables)).first()[0] == value


def test_repair_and_band(spark):
    df = spark.createDataFrame([(10.0, 20.0, 0.65), (30.0, 20.0, 0.4), (20.0, 20.0, 0.39)], "pred_max double, pred_min double, probability double")
    rows = score.add_band(score.repair(df)).collect()
    assert [r.pred_max for r in rows] == [30.0, 30.0, 20.0]
    assert [r.band for r in rows] == ["high", "medium", "low"]
    assert [r.spread for r in rows] == [10.0, 10.0, 0.0]


def test_scoring_with_models(spark, raw, tables, asked, tmp_path):
    cleaned = clean_table(raw)
    folders = {}
    for label, end in ((MAX_PRICE, "max"), (MIN_PRICE, "min")):
        data = training.prepare_means(cleaned, label)
        model = training.mean_model("decision_tree", label, maxDepth=2)
        folders[end] = f"{tmp_path}/{end}"
        training.train_job(cleaned, label, folders[end], "rf", preset="quick")
        assert set(importance_values(model.fit(data.train), data.test)) >= {f"{d}_avg_price" for d in ENCODED_DIMS}
    scoring.score_job(asked, raw, folders["max"], folders["min"], f"{tmp_path}/answers", AS_OF)
    answers = spark.read.parquet(f"{tmp_path}/answers")
    assert answers.count() == 5
    first = answers.filter("request_id = '1'").first()
    assert first.note == "Day: Sat, Genre: Pop" and len(first.top_features) == 6
    scores = [f.score for f in first.top_features]
    assert scores == sorted(scores, reverse=True)
    assert answers.filter(F.col("pred_max") < F.col("pred_min")).count() == 0


def test_model_summary(tables):
    row = score.model_summary(tables).first()
    assert (row.total_artists, row.total_cities) == (4, 4)
    assert row.global_avg_max == round(mean(LISTED, 8), 2)


def test_optional_fields_may_be_absent(asked, tables):
    few = asked.select("request_id", "artist", "city", "state")
    rows = score.score_batch(few, tables, None, AS_OF).collect()
    assert len(rows) == 5 and all(r.note.startswith("Day: Sat") for r in rows)
