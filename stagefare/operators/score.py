"""Scoring of tables of price requests ``(artist, city, state, date?, genre?)``.

Each step adds columns to the requests, so a caller can run any part of the
chain. Look-ups are left joins to tables of measured size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagefare.columns import ENCODED_DIMS, mean_column
from stagefare.functions.calendar import full_date
from stagefare.functions.joins import Lookup, look_up, measure, measure_dims
from stagefare.functions.running import quantiles
from stagefare.functions.text import first_number_in_list, strip_list_marks
from stagefare.operators.encoding import MeanEncoding
from stagefare.sources.scratch import materialize

# Fixed values of the scoring rules.
DEFAULT_POPULARITY = 50.0
REPAIR_FACTOR = 1.5
BASE_PROBABILITY = 0.40
POPULARITY_WEIGHT = 0.30
MARKET_WEIGHT = 0.15
WEEKEND_BONUS = 0.10
PEAK_BONUS = 0.05
UNKNOWN_MARKET = 0.5
LEAST_PROBABILITY = 0.10
GREATEST_PROBABILITY = 0.95
GOING_OUT_DAYS = (6, 7, 1)  # Friday, Saturday, Sunday
PEAK_MONTHS = (6, 7, 8, 12)
HIGH_BAND = 0.65
MEDIUM_BAND = 0.40
REQUEST_KEYS = ("artist", "city", "state")
OPTIONAL_KEYS = ("date", "genre")


# -- reference tables -------------------------------------------------------


def artist_reference(raw: DataFrame) -> DataFrame:
    """Greatest popularity and first known genre and subgenre per artist text.

    ``first`` is by date, ties by name. Rows are reduced to their distinct
    (artist, genre, subgenre) before the text-valued aggregates.
    """
    listed = raw.select(
        strip_list_marks("artists").alias("artist"),
        "genre",
        F.col("subGenre").alias("subgenre"),
        first_number_in_list("spotify_popularity").alias("popularity"),
        F.col("date").try_cast("date").alias("day"),
    ).filter(F.col("artist").isNotNull())
    combos = listed.groupBy("artist", "genre", "subgenre").agg(
        F.max("popularity").alias("popularity"), F.min("day").alias("day")
    )

    def first_known(name: str) -> Column:
        ranked = F.struct(F.col("day").isNull(), "day", name)
        return F.min(F.when(F.col(name).isNotNull(), ranked))[name].alias(name)

    return combos.groupBy("artist").agg(
        F.max("popularity").alias("popularity"), first_known("genre"), first_known("subgenre")
    )


def default_popularity(artists: DataFrame) -> DataFrame:
    """Median popularity of the artists that have one, else 50, as one row."""
    middle = quantiles(artists, ["popularity"], [0.5])
    return middle.agg(F.coalesce(F.max("value"), F.lit(DEFAULT_POPULARITY)).alias("default_popularity"))


def paired_means(highest: MeanEncoding, lowest: MeanEncoding) -> DataFrame:
    """Long table ``(dim, key, high, low)`` of the means of both encodings."""
    nothing = F.lit(None).cast("double")
    value = F.col("avg_price")
    both = highest.table.select("dim", "key", value.alias("high"), nothing.alias("low"))
    both = both.unionByName(
        lowest.table.select("dim", "key", nothing.alias("high"), value.alias("low"))
    )
    return both.groupBy("dim", "key").agg(F.max("high").alias("high"), F.max("low").alias("low"))


@dataclass
class ScoringTables:
    """What requests are looked up in."""

    artists: Lookup
    default_popularity: float
    means: dict[str, Lookup]
    global_max: float | None
    global_min: float | None

    @classmethod
    def build(cls, raw: DataFrame, highest: MeanEncoding, lowest: MeanEncoding) -> ScoringTables:
        artists = materialize(artist_reference(raw), "artists")
        means = materialize(paired_means(highest, lowest), "means")
        return cls(
            measure(artists, "artist"),
            default_popularity(artists).first()[0],
            measure_dims(means, ENCODED_DIMS),
            highest.global_mean,
            lowest.global_mean,
        )


# -- request steps ----------------------------------------------------------


def validate(requests: DataFrame) -> DataFrame:
    """Add ``missing``: the absent required fields, null for a valid request.

    The optional ``date`` and ``genre`` are added as null where the table lacks them.
    """
    optional = {
        c: F.lit(None).cast("string") for c in OPTIONAL_KEYS if c not in requests.columns
    }
    absent = [F.when(F.col(k).isNull() | (F.col(k) == ""), F.lit(k)) for k in REQUEST_KEYS]
    named = F.concat_ws(", ", *absent)
    return requests.withColumns({**optional, "missing": F.when(named != "", named)})


def valid_requests(requests: DataFrame) -> DataFrame:
    return validate(requests).filter(F.col("missing").isNull()).drop("missing")


def rejected_requests(requests: DataFrame) -> DataFrame:
    """The requests that cannot be scored, with ``missing``, the fields they lack."""
    return validate(requests).filter(F.col("missing").isNotNull())


def add_calendar(requests: DataFrame, as_of: str, monday_zero: bool = False) -> DataFrame:
    """Day of the request, ``as_of`` where its date is absent or unreadable.

    Weekdays count from 1 = Sunday as in training; ``monday_zero`` counts from
    0 = Monday for models fitted that way.
    """
    day = F.coalesce(full_date(F.col("date")), F.lit(as_of).cast("date"))
    weekday = F.weekday("event_date") if monday_zero else F.dayofweek("event_date")
    return requests.withColumn("event_date", day).withColumns(
        {
            "year": F.year("event_date"),
            "month": F.month("event_date"),
            "weekday": weekday,
            "weekday_name": F.date_format("event_date", "E"),
        }
    )


def add_artist(
    requests: DataFrame, tables: ScoringTables, broadcast_limit: int | None = None
) -> DataFrame:
    """Add the artist's popularity (or the default), genre and subgenre."""
    known = tables.artists.table.select(
        F.col("artist").alias("__artist"),
        F.col("popularity").cast("double").alias("__popularity"),
        F.col("genre").alias("artist_genre"),
        F.col("subgenre").alias("artist_subgenre"),
    )
    lookup = Lookup(known, "__artist", tables.artists.size_bytes)
    keyed = requests.withColumn("artist_key", F.trim("artist"))
    joined = look_up(keyed, lookup, "artist_key", broadcast_limit)
    popularity = F.coalesce("__popularity", F.lit(tables.default_popularity))
    return joined.withColumn("spotify_popularity", popularity).drop("__popularity", "artist_key")


def add_genre(requests: DataFrame) -> DataFrame:
    """Genre of the request, else of the artist; a given genre serves as subgenre too."""
    given = F.when(F.col("genre") != "", F.col("genre"))
    subgenre = F.when(given.isNotNull(), given).otherwise(F.col("artist_subgenre"))
    return requests.withColumns(
        {
            "genre_key": F.coalesce(given, F.col("artist_genre")),
            "subgenre_key": subgenre,
        }
    ).withColumns(
        {
            "genre": F.coalesce("genre_key", F.lit("Unknown")),
            "subgenre": F.coalesce("subgenre_key", F.lit("Unknown")),
        }
    )


def add_means(
    requests: DataFrame, tables: ScoringTables, broadcast_limit: int | None = None
) -> DataFrame:
    """Add ``<dim>_avg_max`` and ``<dim>_avg_min``.

    A city without a mean takes its state's, a subgenre its genre's; states and
    genres take the overall mean.
    """
    keys = {"state": "state", "city": "city", "genre": "genre_key", "subgenre": "subgenre_key"}
    out = requests
    for dim in ENCODED_DIMS:
        means = tables.means[dim]
        named = means.table.select(
            "key", F.col("high").alias(f"__high_{dim}"), F.col("low").alias(f"__low_{dim}")
        )
        out = look_up(out, Lookup(named, "key", means.size_bytes), keys[dim], broadcast_limit)

    columns = {}
    ends = (("max", "high", tables.global_max), ("min", "low", tables.global_min))
    for end, prefix, global_mean in ends:
        overall = F.lit(global_mean).cast("double")
        state = F.coalesce(f"__{prefix}_state", overall)
        genre = F.coalesce(f"__{prefix}_genre", overall)
        columns |= {
            f"state_avg_{end}": state,
            f"city_avg_{end}": F.coalesce(F.col(f"__{prefix}_city"), state),
            f"genre_avg_{end}": genre,
            f"subgenre_avg_{end}": F.coalesce(F.col(f"__{prefix}_subgenre"), genre),
        }
    helpers = [f"__{p}_{d}" for d in ENCODED_DIMS for p in ("high", "low")]
    return out.withColumns(columns).drop(*helpers)


def score_features(
    requests: DataFrame, tables: ScoringTables, as_of: str, monday_zero: bool = False
) -> DataFrame:
    """All columns the models and the probability need, for valid requests."""
    dated = add_calendar(valid_requests(requests), as_of, monday_zero)
    return add_means(add_genre(add_artist(dated, tables)), tables)


def predict_with(features: DataFrame, model: PipelineModel, end: str, column: str) -> DataFrame:
    """Apply one price model, giving it the means of its own end (``max`` or ``min``)."""
    inputs = {mean_column(d): F.col(f"{d}_avg_{end}") for d in ENCODED_DIMS}
    made = model.transform(features.withColumns(inputs))
    kept = [F.col(c) for c in features.columns]
    return made.select(*kept, F.col("prediction").alias(column))


def predict_both(features: DataFrame, highest: PipelineModel, lowest: PipelineModel) -> DataFrame:
    """Add ``pred_max`` and ``pred_min``."""
    return predict_with(predict_with(features, highest, "max", "pred_max"), lowest, "min", "pred_min")


def predict_means(features: DataFrame) -> DataFrame:
    """``pred_max`` and ``pred_min`` without models: the city's mean prices."""
    return features.withColumns(
        {"pred_max": F.col("city_avg_max"), "pred_min": F.col("city_avg_min")}
    )


def repair(scored: DataFrame, factor: float = REPAIR_FACTOR) -> DataFrame:
    """A highest price below the lowest becomes ``factor`` times the lowest."""
    high, low = F.col("pred_max"), F.col("pred_min")
    return scored.withColumn("pred_max", F.when(high < low, low * factor).otherwise(high))


def probability(tables: ScoringTables, monday_zero: bool = False) -> Column:
    """Chance of the event from popularity, city market, weekday and season."""
    overall = tables.global_max
    if overall is not None and overall > 0:
        market = F.least(F.lit(1.0), F.col("city_avg_max") / F.lit(overall))
    else:
        market = F.lit(UNKNOWN_MARKET)
    days = (4, 5, 6) if monday_zero else GOING_OUT_DAYS
    raw = F.lit(BASE_PROBABILITY) + (
        F.col("spotify_popularity") / 100.0 * POPULARITY_WEIGHT
        + market * MARKET_WEIGHT
        + F.when(F.col("weekday").isin(*days), WEEKEND_BONUS).otherwise(0.0)
        + F.when(F.col("month").isin(*PEAK_MONTHS), PEAK_BONUS).otherwise(0.0)
    )
    return F.least(F.lit(GREATEST_PROBABILITY), F.greatest(F.lit(LEAST_PROBABILITY), raw))


def _whole(value: Column) -> Column:
    return F.round(value).cast("bigint").cast("string")


def explanation(importances: dict[str, float], k: int = 6) -> Column:
    """The k most important inputs as (name with its value, importance of the model)."""
    texts = {
        "spotify_popularity": F.concat(F.lit("Spotify Popularity: "), _whole(F.col("spotify_popularity"))),
        "year": F.concat(F.lit("Year ("), F.col("year").cast("string"), F.lit(")")),
        "month": F.concat(F.lit("Month ("), F.col("month").cast("string"), F.lit(")")),
        "weekday": F.concat(F.lit("Weekday ("), F.col("weekday_name"), F.lit(")")),
        "state_avg_price": F.concat(
            F.lit("State ("), F.col("state"), F.lit("): $"), _whole(F.col("state_avg_max"))
        ),
        "city_avg_price": F.concat(
            F.lit("City ("), F.col("city"), F.lit("): $"), _whole(F.col("city_avg_max"))
        ),
        "genre_avg_price": F.concat(F.lit("Genre: $"), _whole(F.col("genre_avg_max"))),
        "subgenre_avg_price": F.concat(F.lit("Subgenre: $"), _whole(F.col("subgenre_avg_max"))),
    }
    ranked = sorted(importances.items(), key=lambda item: (-item[1], item[0]))[:k]
    return F.array(
        *[F.struct(texts[n].alias("name"), F.lit(float(v)).alias("score")) for n, v in ranked]
    )


def output(
    scored: DataFrame,
    tables: ScoringTables,
    importances: dict[str, float] | None = None,
    keep: tuple[str, ...] = ("request_id",),
    monday_zero: bool = False,
) -> DataFrame:
    """The answer per request: rounded probability and prices, explanation and note."""
    note = F.concat(F.lit("Day: "), F.col("weekday_name"), F.lit(", Genre: "), F.col("genre"))
    columns = [
        *keep,
        F.round(probability(tables, monday_zero), 3).alias("probability"),
        F.round("pred_min", 2).alias("pred_min"),
        F.round("pred_max", 2).alias("pred_max"),
        note.alias("note"),
    ]
    if importances:
        columns.append(explanation(importances).alias("top_features"))
    return scored.select(*columns)


def add_band(answers: DataFrame) -> DataFrame:
    """Likelihood band and width of the price range."""
    chance = F.col("probability")
    band = (
        F.when(chance >= HIGH_BAND, "high").when(chance >= MEDIUM_BAND, "medium").otherwise("low")
    )
    spread = F.greatest(F.lit(0.0), F.col("pred_max") - F.col("pred_min"))
    complete = F.col("pred_max").isNotNull() & F.col("pred_min").isNotNull()
    return answers.withColumns({"band": band, "spread": F.when(complete, spread)})


def score_batch(
    requests: DataFrame,
    tables: ScoringTables,
    models: tuple[PipelineModel, PipelineModel] | None,
    as_of: str,
    importances: dict[str, float] | None = None,
    keep: tuple[str, ...] = ("request_id",),
    monday_zero: bool = False,
) -> DataFrame:
    """Answers for all valid requests; without models the city means are the prices."""
    features = score_features(requests, tables, as_of, monday_zero)
    priced = predict_both(features, *models) if models else predict_means(features)
    return add_band(output(repair(priced), tables, importances, keep, monday_zero))


def model_summary(tables: ScoringTables) -> DataFrame:
    """Sizes and overall means of the reference tables, as one row."""
    artists = tables.artists.table.select(F.lit("artist").alias("kind"))
    cities = tables.means["city"].table.filter(F.col("high").isNotNull())
    cities = cities.select(F.lit("city").alias("kind"))
    counted = artists.unionByName(cities)
    return counted.agg(
        F.count_if(F.col("kind") == "artist").alias("total_artists"),
        F.count_if(F.col("kind") == "city").alias("total_cities"),
        F.lit(round_or_none(tables.global_min)).cast("double").alias("global_avg_min"),
        F.lit(round_or_none(tables.global_max)).cast("double").alias("global_avg_max"),
        F.lit(round_or_none(tables.default_popularity)).cast("double").alias("default_popularity"),
    )


def round_or_none(value: float | None) -> float | None:
    return None if value is None else round(float(value), 2)
