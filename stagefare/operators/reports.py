"""Ranked reports and summaries over a cleaned listing table.

Every report is one aggregate: combined within tasks, then shuffled by its
group keys. Reports limited to k rows end in a distributed top-k. Order ties are
broken by the group keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagefare.columns import ListingColumns
from stagefare.functions.calendar import weekday_name
from stagefare.functions.ratios import percent_of, premium_percent
from stagefare.operators.rows import all_present

LISTING = ListingColumns()


def _events() -> Column:
    return F.count("*").alias("event_count")


def _total(counts: str) -> Column:
    return F.coalesce(F.sum(counts), F.lit(0))


def report_year_genre(df: DataFrame, c: ListingColumns = LISTING) -> DataFrame:
    """Events, mean price and mean popularity per year and genre."""
    return (
        df.groupBy(c.year, c.genre)
        .agg(
            _events(),
            F.avg(c.min_price).alias("avg_price"),
            F.avg(c.popularity).alias("avg_popularity"),
        )
        .orderBy(c.year, F.desc("event_count"), c.genre)
    )


def report_top_cities(df: DataFrame, c: ListingColumns = LISTING, k: int = 50) -> DataFrame:
    """The k cities with most events."""
    return (
        df.groupBy(c.city, c.state)
        .agg(
            _events(),
            F.count_distinct(c.artist).alias("unique_artists"),
            F.avg(c.min_price).alias("avg_price"),
            F.count_if(c.has_resale).alias("secondary_market_events"),
        )
        .orderBy(F.desc("event_count"), c.city, c.state)
        .limit(k)
    )


def report_top_artists(df: DataFrame, c: ListingColumns = LISTING, k: int = 100) -> DataFrame:
    """The k artists of highest mean popularity, among rows that have one.

    Of an artist's follower counts the greatest is shown.
    """
    return (
        df.filter(F.col(c.popularity).isNotNull())
        .groupBy(c.artist)
        .agg(
            _events(),
            F.avg(c.popularity).alias("avg_spotify_popularity"),
            F.max(c.followers).alias("spotify_followers"),
            F.avg(c.min_price).alias("avg_ticket_price"),
            F.count_distinct(c.city).alias("cities_performed"),
        )
        .orderBy(F.desc("avg_spotify_popularity"), c.artist)
        .limit(k)
    )


def report_weekday(df: DataFrame, c: ListingColumns = LISTING) -> DataFrame:
    """Events and mean price per day of the week."""
    return (
        df.groupBy(c.weekday, c.is_weekend)
        .agg(_events(), F.avg(c.min_price).alias("avg_price"))
        .select(
            c.weekday,
            weekday_name(F.col(c.weekday)).alias("weekday_name"),
            c.is_weekend,
            "event_count",
            "avg_price",
        )
        .orderBy(c.weekday)
    )


def report_secondary_market(df: DataFrame, c: ListingColumns = LISTING) -> DataFrame:
    """Resale prices and mean premium over the primary price, per genre."""
    return (
        df.filter(F.col(c.has_resale))
        .groupBy(c.genre)
        .agg(
            _events(),
            F.avg(c.resale_avg).alias("avg_seatgeek_price"),
            F.avg(c.resale_max).alias("avg_stubhub_max"),
            F.avg(c.min_price).alias("avg_tm_price"),
            F.avg(premium_percent(F.col(c.resale_avg), F.col(c.min_price))).alias(
                "avg_premium_pct"
            ),
        )
        .orderBy(F.desc("event_count"), c.genre)
    )


def report_price_by_state(df: DataFrame, c: ListingColumns = LISTING, k: int = 50) -> DataFrame:
    """The k states of highest mean minimum price."""
    return (
        df.filter(F.col(c.min_price).isNotNull())
        .groupBy(c.state)
        .agg(
            _events(),
            F.min(c.min_price).alias("min_price"),
            F.avg(c.min_price).alias("avg_price"),
            F.max(c.max_price).alias("max_price"),
            F.avg(c.price_range).alias("avg_price_range"),
        )
        .orderBy(F.desc("avg_price"), c.state)
        .limit(k)
    )


def summary_overall(df: DataFrame, c: ListingColumns = LISTING, approx: bool = False) -> DataFrame:
    """Size and date range of the table; ``approx`` estimates the distinct counts.

    The exact counts are taken over the distinct (artist, city, state) rows,
    which are far fewer than the listings.
    """
    dates = [F.min(c.event_date).alias("earliest_event"), F.max(c.event_date).alias("latest_event")]
    names = {"unique_artists": c.artist, "unique_cities": c.city, "unique_states": c.state}
    if approx:
        counts = [F.approx_count_distinct(v).alias(n) for n, v in names.items()]
        return df.agg(F.count("*").alias("total_events"), *counts, *dates)
    combos = df.groupBy(*names.values()).agg(
        F.count("*").alias("n"),
        F.min(c.event_date).alias("first_date"),
        F.max(c.event_date).alias("last_date"),
    )
    return combos.agg(
        _total("n").alias("total_events"),
        *[F.count_distinct(v).alias(n) for n, v in names.items()],
        F.min("first_date").alias("earliest_event"),
        F.max("last_date").alias("latest_event"),
    )


def summary_genre_top10(df: DataFrame, c: ListingColumns = LISTING, k: int = 10) -> DataFrame:
    """The k genres with most events."""
    return df.groupBy(c.genre).count().orderBy(F.desc("count"), c.genre).limit(k)


def coverage(df: DataFrame, flags: dict[str, str] | None = None) -> DataFrame:
    """Count and percentage of rows where each flag is true, in one pass."""
    flags = flags or {"spotify": LISTING.has_profile, "secondary": LISTING.has_resale}
    total = F.count("*")
    measures = [total.alias("total")]
    for name, flag in flags.items():
        hits = F.count_if(flag)
        measures += [hits.alias(f"with_{name}"), percent_of(hits, total).alias(f"pct_{name}")]
    return df.agg(*measures)


def clean_stats(df: DataFrame, c: ListingColumns = LISTING) -> DataFrame:
    """Closing statistics of the cleaning step, over the distinct (artist, city) rows."""
    combos = df.groupBy(c.artist, c.city).agg(
        F.count("*").alias("rows"),
        F.sum(c.min_price).alias("price_sum"),
        F.count(c.min_price).alias("price_n"),
        F.sum(c.popularity).alias("popularity_sum"),
        F.count(c.popularity).alias("popularity_n"),
        F.count_if(c.has_resale).alias("resold"),
    )
    return combos.agg(
        _total("rows").alias("total_records"),
        F.count_distinct(c.artist).alias("unique_artists"),
        F.count_distinct(c.city).alias("unique_cities"),
        F.try_divide(F.sum("price_sum"), F.sum("price_n")).alias("avg_tm_price"),
        F.try_divide(F.sum("popularity_sum"), F.sum("popularity_n")).alias(
            "avg_spotify_popularity"
        ),
        _total("resold").alias("secondary_market_count"),
    )


def id_counts(c: ListingColumns = LISTING) -> list[Column]:
    """Aggregates by id that :func:`sum_id_counts` adds up."""
    return [
        F.count("*").alias("rows"),
        F.count(c.event_date).alias("dated"),
        F.count(c.artist).alias("named"),
        F.count_if(c.has_profile).alias("profiled"),
        F.count_if(c.has_resale).alias("resold"),
        F.count_if(all_present(c.required)).alias("complete"),
    ]


def sum_id_counts(per_id: DataFrame) -> DataFrame:
    """Row counts before de-duplication, after it, and after the required filter.

    ``per_id`` has a row per id with :func:`id_counts`. An id counts as kept if one of its rows is
    complete, which is the row that de-duplication prefers.
    """
    return per_id.agg(
        _total("rows").alias("total"),
        _total("dated").alias("valid_date"),
        _total("named").alias("with_artist"),
        _total("profiled").alias("with_spotify"),
        _total("resold").alias("with_secondary"),
        F.count("*").alias("after_dedup"),
        F.count_if(F.col("complete") > 0).alias("after_filter"),
    )


def quality_counts(cleaned: DataFrame, c: ListingColumns = LISTING) -> DataFrame:
    """The counts of :func:`sum_id_counts` from the table before both steps.

    Only ids and counts are shuffled. The counts are a query and not metrics observed
    during the write, because a stage that runs again after an executor is lost
    would be counted twice.
    """
    return sum_id_counts(cleaned.groupBy(c.event_id).agg(*id_counts(c)))
