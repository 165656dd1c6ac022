"""Raw listing text to typed listing columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagefare.functions.calendar import calendar_parts
from stagefare.functions.text import first_list_item, first_number_in_list, to_int

# Raw column to cleaned column, by kind of conversion.
TEXT = {
    "TM_id": "event_id",
    "event_title": "event_title",
    "venue": "venue",
    "venue_city": "city",
    "venue_state": "state",
    "genre": "genre",
    "subGenre": "subgenre",
    "event_type": "event_type",
    "promoter": "promoter",
    "span multiple days": "span_multiple_days",
}
NUMBERS = {
    "TM_venue _lat": "venue_lat",
    "TM_venue_long": "venue_long",
    "TM_max": "tm_max_price",
    "TM_min": "tm_min_price",
    "SG_average_price": "sg_avg_price",
    "SG_min_price": "sg_min_price",
    "SG_max_price": "sg_max_price",
    "SG_artists_score": "sg_artist_score",
    "SG_venue_score": "sg_venue_score",
    "SH_max_price": "sh_max_price",
    "SH_min_price": "sh_min_price",
}
COUNTS = {
    "SG_listing_count": "sg_listing_count",
    "SH_total_postings": "sh_total_postings",
    "SH_total_tickets": "sh_total_tickets",
}
LIST_NUMBERS = {
    "spotify_followers": "spotify_followers",
    "spotify_popularity": "spotify_popularity",
}
TIMES = {
    "presale_date_start": "presale_start",
    "presale_date_end": "presale_end",
    "TM_sale_date_start": "sale_start",
}
CLEAN_COLUMNS = (
    "event_id",
    "event_title",
    "artist",
    "event_date",
    "venue",
    "city",
    "state",
    "venue_lat",
    "venue_long",
    "genre",
    "subgenre",
    "event_type",
    "tm_max_price",
    "tm_min_price",
    "price_range",
    "sg_avg_price",
    "sg_min_price",
    "sg_max_price",
    "sg_listing_count",
    "sg_artist_score",
    "sg_venue_score",
    "sh_max_price",
    "sh_min_price",
    "sh_total_postings",
    "sh_total_tickets",
    "spotify_followers",
    "spotify_popularity",
    "has_spotify_data",
    "has_secondary_market",
    "year",
    "month",
    "weekday",
    "is_weekend",
    "presale_start",
    "presale_end",
    "sale_start",
    "promoter",
    "span_multiple_days",
)


def _raw(name: str) -> Column:
    return F.col(f"`{name}`")


def typed_columns(artist_mode: str = "strict_single") -> list[Column]:
    """Every raw column under its cleaned name and type; unreadable text is null."""
    return [
        *[_raw(raw).alias(name) for raw, name in TEXT.items()],
        *[_raw(raw).try_cast("double").alias(name) for raw, name in NUMBERS.items()],
        *[to_int(_raw(raw)).alias(name) for raw, name in COUNTS.items()],
        *[first_number_in_list(_raw(raw)).alias(name) for raw, name in LIST_NUMBERS.items()],
        *[_raw(raw).try_cast("timestamp").alias(name) for raw, name in TIMES.items()],
        first_list_item(_raw("artists"), artist_mode).alias("artist"),
        _raw("date").try_cast("date").alias("event_date"),
    ]


def derived_columns() -> dict[str, Column]:
    """Columns computed from typed ones.

    ``has_secondary_market`` keeps three values: true if either count is
    positive, null if none is and one is missing.
    """
    return {
        "price_range": F.col("tm_max_price") - F.col("tm_min_price"),
        "has_spotify_data": F.col("spotify_followers").isNotNull(),
        "has_secondary_market": (F.col("sg_listing_count") > 0)
        | (F.col("sh_total_postings") > 0),
        **calendar_parts(F.col("event_date")),
    }


# What follows from other columns, all of which stand earlier in CLEAN_COLUMNS.
DERIVED = ("price_range", "has_spotify_data", "has_secondary_market", "year", "month", "weekday", "is_weekend")
TYPED_COLUMNS = tuple(c for c in CLEAN_COLUMNS if c not in DERIVED)


def typed_listings(raw: DataFrame, artist_mode: str = "strict_single") -> DataFrame:
    """The cleaned columns that do not follow from others.

    Rows that are about to be shuffled take this form: the rest is computed after it, and as it comes
    from columns that are compared before it, it changes no order of rows.
    """
    return raw.select(*typed_columns(artist_mode)).select(*TYPED_COLUMNS)


def with_derived(typed: DataFrame) -> DataFrame:
    """All cleaned columns of :func:`typed_listings`."""
    return typed.withColumns(derived_columns()).select(*CLEAN_COLUMNS)


def clean_listings(raw: DataFrame, artist_mode: str = "strict_single") -> DataFrame:
    """The 38 cleaned columns of a raw listing table, row for row."""
    return with_derived(typed_listings(raw, artist_mode))
