"""Names and schemas of the listing tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Header names of the raw listing file. Two of them hold blanks.
RAW_COLUMNS = (
    "TM_id",
    "event_title",
    "artists",
    "date",
    "venue",
    "venue_city",
    "venue_state",
    "TM_venue _lat",
    "TM_venue_long",
    "genre",
    "subGenre",
    "event_type",
    "TM_max",
    "TM_min",
    "SG_average_price",
    "SG_min_price",
    "SG_max_price",
    "SG_listing_count",
    "SG_artists_score",
    "SG_venue_score",
    "SH_max_price",
    "SH_min_price",
    "SH_total_postings",
    "SH_total_tickets",
    "spotify_followers",
    "spotify_popularity",
    "presale_date_start",
    "presale_date_end",
    "TM_sale_date_start",
    "promoter",
    "span multiple days",
)

# Raw values stay text until the cleaning step gives them a type, so reading
# needs no inference pass and one odd value cannot change a column's type.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])


@dataclass(frozen=True)
class ListingColumns:
    """Column names of a cleaned listing table, so operators fit any such table."""

    event_id: str = "event_id"
    artist: str = "artist"
    event_date: str = "event_date"
    city: str = "city"
    state: str = "state"
    genre: str = "genre"
    subgenre: str = "subgenre"
    max_price: str = "tm_max_price"
    min_price: str = "tm_min_price"
    price_range: str = "price_range"
    resale_avg: str = "sg_avg_price"
    resale_max: str = "sh_max_price"
    followers: str = "spotify_followers"
    popularity: str = "spotify_popularity"
    has_profile: str = "has_spotify_data"
    has_resale: str = "has_secondary_market"
    year: str = "year"
    month: str = "month"
    weekday: str = "weekday"
    is_weekend: str = "is_weekend"

    @property
    def required(self) -> tuple[str, str, str]:
        """Columns every cleaned row must have."""
        return (self.event_id, self.event_date, self.artist)


@dataclass(frozen=True)
class Label:
    """A price to predict and whether a zero price is a usable value for it."""

    column: str
    allow_zero: bool = False


MAX_PRICE = Label("tm_max_price")
MIN_PRICE = Label("tm_min_price", allow_zero=True)

# Model inputs shared by training and scoring.
ENCODED_DIMS = ("state", "city", "genre", "subgenre")
ONE_HOT_DIMS = ("genre", "subgenre", "state", "city")
PLAIN_FEATURES = ("spotify_popularity", "year", "month", "weekday")
FILL_VALUES = {
    "spotify_popularity": 0,
    "genre": "Unknown",
    "subgenre": "Unknown",
    "city": "Unknown",
    "state": "Unknown",
}


def mean_column(dim: str) -> str:
    """Name of the target-mean feature of a category column."""
    return f"{dim}_avg_price"


MEAN_FEATURES = PLAIN_FEATURES + tuple(mean_column(d) for d in ENCODED_DIMS)
