"""The same queries as DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from stagefare.catalog.fixture import DECIMALS, NUDGE, RAW_SQL, REQUEST_SQL, TABLES

_NAMES = {t: t for t in TABLES}
_AS_OF = "2024-06-15"


def _int(text: str) -> str:
    plain = f"regexp_full_match({text}, ' *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+) *')"
    number = f"try_cast(ltrim(trim({text}), '+') as double)"
    return f"case when {plain} then try_cast(trunc({number}) as integer) end"


def _list_number(column: str) -> str:
    items = f"string_split(regexp_replace({column}, '\\[|\\]', '', 'g'), ',')"
    usable = f"list_filter({items}, lambda v: trim(replace(v, '''', '')) not in ('NaN', ''))"
    return _int(f"{usable}[1]")


RAW = "raw as (" + RAW_SQL.format(**_NAMES) + ")"
REQUESTS = "requests as (" + REQUEST_SQL.format(**_NAMES) + ")"

TYPED = f"""typed as (
select tm_id as event_id, event_title,
 case when artists is null then null
      else regexp_extract(artists, '\\[''([^'']+)''\\]', 1) end as artist,
 try_cast(event_day as date) as event_date,
 venue, venue_city as city, venue_state as state,
 try_cast(venue_lat as double) as venue_lat, try_cast(venue_long as double) as venue_long,
 genre, subgenre, event_type,
 try_cast(tm_max as double) as tm_max_price, try_cast(tm_min as double) as tm_min_price,
 try_cast(tm_max as double) - try_cast(tm_min as double) as price_range,
 try_cast(sg_average_price as double) as sg_avg_price,
 try_cast(sg_min_price as double) as sg_min_price,
 try_cast(sg_max_price as double) as sg_max_price,
 {_int('sg_listing_count')} as sg_listing_count,
 try_cast(sg_artists_score as double) as sg_artist_score,
 try_cast(sg_venue_score as double) as sg_venue_score,
 try_cast(sh_max_price as double) as sh_max_price, try_cast(sh_min_price as double) as sh_min_price,
 {_int('sh_total_postings')} as sh_total_postings,
 {_int('sh_total_tickets')} as sh_total_tickets,
 {_list_number('spotify_followers')} as spotify_followers,
 {_list_number('spotify_popularity')} as spotify_popularity,
 {_list_number('spotify_followers')} is not null as has_spotify_data,
 {_int('sg_listing_count')} > 0 or {_int('sh_total_postings')} > 0 as has_secondary_market,
 cast(year(try_cast(event_day as date)) as integer) as year,
 cast(month(try_cast(event_day as date)) as integer) as month,
 cast(dayofweek(try_cast(event_day as date)) + 1 as integer) as weekday,
 dayofweek(try_cast(event_day as date)) in (0, 6) as is_weekend,
 try_cast(presale_date_start as timestamp) as presale_start,
 try_cast(presale_date_end as timestamp) as presale_end,
 try_cast(tm_sale_date_start as timestamp) as sale_start,
 promoter, span_multiple_days
from raw)"""

_RANKED = (
    "event_date",
    "artist",
    "event_title",
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
_ORDER = "(event_date is not null and artist is not null) desc, " + ", ".join(
    f"{c} desc nulls last" for c in _RANKED
)

ONE_PER_ID = f"""one_per_id as (
select * from (select *, row_number() over (partition by event_id order by {_ORDER}) as rn from typed)
where rn = 1)"""

KEPT = """kept as (
select * from one_per_id
where event_id is not null and event_date is not null and artist is not null)"""

CLEAN = ", ".join([RAW, TYPED])
TABLE = ", ".join([RAW, TYPED, ONE_PER_ID, KEPT])

_ROUNDED = {
    "venue_lat", "venue_long", "tm_max_price", "tm_min_price", "price_range", "sg_avg_price",
    "sg_min_price", "sg_max_price", "sg_artist_score", "sg_venue_score", "sh_max_price",
    "sh_min_price",
}
_TIMES = {"presale_start", "presale_end", "sale_start"}


def _show(column: str) -> str:
    if column in _ROUNDED:
        return f"round({column}, 4) as {column}"
    if column == "event_date":
        return "strftime(event_date, '%Y-%m-%d') as event_date"
    if column in _TIMES:
        return f"strftime({column}, '%Y-%m-%d %H:%M:%S') as {column}"
    return column


def _rows(columns: str, source: str, prefix: str = CLEAN) -> str:
    shown = ", ".join(_show(c) for c in columns.split())
    return f"with {prefix} select {shown} from {source}"


def _from_table(body: str) -> str:
    return f"with {TABLE} {body}"


# -- training ---------------------------------------------------------------

_MAX, _MIN = "tm_max_price", "tm_min_price"
_DIMS = ("state", "city", "genre", "subgenre")


def _base(label: str, name: str = "base") -> str:
    usable = f"{label} > 0" if label == _MAX else f"{label} >= 0"
    return f"""{name} as (
select event_id, artist, event_date, coalesce(spotify_popularity, 0) as spotify_popularity,
 year, month, weekday, coalesce(state, 'Unknown') as state, coalesce(city, 'Unknown') as city,
 coalesce(genre, 'Unknown') as genre, coalesce(subgenre, 'Unknown') as subgenre, {label},
 ('0x' || substr(md5(event_id), 1, 8))::bigint % 100 < 80 as in_train
from kept where {usable} and artist is not null)"""


def _encoding(label: str, base: str = "base", suffix: str = "") -> str:
    parts = [
        f"m_{d}{suffix} as (select {d} as k, avg({label}) as mean, count({label}) as n,"
        f" sum({label}) as total from {base} where in_train group by {d})"
        for d in _DIMS
    ]
    parts.append(
        f"m_all{suffix} as (select avg({label}) as mean, count({label}) as n"
        f" from {base} where in_train)"
    )
    return ", ".join(parts)


def _encoded(test: bool = True) -> str:
    means = ", ".join(
        f"coalesce(m_{d}.mean, (select mean from m_all), 0) as {d}_avg_price" for d in _DIMS
    )
    joins = " ".join(f"left join m_{d} on b.{d} = m_{d}.k" for d in _DIMS)
    side = "not b.in_train" if test else "b.in_train"
    name = "test" if test else "train"
    return f"{name} as (select b.*, {means} from base b {joins} where {side})"


def _learn(label: str, *more: str) -> str:
    return "with " + ", ".join([TABLE, _base(label), _encoding(label), *more])


def _errors(prediction: str, label: str = _MAX) -> str:
    square = f"power({label} - {prediction}, 2)"
    return (
        f"round(sqrt(avg({square})), 4) as rmse, round(avg(abs({label} - {prediction})), 4) as mae,"
        f" round(1 - sum({square}) / (count(*) * var_pop({label})), 4) as r2"
    )


_COMPARISON = " union all ".join(
    f"select '{d}_mean' as model, {_errors(f'{d}_avg_price')} from test" for d in _DIMS
)
_MAP = " union all ".join(
    [f"select '{d}' as dim, k as key, round(mean, 4) as avg_price, n from m_{d}" for d in _DIMS]
    + ["select 'global', 'global', round(mean, 4), n from m_all"]
)
_MEAN_COLUMNS = ", ".join(f"round({d}_avg_price, 4) as {d}_avg_price" for d in _DIMS)
_LEFT_OUT = ", ".join(
    f"round(coalesce((m_{d}.total - b.{_MAX}) / nullif(m_{d}.n - 1, 0),"
    f" (select mean from m_all), 0), 4) as {d}_avg_price"
    for d in _DIMS
)

_INDEX = ", ".join(
    f"i_{d} as (select {d} as label, row_number() over (order by count(*) desc, {d}) - 1 as idx"
    f" from base where in_train group by {d})"
    for d in _DIMS
)
_INDEXED = " union all ".join(
    f"select '{d}' as dim, b.{d} as label, cast(coalesce(i.idx, (select count(*) from i_{d}))"
    f" as double) as idx, count(*) as count from base b left join i_{d} i on b.{d} = i.label"
    f" where not b.in_train group by 1, 2, 3"
    for d in _DIMS
)
_ONE_HOT = " union all ".join(
    f"select '{d}' as dim, cast(i.idx as integer) as slot, cast(count(b.{d}) as double) as total"
    f" from i_{d} i left join (select * from base where not in_train) b on b.{d} = i.label"
    f" group by 1, 2"
    for d in _DIMS
)

_MODEL_INPUTS = (
    "spotify_popularity", "year", "month", "weekday", *(f"{d}_avg_price" for d in _DIMS)
)


def _zeros(one: tuple[str, tuple], two: tuple[str, tuple], value: str) -> str:
    """A row of zero for every pair of names."""
    return " union all ".join(
        f"select '{a}' as {one[0]}, '{b}' as {two[0]}, 0.0::double as {value}"
        for a in one[1]
        for b in two[1]
    )


# Penalised regression on one feature x: strength l, L1 share a.
def _penalised(strength: float, l1: float) -> str:
    return f"""s as (
 select corr(y, x) as r, stddev_pop(y) as sy, stddev_pop(x) as sx, avg(y) as my, avg(x) as mx
 from (select tm_max_price as y, spotify_popularity as x from base where in_train)),
w as (select sign(r) * greatest(abs(r) - {l1} * {strength} / sy, 0)
  / (1 + (1 - {l1}) * {strength} / sy) * sy / sx as slope, my, mx from s)"""


def _slope_rows(model: str) -> str:
    return (
        f"select '{model}' as model, 'spotify_popularity' as term, round(slope, 4) as weight from w"
        f" union all select '{model}', 'intercept', round(my - slope * mx, 4) from w"
    )


_ONE = _penalised(0.0, 0.0)
_TWO = """c as (
 select var_pop(p) as vp, var_pop(m) as vm, covar_pop(p, m) as pm, covar_pop(y, p) as yp,
  covar_pop(y, m) as ym, avg(y) as ay, avg(p) as ap, avg(m) as am
 from (select tm_max_price as y, spotify_popularity as p, month as m from base where in_train)),
k as (select (yp * vm - ym * pm) / (vp * vm - pm * pm) as wp,
  (ym * vp - yp * pm) / (vp * vm - pm * pm) as wm, ay, ap, am from c)"""

# Best split of a node by squared error, over the midpoints of its months.
# ``node`` tables hold (grp, month, y).
def _split(name: str, node: str) -> str:
    return f"""{name}_m as (select grp, month, count(*) as n, sum(y) as s from {node} group by 1, 2),
{name}_c as (
 select grp, month, sum(n) over up as ln, sum(s) over up as ls,
  sum(n) over (partition by grp) as tn, sum(s) over (partition by grp) as ts
 from {name}_m window up as (partition by grp order by month)),
{name} as (
 select grp, arg_max(month, ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln)) as cut
 from {name}_c where tn > ln group by grp)"""


_STUMP = ", ".join(
    [
        "n0 as (select 0 as grp, month, tm_max_price as y from base where in_train)",
        _split("c0", "n0"),
        "n1 as (select case when month <= cut then 1 else 2 end as grp, month, y from n0, c0)",
    ]
)
_TREE = ", ".join(
    [
        _STUMP,
        _split("c1", "n1"),
        """leaf as (
 select n1.grp, n1.month <= c1.cut as lower, avg(y) as mean
 from n1 left join c1 on n1.grp = c1.grp group by 1, 2)""",
        """placed as (
 select event_id, month, case when month <= (select cut from c0) then 1 else 2 end as grp
 from base where not in_train)""",
    ]
)
_TREE_ROWS = """select event_id, month, round(mean, 4) as prediction
from placed p left join c1 on p.grp = c1.grp
 join leaf on leaf.grp = p.grp and leaf.lower is not distinct from (p.month <= c1.cut)"""

_BOOSTED = ", ".join(
    [
        _STUMP,
        "f0 as (select grp, avg(y) as mean from n1 group by grp)",
        "r0 as (select 0 as grp, month, 2 * (y - mean) as y from n1 join f0 on n1.grp = f0.grp)",
        _split("c2", "r0"),
        """f1 as (select month <= cut as lower, avg(y) as mean from r0, c2 group by 1)""",
    ]
)
_BOOSTED_ROWS = """select event_id, month, round(f0.mean + 0.1 * f1.mean, 4) as prediction
from base join f0 on f0.grp = case when month <= (select cut from c0) then 1 else 2 end
 join f1 on f1.lower = (month <= (select cut from c2))
where not in_train"""

# -- scoring ----------------------------------------------------------------

_REFERENCE = f"""listed as (
 select replace(replace(replace(artists, '[', ''), ']', ''), '''', '') as artist, genre, subgenre,
  {_list_number('spotify_popularity')} as popularity, try_cast(event_day as date) as day
 from raw where artists is not null),
genres as (
 select artist, genre from (select *, row_number() over (partition by artist
   order by day nulls last, genre) as rn from listed where genre is not null) where rn = 1),
subgenres as (
 select artist, subgenre from (select *, row_number() over (partition by artist
   order by day nulls last, subgenre) as rn from listed where subgenre is not null) where rn = 1),
reference as (
 select p.artist, p.popularity, g.genre, s.subgenre
 from (select artist, max(popularity) as popularity from listed group by artist) p
  left join genres g on g.artist = p.artist left join subgenres s on s.artist = p.artist),
usual as (select coalesce(median(popularity), 50.0) as popularity from reference)"""

_VALID = """valid as (
 select * from requests
 where artist is not null and artist <> '' and city is not null and city <> ''
  and state is not null and state <> '')"""


def _dated(source: str) -> str:
    return f"""dated as (
 select * exclude (date), coalesce(try_strptime(date, '%Y-%m-%d')::date, date '{_AS_OF}') as day
 from {source})"""


def _known(source: str) -> str:
    return f"""known as (
 select q.* exclude (genre), cast(coalesce(r.popularity, (select popularity from usual)) as double)
  as spotify_popularity, r.genre as artist_genre, r.subgenre as artist_subgenre,
  coalesce(nullif(q.genre, ''), r.genre) as genre_key,
  case when q.genre <> '' then q.genre else r.subgenre end as subgenre_key
 from {source} q left join reference r on trim(q.artist) = r.artist)"""


_PAIRED = ", ".join(
    [
        _base(_MAX, "base_max"),
        _base(_MIN, "base_min"),
        _encoding(_MAX, "base_max", "_max"),
        _encoding(_MIN, "base_min", "_min"),
    ]
)


def _means() -> str:
    columns, joins = [], []
    for end in ("max", "min"):
        overall = f"(select mean from m_all_{end})"
        state = f"coalesce(st_{end}.mean, {overall})"
        genre = f"coalesce(ge_{end}.mean, {overall})"
        columns += [
            f"{state} as state_avg_{end}",
            f"coalesce(ci_{end}.mean, {state}) as city_avg_{end}",
            f"{genre} as genre_avg_{end}",
            f"coalesce(su_{end}.mean, {genre}) as subgenre_avg_{end}",
        ]
        joins += [
            f"left join m_state_{end} st_{end} on st_{end}.k = k.state",
            f"left join m_city_{end} ci_{end} on ci_{end}.k = k.city",
            f"left join m_genre_{end} ge_{end} on ge_{end}.k = k.genre_key",
            f"left join m_subgenre_{end} su_{end} on su_{end}.k = k.subgenre_key",
        ]
    return f"""featured as (
 select k.*, coalesce(genre_key, 'Unknown') as genre, {', '.join(columns)} from known k {' '.join(joins)})"""


FEATURED = ", ".join(
    [TABLE, REQUESTS, _PAIRED, _REFERENCE, _VALID, _dated("valid"), _known("dated"), _means()]
)

_PROBABILITY = """least(0.95, greatest(0.10, 0.40 + (spotify_popularity / 100.0 * 0.30
 + least(1.0, city_avg_max / (select mean from m_all_max)) * 0.15
 + case when dayofweek(day) in (5, 6, 0) then 0.10 else 0.0 end
 + case when month(day) in (6, 7, 8, 12) then 0.05 else 0.0 end)))"""

_PRICED = """priced as (
 select *, case when city_avg_max < city_avg_min then city_avg_min * 1.5 else city_avg_max end as high,
  city_avg_min as low from featured)"""


def _city_line(end: str) -> str:
    label = f"tm_{end}_price"
    return f"""line_{end} as (
 select regr_slope({label}, mean) as slope, regr_intercept({label}, mean) as base
 from base_{end} b join m_city_{end} m on b.city = m.k where in_train)"""


_LINES = ", ".join([_city_line("max"), _city_line("min")])


def _on_line(line: str, end: str) -> str:
    return f"(select slope from line_{line}) * city_avg_{end} + (select base from line_{line})"


_BANDED = f"""answers as (
 select request_id, round({_PROBABILITY}, 3) as probability, round(low, 2) as low,
  round(high, 2) as high from priced)"""


def _whole(value: str) -> str:
    return f"cast(cast(round({value}) as bigint) as varchar)"


_NAMES_SHOWN = [
    f"'Spotify Popularity: ' || {_whole('spotify_popularity')}",
    "'Year (' || cast(year(day) as varchar) || ')'",
    "'Month (' || cast(month(day) as varchar) || ')'",
    "'Weekday (' || strftime(day, '%a') || ')'",
    f"'State (' || state || '): $' || {_whole('state_avg_max')}",
    f"'City (' || city || '): $' || {_whole('city_avg_max')}",
    f"'Genre: $' || {_whole('genre_avg_max')}",
    f"'Subgenre: $' || {_whole('subgenre_avg_max')}",
]

# -- profile ----------------------------------------------------------------

_PROFILED = (
    "venue_lat", "venue_long", "tm_max_price", "tm_min_price", "price_range", "sg_avg_price",
    "sg_min_price", "sg_max_price", "sg_listing_count", "sg_artist_score", "sg_venue_score",
    "sh_max_price", "sh_min_price", "sh_total_postings", "sh_total_tickets", "spotify_followers",
    "spotify_popularity", "year", "month", "weekday",
)
_ALL = ("event_id", *_RANKED)

_WHOLE = {
    "sg_listing_count", "sh_total_postings", "sh_total_tickets", "spotify_followers",
    "spotify_popularity", "year", "month", "weekday",
}


def _type(c: str) -> str:
    if c in _WHOLE:
        return "int"
    if c in _ROUNDED:
        return "double"
    if c in _TIMES:
        return "timestamp"
    if c == "event_date":
        return "date"
    return "boolean" if c.startswith(("has_", "is_")) else "string"


def _numeric_profile(c: str) -> str:
    return f"""select '{c}' as column_name, count({c}) as count, round(avg({c}), 4) as mean,
 round(stddev_samp({c}), 4) as std, round(cast(min({c}) as double), 4) as min,
 round(quantile_cont(cast({c} as double), 0.25), 4) as q25,
 round(quantile_cont(cast({c} as double), 0.5), 4) as q50,
 round(quantile_cont(cast({c} as double), 0.75), 4) as q75,
 round(cast(max({c}) as double), 4) as max from kept"""


def _missing_profile(c: str) -> str:
    missing = f"count(*) filter (where {c} is null)"
    return f"""select '{c}' as column_name, {missing} as missing_count,
 round({missing} / count(*) * 100, 2) as missing_pct from typed having {missing} > 0"""


_TYPED_NUMBERS = (
    "event_id venue_lat venue_long tm_max_price tm_min_price sg_avg_price sg_min_price"
    " sg_max_price sg_artist_score sg_venue_score sh_max_price sh_min_price"
)
_TEST = _encoded()


def all_oracles() -> dict[str, str]:
    """SQL by query name; values are nudged before rounding as on the Spark side."""
    rounding = f", {DECIMALS})"
    return {k: v.replace(rounding, f" + {NUDGE}{rounding}") for k, v in _oracles().items()}


def _oracles() -> dict[str, str]:
    n = "count(*) as event_count"
    return {
        "csv_roundtrip": _rows(" ".join(_ALL), "typed"),
        "clean_partitioned_roundtrip": _rows(" ".join(_ALL), "kept", TABLE),
        "clean_incremental": _rows(" ".join(_ALL), "kept", TABLE),
        "report_order_roundtrip": _from_table(
            """select row_number() over (order by year nulls first, count(*) desc, genre nulls first) as position,
 year, genre, count(*) as event_count from kept group by year, genre"""
        ),
        # A CSV reader takes an empty text for a missing one.
        "parquet_to_csv": _from_table(
            "select "
            + ", ".join("nullif(artist, '') as artist" if c == "artist" else _show(c) for c in _ALL)
            + " from kept"
        ),
        "metrics_json_roundtrip": _learn(_MAX, _TEST) + _COMPARISON,
        "encoding_map_roundtrip": _learn(_MAX) + _MAP,
        "model_roundtrip": _learn(_MAX, _ONE)
        + "select event_id, round(my + slope * (spotify_popularity - mx), 4) as prediction"
        " from base, w where not in_train",
        "clean_artist": _rows("event_id artist", "typed"),
        "clean_artist_first": f"""with {CLEAN} select tm_id as event_id,
 case when artists is null then null
      else regexp_extract(artists, '^\\[''([^'']+)''', 1) end as artist from raw""",
        "clean_popularity": _rows("event_id spotify_popularity spotify_followers", "typed"),
        "clean_dates": _rows("event_id event_date", "typed"),
        "clean_timestamps": _rows("event_id presale_start presale_end sale_start", "typed"),
        "clean_numeric": _rows(_TYPED_NUMBERS, "typed"),
        "clean_counts": _rows(
            "event_id sg_listing_count sh_total_postings sh_total_tickets", "typed"
        ),
        "derive_price_range": _rows("event_id price_range", "typed"),
        "derive_flags": _rows("event_id has_spotify_data has_secondary_market", "typed"),
        "derive_calendar": _rows("event_id year month weekday is_weekend", "typed"),
        "clean_listing": _rows(" ".join(_ALL), "kept", TABLE),
        "filter_required": _rows(
            "event_id event_date artist venue",
            "typed where event_id is not null and event_date is not null and artist is not null",
        ),
        "dedup_events": _rows(
            " ".join(_ALL),
            "one_per_id",
            ", ".join([CLEAN, ONE_PER_ID]),
        ),
        "fill_missing": f"""with {CLEAN} select event_id,
 coalesce(spotify_popularity, 0) as spotify_popularity, coalesce(genre, 'Unknown') as genre,
 coalesce(subgenre, 'Unknown') as subgenre, coalesce(city, 'Unknown') as city,
 coalesce(state, 'Unknown') as state from typed""",
        "report_year_genre": _from_table(
            f"""select year, genre, {n}, round(avg(tm_min_price), 4) as avg_price,
 round(avg(spotify_popularity), 4) as avg_popularity from kept group by year, genre"""
        ),
        "report_top_cities": _from_table(
            f"""select city, state, {n}, count(distinct artist) as unique_artists,
 round(avg(tm_min_price), 4) as avg_price,
 count(*) filter (where has_secondary_market) as secondary_market_events
from kept group by city, state
order by event_count desc, city nulls first, state nulls first limit 50"""
        ),
        "report_top_artists": _from_table(
            f"""select artist, {n}, round(avg(spotify_popularity), 4) as avg_spotify_popularity,
 max(spotify_followers) as spotify_followers, round(avg(tm_min_price), 4) as avg_ticket_price,
 count(distinct city) as cities_performed
from kept where spotify_popularity is not null group by artist
order by avg(spotify_popularity) desc, artist limit 100"""
        ),
        "report_weekday": _from_table(
            f"""select weekday, dayname(min(event_date)) as weekday_name, is_weekend, {n},
 round(avg(tm_min_price), 4) as avg_price from kept group by weekday, is_weekend"""
        ),
        "report_secondary_market": _from_table(_RESALE := f"""select genre, {n},
 round(avg(sg_avg_price), 4) as avg_seatgeek_price, round(avg(sh_max_price), 4) as avg_stubhub_max,
 round(avg(tm_min_price), 4) as avg_tm_price,
 round(avg((sg_avg_price - tm_min_price) / nullif(tm_min_price, 0) * 100), 4) as avg_premium_pct
from kept where has_secondary_market group by genre"""),
        "report_csv_roundtrip": _from_table(_RESALE),
        "report_price_by_state": _from_table(
            f"""select state, {n}, round(min(tm_min_price), 4) as min_price,
 round(avg(tm_min_price), 4) as avg_price, round(max(tm_max_price), 4) as max_price,
 round(avg(price_range), 4) as avg_price_range
from kept where tm_min_price is not null group by state
order by avg(tm_min_price) desc, state nulls first limit 50"""
        ),
        "summary_overall": _from_table(
            """select count(*) as total_events, count(distinct artist) as unique_artists,
 count(distinct city) as unique_cities, count(distinct state) as unique_states,
 strftime(min(event_date), '%Y-%m-%d') as earliest_event,
 strftime(max(event_date), '%Y-%m-%d') as latest_event from kept"""
        ),
        "summary_genre_top10": _from_table(
            """select genre, count(*) as count from kept group by genre
order by count desc, genre nulls first limit 10"""
        ),
        "coverage": _from_table(
            """select count(*) as total, count(*) filter (where has_spotify_data) as with_spotify,
 round(count(*) filter (where has_spotify_data) / count(*) * 100, 4) as pct_spotify,
 count(*) filter (where has_secondary_market) as with_secondary,
 round(count(*) filter (where has_secondary_market) / count(*) * 100, 4) as pct_secondary
from kept"""
        ),
        "clean_stats": _from_table(
            """select count(*) as total_records, count(distinct artist) as unique_artists,
 count(distinct city) as unique_cities, round(avg(tm_min_price), 4) as avg_tm_price,
 round(avg(spotify_popularity), 4) as avg_spotify_popularity,
 count(*) filter (where has_secondary_market) as secondary_market_count from kept"""
        ),
        "quality_counts": _from_table(_COUNTS := """select count(*) as total, count(event_date) as valid_date,
 count(artist) as with_artist, count(*) filter (where has_spotify_data) as with_spotify,
 count(*) filter (where has_secondary_market) as with_secondary,
 (select count(*) from one_per_id) as after_dedup, (select count(*) from kept) as after_filter
from typed"""),
        "quality_counts_one_pass": _from_table(_COUNTS),
        "distinct_by_year_estimated": _from_table(
            """select year, count(*) as n_events, count(distinct artist) as exact_artist,
 count(distinct city) as exact_city, count(distinct state) as exact_state,
 true as artist_near, true as city_near, true as state_near from kept group by year"""
        ),
        "ml_base_max": _ml_base(_MAX),
        "ml_base_min": _ml_base(_MIN),
        "split_counts": _learn(_MAX)
        + "select case when in_train then 'train' else 'test' end as side, count(*) as n"
        " from base group by 1",
        "split_train": _learn(_MAX)
        + "select event_id, round(tm_max_price, 4) as tm_max_price from base where in_train",
        "encoding_map_max": _learn(_MAX) + _MAP,
        "encoding_map_min": _learn(_MIN) + _MAP,
        "encode_train": _learn(_MAX, _encoded(False))
        + f"select event_id, {_MEAN_COLUMNS} from train",
        "encode_train_leave_one_out": _learn(_MAX)
        + f" select event_id, {_LEFT_OUT} from base b "
        + " ".join(f"left join m_{d} on b.{d} = m_{d}.k" for d in _DIMS)
        + " where in_train",
        "encode_test": _learn(_MIN, _TEST) + f"select event_id, {_MEAN_COLUMNS} from test",
        "encode_joint_city": _learn(_MAX)
        + f""", joint as (select city, state, avg({_MAX}) as mean from base where in_train group by all)
select event_id, concat(b.city, ', ', b.state) as city_state,
 round(coalesce(j.mean, (select mean from m_all), 0), 4) as city_state_avg_price
from base b left join joint j on b.city = j.city and b.state = j.state where not b.in_train""",
        "stored_vector_sizes": _learn(_MAX)
        + """select case when in_train then 'train' else 'test' end as side, count(*) as n_rows,
 8 as vector_size, 8 as least_size from base group by 1""",
        "stored_vectors": _learn(_MAX, _TEST)
        + "select event_id, "
        + ", ".join(f"round({c}::double, 4) as {c}" for c in _MODEL_INPUTS)
        + " from test",
        "string_index": _learn(_MAX, _INDEX) + _INDEXED,
        "one_hot_counts": _learn(_MAX, _INDEX) + _ONE_HOT,
        "assemble_dense": _learn(_MAX, _TEST)
        + "select event_id, cast(spotify_popularity as double) as spotify_popularity,"
        " cast(year as double) as year, cast(month as double) as month,"
        f" cast(weekday as double) as weekday, {_MEAN_COLUMNS} from test",
        "assemble_skip": _from_table(
            """select event_id, cast(spotify_popularity as double) as spotify_popularity,
 round(tm_max_price, 4) as tm_max_price, cast(month as double) as month from kept
where spotify_popularity is not null and tm_max_price is not null"""
        ),
        "fit_linear": _learn(_MAX, _ONE, _TWO)
        + _slope_rows("one")
        + " union all select 'two', 'spotify_popularity', round(wp, 4) from k"
        " union all select 'two', 'month', round(wm, 4) from k"
        " union all select 'two', 'intercept', round(ay - wp * ap - wm * am, 4) from k",
        "fit_lasso": _learn(_MAX, _penalised(0.1, 1.0)) + _slope_rows("lasso"),
        "fit_elastic_net": _learn(_MAX, _penalised(0.1, 0.7)) + _slope_rows("elastic_net"),
        "fit_decision_tree": _learn(_MAX, _TREE) + _TREE_ROWS,
        "forest_without_bootstrap": _learn(_MAX, _TREE) + _TREE_ROWS,
        "fit_gbt": _learn(_MAX, _BOOSTED) + _BOOSTED_ROWS,
        "baseline_eval": _learn(_MAX, _TEST)
        + f"select {_errors('city_avg_price')}, count(*) as n from test",
        "baseline_comparison": _learn(_MAX, _TEST) + _COMPARISON,
        "best_model": _learn(_MAX, _TEST, f"compared as ({_COMPARISON})")
        + "select * from compared order by rmse, model limit 1",
        "metrics_long": _learn(
            _MAX, _TEST, f"errors as (select {_errors('city_avg_price')}, count(*) as n from test)"
        )
        + "select 'RMSE' as metric, rmse as value from errors"
        " union all select 'MAE', mae from errors union all select 'R2', r2 from errors"
        " union all select 'train_size', cast(n as double) from m_all"
        " union all select 'test_size', cast(n as double) from errors",
        "prediction_table": _learn(_MAX, _TEST)
        + "select event_id, artist, genre, strftime(event_date, '%Y-%m-%d') as event_date,"
        " round(tm_max_price, 4) as tm_max_price, round(city_avg_price, 4) as prediction,"
        " spotify_popularity from test",
        "prediction_sample": _learn(_MIN, _TEST)
        + "select event_id, artist, genre, round(tm_min_price, 4) as actual_price,"
        " round(city_avg_price, 4) as predicted_price,"
        " round(abs(tm_min_price - city_avg_price), 4) as error from test order by event_id limit 100",
        "artist_reference": f"with {RAW}, {_REFERENCE} select * from reference",
        "default_popularity": f"with {RAW}, {_REFERENCE} select popularity as default_popularity from usual",
        "score_validate": f"""with {REQUESTS} select request_id, nullif(concat_ws(', ',
 case when artist is null or artist = '' then 'artist' end,
 case when city is null or city = '' then 'city' end,
 case when state is null or state = '' then 'state' end), '') as missing from requests""",
        "score_calendar": f"with {REQUESTS}, {_dated('requests')}"
        " select request_id, strftime(day, '%Y-%m-%d') as event_date,"
        " cast(year(day) as integer) as year, cast(month(day) as integer) as month,"
        " cast(dayofweek(day) + 1 as integer) as weekday, strftime(day, '%a') as weekday_name"
        " from dated",
        "score_artist_lookup": f"with {RAW}, {REQUESTS}, {_REFERENCE}, {_known('requests')}"
        " select request_id, spotify_popularity, artist_genre, artist_subgenre from known",
        "score_genre": f"with {RAW}, {REQUESTS}, {_REFERENCE}, {_known('requests')}"
        " select request_id, coalesce(genre_key, 'Unknown') as genre,"
        " coalesce(subgenre_key, 'Unknown') as subgenre from known",
        "score_features": f"with {FEATURED} select request_id, spotify_popularity, "
        + ", ".join(
            f"round({d}_avg_{e}, 4) as {d}_avg_{e}" for d in _DIMS for e in ("max", "min")
        )
        + " from featured",
        "score_dual": f"with {FEATURED}, {_LINES} select request_id,"
        f" round({_on_line('max', 'max')}, 4) as pred_max,"
        f" round({_on_line('min', 'min')}, 4) as pred_min from featured",
        "score_repair": f"""with {FEATURED}, {_LINES}, swapped as (select request_id,
 {_on_line('min', 'max')} as high, {_on_line('max', 'min')} as low from featured)
select request_id, round(case when high < low then low * 1.5 else high end, 4) as pred_max,
 round(low, 4) as pred_min from swapped""",
        "score_probability": f"with {FEATURED} select request_id,"
        f" round({_PROBABILITY}, 4) as probability from featured",
        "score_output": f"with {FEATURED}, {_PRICED} select request_id,"
        f" round({_PROBABILITY}, 3) as probability, round(low, 2) as pred_min,"
        " round(high, 2) as pred_max,"
        " 'Day: ' || strftime(day, '%a') || ', Genre: ' || genre as note from priced",
        "score_band": f"""with {FEATURED}, {_PRICED}, {_BANDED} select request_id,
 case when probability >= 0.65 then 'high' when probability >= 0.40 then 'medium' else 'low' end as band,
 round(greatest(0, high - low), 4) as spread from answers""",
        "score_explain": f"with {FEATURED} select name, count(*) as count from ("
        + " union all ".join(f"select {v} as name from featured" for v in _NAMES_SHOWN)
        + ") group by name",
        "linear_optimality": _zeros(
            ("model", ("linear_regression", "lasso_regression", "elastic_net")),
            ("term", ("intercept", *_MODEL_INPUTS)),
            "breach",
        ),
        "compare_models_check": " union all ".join(
            f"select '{m}' as model, 0.0::double as rmse_off, 0.0::double as mae_off, 0.0::double as r2_off"
            for m in ("linear_regression", "lasso_regression", "elastic_net", "decision_tree", "gbt")
        ),
        "string_index_models": _learn(_MAX, _TEST)
        + " union all ".join(f"select '{d}' as dim, 0::bigint as n_off, (select count(*) from test) as n_rows" for d in _DIMS),
        "tree_predictions_check": _learn(_MAX, _TEST)
        + " union all ".join(
            f"select '{m}' as model, (select count(*) from test) as n_rows, 0.0::double as prediction_off"
            for m in ("decision_tree", "gbt", "random_forest")
        ),
        "tree_leaves_check": _learn(_MAX, _TEST)
        + "select n as n_rows, 0::bigint as rows_off, 0.0::double as mean_off from m_all",
        "tree_importance_check": " union all ".join(
            f"select '{m}' as model, '{f}' as feature, 0.0::double as importance_off"
            for m in ("decision_tree", "gbt", "random_forest")
            for f in _MODEL_INPUTS
        ),
        "one_hot_tree_check": "select 'one_hot' as model, 0.0::double as prediction_off, 0.0::double as importance_off",
        "feature_importance_facts": " union all ".join(
            f"select '{f}' as feature, 0.0::double as importance" for f in _MODEL_INPUTS
        )
        + " union all select '(sum)', 1.0",
        "one_hot_importance_facts": _learn(_MAX, _INDEX)
        + " union all ".join(
            [f"select '{f}' as feature, 0.0::double as importance" for f in _MODEL_INPUTS[:4]]
            + [f"select '{d}_vec_' || label, 0.0 from i_{d}" for d in _DIMS]
            + ["select '(sum)', 1.0"]
        ),
        "score_explain_top": f"with {FEATURED} select place, name, score, count(*) as count from ("
        + " union all ".join(
            f"select {place} as place, {_NAMES_SHOWN[i]} as name, {share}::double as score from featured"
            for place, (i, share) in enumerate(
                [(0, 0.3), (5, 0.25), (6, 0.1), (2, 0.1), (3, 0.1), (4, 0.05)]
            )
        )
        + ") group by all",
        "score_rejected": f"""with {REQUESTS} select request_id, concat_ws(', ',
 case when artist is null or artist = '' then 'artist' end,
 case when city is null or city = '' then 'city' end,
 case when state is null or state = '' then 'state' end) as missing from requests
where coalesce(artist, '') = '' or coalesce(city, '') = '' or coalesce(state, '') = ''""",
        "score_accounted": f"""with {REQUESTS}
select case when coalesce(artist, '') = '' or coalesce(city, '') = '' or coalesce(state, '') = ''
  then 'rejected' else 'answered' end as side,
 count(*) as n, count(distinct request_id) as ids from requests group by 1""",
        "model_summary": f"""with {TABLE}, {_PAIRED}, {_REFERENCE} select
 (select count(*) from reference) as total_artists, (select count(*) from m_city_max) as total_cities,
 round((select mean from m_all_min), 2) as global_avg_min,
 round((select mean from m_all_max), 2) as global_avg_max,
 round((select popularity from usual), 2) as default_popularity""",
        "profile_shape": f"with {TABLE} "
        + " union all ".join(
            f"select '{c}' as column_name, '{_type(c)}' as data_type, count(*) as n_rows,"
            f" {len(_ALL)} as n_columns from kept"
            for c in _ALL
        ),
        "profile_head": _rows(
            "event_id artist event_date city tm_max_price",
            "kept order by event_id limit 10",
            TABLE,
        ),
        "profile_numeric": f"with {TABLE} " + " union all ".join(map(_numeric_profile, _PROFILED)),
        "profile_missing": f"with {CLEAN} " + " union all ".join(map(_missing_profile, _ALL)),
        "plot_trim": _learn(_MAX, _TEST)
        + "select event_id, round(tm_max_price, 4) as tm_max_price,"
        " round(city_avg_price, 4) as prediction from test"
        " where tm_max_price <= 35000 and city_avg_price <= 35000",
        "plot_pairs": _learn(_MAX, _TEST)
        + "select round(tm_max_price, 4) as actual, round(city_avg_price, 4) as predicted from test",
        "plot_limits": _learn(_MAX, _TEST)
        + "select round(min(tm_max_price), 4) as low, round(max(tm_max_price), 4) as high from test",
    }


def _ml_base(label: str) -> str:
    return (
        "with "
        + ", ".join([TABLE, _base(label)])
        + " select event_id, artist, strftime(event_date, '%Y-%m-%d') as event_date,"
        " spotify_popularity, year, month, weekday, state, city, genre, subgenre,"
        f" round({label}, 4) as {label} from base"
    )
