"""Listing-like tables made from the driver's order tables.

The SQL texts run unchanged in Spark and DuckDB, so both sides of a check start
from the same rows. They supply what the order tables lack: lists as text,
nulls, unreadable dates and numbers, categories seen only on one side of the
split, and requests with gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagefare.columns import RAW_COLUMNS
from stagefare.functions.joins import measure
from stagefare.plans.cleaning import write_cleaned
from stagefare.sources.listings import read_clean
from stagefare.sources.scratch import exists, new_path

# Doubles are compared after rounding. Prices are whole cents, so many means lie
# half-way between two rounded values, where the order of summing would decide;
# the nudge moves the half-way points to where no such mean lies.
DECIMALS = 4
NUDGE = 1.37e-6

TABLES = ("lineitem", "part", "supplier", "nation", "region")

# Columns stand in the order of RAW_COLUMNS, under SQL-friendly names.
RAW_SQL = """
select
 case when l_partkey % 97 = 0 and l_linenumber = 1 then null
      else concat(cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20))) end as tm_id,
 concat(p_name, ' tour') as event_title,
 case when l_partkey % 11 = 0 then null
      when l_partkey % 7 = 0 then concat('[''', p_name, ''', ''', p_brand, ''']')
      when l_partkey % 53 = 0 then '[]'
      else concat('[''', p_name, ''']') end as artists,
 case when l_partkey % 13 = 0 then 'TBA'
      else cast(cast(l_shipdate as date) as varchar(20)) end as event_day,
 concat('Hall ', cast(l_suppkey as varchar(20))) as venue,
 case when l_suppkey % 17 = 0 then null
      when l_orderkey % 499 = 0 then concat('Town ', cast(l_orderkey as varchar(20)))
      else n_name end as venue_city,
 case when l_suppkey % 43 = 0 then null else r_name end as venue_state,
 case when l_suppkey % 19 = 0 then 'unknown' else cast(s_acctbal as varchar(30)) end as venue_lat,
 concat('-', cast(s_acctbal as varchar(30))) as venue_long,
 case when l_partkey % 23 = 0 then null else p_type end as genre,
 case when l_partkey % 31 = 0 then null else p_brand end as subgenre,
 case when l_linestatus = 'F' then 'concert' else 'festival' end as event_type,
 case when l_linenumber = 7 then null
      when l_partkey % 29 = 0 then 'N/A'
      else cast(l_extendedprice as varchar(30)) end as tm_max,
 case when l_linenumber = 7 then null
      when l_quantity = 1 then '0.0'
      else cast(l_extendedprice * (1 - l_discount) as varchar(30)) end as tm_min,
 case when l_returnflag = 'N' then null
      else cast(l_extendedprice * (1 + l_tax) as varchar(30)) end as sg_average_price,
 case when l_returnflag = 'N' then null
      else cast(l_extendedprice as varchar(30)) end as sg_min_price,
 case when l_returnflag = 'N' then null
      else cast(l_extendedprice * 1.5 as varchar(30)) end as sg_max_price,
 case when l_returnflag = 'N' then null
      when l_returnflag = 'A' then '0'
      when l_partkey % 37 = 0 then 'many'
      when l_partkey % 41 = 0 then '1e3'
      when l_partkey % 43 = 0 then '70d'
      when l_partkey % 47 = 0 then '0x1p3'
      when l_partkey % 53 = 0 then '+5'
      when l_partkey % 59 = 0 then ' 70'
      when l_partkey % 61 = 0 then '7.9'
      else cast(l_quantity as varchar(20)) end as sg_listing_count,
 cast(l_discount as varchar(20)) as sg_artists_score,
 cast(l_tax as varchar(20)) as sg_venue_score,
 case when l_linestatus = 'F' then null
      else cast(l_extendedprice * 2 as varchar(30)) end as sh_max_price,
 case when l_linestatus = 'F' then null
      else cast(l_extendedprice / 2 as varchar(30)) end as sh_min_price,
 case when l_linestatus = 'F' then null
      else cast(l_linenumber - 1 as varchar(20)) end as sh_total_postings,
 case when l_linestatus = 'F' then null
      else cast(l_quantity * 2 as varchar(20)) end as sh_total_tickets,
 case when l_partkey % 5 = 0 then '[''NaN'']'
      when l_partkey % 47 = 0 then concat('[''', cast(l_partkey as varchar(20)), ''']')
      else concat('[', cast(l_partkey * 1000 + p_size as varchar(20)), ']') end as spotify_followers,
 case when l_partkey % 5 = 0 then '[''NaN'']'
      when l_partkey % 59 = 0 then '[]'
      when l_partkey % 3 = 0 then concat('[''NaN'', ', cast(p_size as varchar(20)), ', 7]')
      else concat('[', cast(p_size as varchar(20)), ']') end as spotify_popularity,
 case when l_partkey % 9 = 0 then 'soon'
      else concat(cast(cast(l_shipdate as date) as varchar(20)), ' 10:00:00') end as presale_date_start,
 concat(cast(cast(l_shipdate as date) as varchar(20)), ' 22:30:00') as presale_date_end,
 case when l_linenumber = 2 then null
      else concat(cast(cast(l_shipdate as date) as varchar(20)), 'T09:15:00') end as tm_sale_date_start,
 concat('Promoter ', cast(l_suppkey as varchar(20))) as promoter,
 case when l_quantity > 40 then 'true' else 'false' end as span_multiple_days
from {lineitem} join {part} on l_partkey = p_partkey join {supplier} on l_suppkey = s_suppkey
 join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
"""

REQUEST_SQL = """
select
 concat(cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20)), '-',
        cast(l_partkey as varchar(20))) as request_id,
 case when l_quantity = 50 then ''
      when l_partkey % 61 = 0 then concat('New act ', cast(l_partkey as varchar(20)))
      else concat(' ', p_name, ' ') end as artist,
 case when l_suppkey % 31 = 0 then null
      when l_suppkey % 17 = 0 then concat('Elsewhere ', cast(l_suppkey as varchar(20)))
      else n_name end as city,
 case when l_suppkey % 11 = 0 then 'ATLANTIS' else r_name end as state,
 case when l_partkey % 6 = 0 then null
      when l_partkey % 13 = 0 then 'tomorrow'
      else cast(cast(l_shipdate as date) as varchar(20)) end as date,
 case when l_linenumber % 2 = 0 then null
      when l_linenumber = 5 then ''
      when l_partkey % 41 = 0 then 'Polka'
      else p_type end as genre
from {lineitem} join {part} on l_partkey = p_partkey join {supplier} on l_suppkey = s_suppkey
 join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
"""


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables that the texts read; suppliers are broadcast if what is read of them is measured to be small.

    Else the rows of the join with parts, wide by then, are shuffled and sorted once more.
    """
    found = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    read = measure(found["supplier"].select("s_suppkey", "s_nationkey", "s_acctbal"), "s_suppkey")
    if read.fits():
        found["supplier"] = F.broadcast(found["supplier"])
    return found


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw listing table with the headers of a listing file."""
    return spark.sql(RAW_SQL, **tables(spark, sf_dir)).toDF(*RAW_COLUMNS)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price request per order line."""
    return spark.sql(REQUEST_SQL, **tables(spark, sf_dir))


_written: dict[tuple[str, str], str] = {}


def cleaned_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table of a scale, written once per application and then read.

    Reports and training start from the written table, as in production.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    path = _written.get(key)
    if path is None or not exists(spark, path):
        path = new_path(spark, "cleaned")
        write_cleaned(raw_listings(spark, sf_dir), path)
        _written[key] = path
    return read_clean(spark, path)
