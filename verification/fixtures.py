"""Trip-shaped views over the provided tables, in the SQL dialect both engines share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "supplier", "orders", "lineitem", "events", "documents")

RAW_TRIPS = """
with base as (
  select l_orderkey as trip_key,
    o_orderdate + ((l_orderkey % 24) * 60 + l_partkey % 60) * interval '1' minute as tpep_pickup_datetime,
    o_orderdate + ((l_orderkey % 24) * 60 + l_partkey % 60 + (l_suppkey * 37 + l_partkey) % 1500 - 20) * interval '1' minute as tpep_dropoff_datetime,
    cast(case when l_linenumber = 1 then null when l_orderkey % 89 = 0 then 12 else l_linenumber end as bigint) as passenger_count,
    case when l_orderkey % 211 = 0 then null when l_orderkey % 67 = 0 then -l_quantity when l_orderkey % 101 = 0 then l_quantity * 10 else l_quantity end as trip_distance,
    cast(l_partkey % 267 as bigint) as PULocationID,
    cast((l_suppkey * 13 + l_partkey) % 267 as bigint) as DOLocationID,
    cast(case when l_orderkey % 53 = 0 then 9 else l_linenumber - 1 end as bigint) as payment_type,
    case when l_orderkey % 71 = 0 then -l_extendedprice else l_extendedprice end as fare_amount,
    case when l_orderkey % 73 = 0 then -l_discount - 1 else l_discount + 0.0 end as tip_amount
  from lineitem join orders on l_orderkey = o_orderkey
)
select * from base union all select * from base where trip_key % 97 = 0
"""

RIDES = """
select event_id as trip_key, ts as pickup_datetime,
  ts + cast(floor(value * 6) as int) * interval '1' second as dropoff_datetime,
  cast(event_id % 6 as bigint) as passenger_count, value / 10 as trip_distance,
  user_id % 265 + 1 as pickup_location_id,
  cast(regexp_extract(props, '[0-9]+', 0) as bigint) + 1 as dropoff_location_id,
  event_id % 8 as payment_type, value as fare_amount, value * 0.125 as tip_amount
from events where event_type <> 'view'
"""

HOURLY_WEATHER = """
select date_trunc('hour', ts) as weather_hour, max(value) as temperature, min(value) as precipitation,
  max(value) as wind_speed, max(cast(regexp_extract(props, '[0-9]+', 0) as bigint)) as weather_code
from events where event_type = 'view' group by date_trunc('hour', ts)
"""

ZONES = """
select s_suppkey as location_id, r_name as borough, s_name as zone, n_name as service_zone
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""

RUNS = """
select cast(o_orderkey as string) as run_id, 'trips' as pipeline_name,
  substr(cast(o_orderdate as string), 1, 7) as partition_date,
  case o_orderstatus when 'F' then 'failed' when 'O' then 'success' else 'running' end as status,
  o_orderdate + (o_orderkey % 1440) * interval '1' minute as started_at,
  case when o_orderstatus = 'P' then null else o_orderdate + ((o_orderkey % 1440) * 60 + o_custkey % 7200) * interval '1' second end as completed_at,
  case when o_orderstatus = 'O' then cast(floor(o_totalprice) as bigint) end as input_rows,
  case when o_orderstatus = 'O' then cast(floor(o_totalprice * 0.5) as bigint) end as output_rows,
  case when o_orderstatus = 'F' then 'boom' end as error_message
from orders
"""

# Runs without any July, for what looks for gaps.
GAP_RUNS = f"""{RUNS.rstrip()} where substr(cast(o_orderdate as string), 6, 2) <> '07'
"""

MANIFEST_LOG = """
select o_orderkey as row_id, o_orderpriority as source_name, substr(cast(o_orderdate as string), 1, 7) as partition_date,
  o_orderdate + (o_orderkey % 1440) * interval '1' minute as downloaded_at,
  o_custkey as file_size, o_orderkey % 10000 as row_count,
  case when o_orderkey % 10 = 0 then 'failed' else 'success' end as status
from orders
"""

VIEWS = {
    "raw_trips": RAW_TRIPS,
    "rides": RIDES,
    "hourly_weather": HOURLY_WEATHER,
    "zones": ZONES,
    "runs": RUNS,
    "gap_runs": GAP_RUNS,
    "manifest_log": MANIFEST_LOG,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view; the tables it names are bound to ``sf_dir`` for this statement only."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if t in VIEWS[name]}
    text = VIEWS[name]
    for t in used:
        text = _bind(text, t)
    return spark.sql(text, **used)


def _bind(text: str, name: str) -> str:
    import re

    return re.sub(rf"\b(from|join) {name}\b", rf"\1 {{{name}}} {name}", text)
