"""SQL twins of the registered queries for an independent engine.

They state the expected rows from the fixture views alone: duplicates by ranking copies,
labels by CASE, latest rows by QUALIFY, plain sums and averages rounded at the end. Nothing of
the library's constants is used.
"""

from __future__ import annotations

from verification import fixtures, queries as q

ORACLES: dict[str, str] = {}

# Payment codes, WMO weather codes and the public feeds.
PAYMENT_LABELS = {
    0: "not_recorded",
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided_trip",
}
WEATHER_LABELS = {
    0: "clear",
    1: "mainly_clear",
    2: "partly_cloudy",
    3: "overcast",
    45: "fog",
    48: "rime_fog",
    51: "light_drizzle",
    53: "drizzle",
    55: "heavy_drizzle",
    56: "freezing_drizzle",
    57: "heavy_freezing_drizzle",
    61: "light_rain",
    63: "rain",
    65: "heavy_rain",
    66: "freezing_rain",
    67: "heavy_freezing_rain",
    71: "light_snow",
    73: "snow",
    75: "heavy_snow",
    77: "snow_grains",
    80: "light_rain_showers",
    81: "rain_showers",
    82: "heavy_rain_showers",
    85: "snow_showers",
    86: "heavy_snow_showers",
    95: "thunderstorm",
    96: "thunderstorm_hail",
    99: "thunderstorm_heavy_hail",
}
TRIPS_URL = "https://d37ci6vzurychx.cloudfront.net/trip-data/yellow_tripdata_%s.parquet"
ZONES_URL = "https://d37ci6vzurychx.cloudfront.net/misc/taxi+_zone_lookup.csv"
WEATHER_URL = "https://archive-api.open-meteo.com/v1/archive"
WEATHER_PLACE = "latitude=40.7143&longitude=-74.006"
WEATHER_HOURLY = "hourly=temperature_2m%2Cprecipitation%2Cwind_speed_10m%2Cweather_code&timezone=America%2FNew_York"

TRIP_COLUMNS = (
    "trip_key, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, "
    "pickup_location_id, dropoff_location_id, payment_type, fare_amount, tip_amount"
)
CRITICAL = (
    "pickup_datetime, dropoff_datetime, trip_distance, pickup_location_id, dropoff_location_id, "
    "payment_type, fare_amount, tip_amount"
)
RULES = {
    "dropoff_before_pickup": "dropoff_datetime < pickup_datetime",
    "negative_distance": "trip_distance < 0",
    "negative_fare": "fare_amount < 0",
    "negative_tip": "tip_amount < 0",
    "invalid_passenger_count": "passenger_count < 0 or passenger_count > 9",
    "invalid_pickup_location": "pickup_location_id < 1 or pickup_location_id > 265",
    "invalid_dropoff_location": "dropoff_location_id < 1 or dropoff_location_id > 265",
    "invalid_payment_type": "payment_type not in (0, 1, 2, 3, 4, 5, 6)",
}


def case(code: str, labels: dict[int, str]) -> str:
    arms = " ".join(f"when {k} then '{v}'" for k, v in labels.items())
    return f"case {code} {arms} else 'unknown' end"


def total(x: str) -> str:
    return f"sum({x})"


def mean(x: str) -> str:
    return f"avg({x})"


def nulls(columns: str) -> str:
    return " or ".join(f"{c} is null" for c in columns.split(", "))


def reasons() -> str:
    arms = ", ".join(f"case when {r} then '{r}' end" for r in RULES)
    return f"concat_ws(', ', {arms})"


def view(name: str, alias: str | None = None) -> str:
    return f"{alias or name} as ({fixtures.VIEWS[name]})"


def classified(prefix: str, source: str) -> list[str]:
    """CTEs <prefix>_flags and <prefix>_classed over canonical rows ``source``."""
    rules = ", ".join(f"coalesce({sql}, false) as {name}" for name, sql in RULES.items())
    return [
        f"""{prefix}_flags as (
  select *, {rules}, ({nulls(CRITICAL)}) as is_null, ({nulls(TRIP_COLUMNS)}) as has_null,
    coalesce(trip_distance > 200 or date_sub('second', pickup_datetime, dropoff_datetime) > 86400,
      false) as is_outlier,
    row_number() over (partition by {TRIP_COLUMNS}) as copy_no
  from {source})""",
        f"""{prefix}_classed as (
  select *, not is_null and not is_invalid as clean,
    not is_null and not is_invalid and not has_null and copy_no > 1 as is_duplicate
  from (select *, ({' or '.join(RULES)}) as is_invalid from {prefix}_flags) f)""",
        f"""{prefix}_valid as (
  select {TRIP_COLUMNS} from {prefix}_classed where clean and not is_duplicate and not is_outlier)""",
    ]


def derived(name: str, source: str) -> str:
    return f"""{name} as (
  select trip_key, pickup_datetime, dropoff_datetime,
    cast(pickup_datetime as date) as pickup_date,
    cast(hour(pickup_datetime) as int) as pickup_hour,
    cast(isodow(pickup_datetime) - 1 as int) as pickup_day_of_week,
    pickup_location_id, dropoff_location_id, coalesce(passenger_count, 0) as passenger_count,
    trip_distance, date_sub('second', pickup_datetime, dropoff_datetime) as trip_duration_seconds,
    case when date_sub('second', pickup_datetime, dropoff_datetime) > 0 then trip_distance /
      (cast(date_sub('second', pickup_datetime, dropoff_datetime) as double) / 3600e0) end
      as average_speed,
    fare_amount, tip_amount, coalesce(fare_amount, 0) + coalesce(tip_amount, 0) as total_charge,
    {case('payment_type', PAYMENT_LABELS)} as payment_type,
    pickup_location_id in (1, 132, 138) or dropoff_location_id in (1, 132, 138) as is_airport_trip
  from {source})"""


RAW = [view("raw_trips")]
TRIPS = RAW + [
    """trips as (
  select trip_key, tpep_pickup_datetime as pickup_datetime,
    tpep_dropoff_datetime as dropoff_datetime, passenger_count, trip_distance,
    PULocationID as pickup_location_id, DOLocationID as dropoff_location_id, payment_type,
    fare_amount, tip_amount
  from raw_trips)"""
]
CLASSED = TRIPS + classified("t", "trips")
NORMAL = CLASSED + [derived("normal", "t_valid")]
RIDES = [view("rides")]
WEATHER = [
    view("hourly_weather"),
    f"""weather as (
  select weather_hour, temperature, precipitation, wind_speed,
    {case('weather_code', WEATHER_LABELS)} as weather_condition
  from hourly_weather)""",
]
CURATED = (
    RIDES
    + classified("r", "rides")
    + [derived("ride_normal", "r_valid")]
    + WEATHER
    + [
        """curated as (
  select n.*, temperature, precipitation, wind_speed, weather_condition,
    temperature is not null as weather_joined
  from ride_normal n left join weather on date_trunc('hour', pickup_datetime) = weather_hour)"""
    ]
)
ZONES = [view("zones")]
STG = CURATED + [
    """stg as (
  select pickup_datetime, dropoff_datetime, pickup_date, pickup_hour, pickup_day_of_week,
    cast(pickup_location_id as int) as pickup_location_id,
    cast(dropoff_location_id as int) as dropoff_location_id,
    cast(passenger_count as int) as passenger_count, trip_distance,
    cast(trip_duration_seconds as double) as trip_duration_seconds, average_speed, fare_amount,
    tip_amount, total_charge, payment_type, is_airport_trip, temperature, precipitation,
    wind_speed, weather_condition, weather_joined
  from curated)"""
]
FACT = (
    STG
    + ZONES
    + [
        """fact as (
  select s.*, p.zone as pickup_zone, p.borough as pickup_borough, o.zone as dropoff_zone,
    o.borough as dropoff_borough
  from stg s left join zones p on pickup_location_id = p.location_id
    left join zones o on dropoff_location_id = o.location_id)"""
    ]
)


def daily(name: str, source: str) -> str:
    return f"""{name} as (
  select pickup_date as date, pickup_location_id, count(*) as trip_count,
    {mean('trip_duration_seconds')} as average_trip_duration,
    {total('trip_distance')} as total_distance, {total('total_charge')} as total_revenue,
    {mean('fare_amount')} as average_fare
  from {source} group by all)"""


def hourly(name: str, source: str) -> str:
    return f"""{name} as (
  select pickup_date as date, pickup_hour as hour, count(*) as trip_count,
    {mean('trip_duration_seconds')} as average_trip_duration,
    {mean('fare_amount')} as average_fare
  from {source} group by all)"""


def route(name: str, source: str) -> str:
    return f"""{name} as (
  select pickup_location_id, dropoff_location_id, count(*) as trip_count,
    {mean('trip_distance')} as average_distance,
    {mean('trip_duration_seconds')} as average_duration,
    {total('total_charge')} as total_revenue, {mean('tip_amount')} as average_tip
  from {source} group by all)"""


def impact(name: str, source: str) -> str:
    return f"""{name} as (
  select pickup_date as date, weather_condition, precipitation, count(*) as trip_count,
    {mean('trip_duration_seconds')} as average_duration, {mean('fare_amount')} as average_fare
  from {source} group by all)"""


DAILY = NORMAL + [daily("daily", "normal")]
HOURLY = NORMAL + [hourly("hourly", "normal")]
ROUTE = NORMAL + [route("route", "normal")]
IMPACT = CURATED + [impact("impact", "curated")]
RUNS = [view("runs")]
MANIFEST = [
    view("manifest_log"),
    """manifest as (
  select * from manifest_log
  qualify row_number() over (partition by source_name, partition_date
    order by downloaded_at desc, row_id desc) = 1)""",
]
LATEST = [
    """latest as (
  select * from runs qualify row_number() over (partition by pipeline_name, partition_date
    order by started_at desc, run_id desc) = 1)"""
]
GAP_RUNS = [view("gap_runs", "runs")]
LATEST_RUNS, LATEST_GAP_RUNS = RUNS + LATEST, GAP_RUNS + LATEST
MONTHS = [
    """months as (
  select cast(unnest(generate_series(date_trunc('month', min(o_orderdate)),
    date_trunc('month', max(o_orderdate)), interval 1 month)) as date) as month_start
  from orders)""",
    """calendar as (
  select month_start, last_day(month_start) as month_end,
    strftime(month_start, '%Y-%m') as partition_date from months)""",
]


def oracle(key: str, ctes: list[str], body: str) -> None:
    sql = f"with {', '.join(ctes)} {body}" if ctes else body
    shown = [f"cast({c} as double) as {c}" for c in q.NULLABLE_INTEGERS.get(key, ())]
    shown += [f"round({c} + 1.23e-5, 4) as {c}" for c in q.ROUNDED.get(key, ())]
    if shown:
        sql = f"select * replace ({', '.join(shown)}) from ({sql}) result"
    ORACLES[key] = sql


def text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


DATE = f"replace ({text('date')} as date)"
PICKUP_DATE = f"replace ({text('pickup_date')} as pickup_date)"
IN_DEMAND = f"date between date '{q.DEMAND_START}' and date '{q.DEMAND_END}'"

# Sources
oracle(
    "scan_month",
    TRIPS,
    """select strftime(pickup_datetime, '%Y-%m') as partition_date, count(*) as trips,
  min(pickup_datetime) as first_pickup, max(pickup_datetime) as last_pickup
from trips group by 1""",
)
oracle(
    "scan_date_range",
    NORMAL,
    f"""select trip_key, pickup_datetime, {text('pickup_date')} as pickup_date, trip_distance
from normal where pickup_date between date '{q.STAGED_START}' and date '{q.STAGED_END}'""",
)
oracle(
    "union_relaxed",
    TRIPS + RIDES,
    f"""select * replace (cast(passenger_count as double) as passenger_count)
from (select {TRIP_COLUMNS} from trips union all select {TRIP_COLUMNS} from rides) u""",
)
oracle(
    "union_by_name",
    TRIPS + RIDES,
    f"""select {TRIP_COLUMNS}, cast(null as double) as airport_fee from trips
union all select {TRIP_COLUMNS}, fare_amount * 0.5e0 from rides""",
)
oracle("weather_parse", WEATHER, "select * from weather")
oracle("dim_zones", ZONES, "select * from zones")
oracle(
    "checksum_text",
    [],
    "select doc_id, sha256(text) as checksum, cast(strlen(text) as bigint) as bytes from documents",
)
oracle(
    "landed_months",
    RIDES,
    """select strftime(pickup_datetime, '%Y-%m') as partition_date, count(*) as trips,
  min(pickup_datetime) as first_pickup, max(pickup_datetime) as last_pickup
from rides group by 1""",
)
oracle(
    "staged_dates",
    RIDES,
    f"""select trip_key, pickup_datetime, strftime(pickup_datetime, '%Y-%m-%d') as pickup_date, trip_distance
from rides where cast(pickup_datetime as date) between date '{q.WEATHER_START}' and date '{q.WEATHER_END}'""",
)
oracle(
    "file_checksums",
    [],
    """select strftime(o_orderdate, '%Y-%m') as partition_date,
  sha256(string_agg(o_orderkey || chr(10), '' order by o_orderkey)) as checksum,
  cast(sum(strlen(o_orderkey || chr(10))) as bigint) as file_size
from orders group by 1""",
)
oracle(
    "file_rows",
    [],
    """select 'region' as file, count(*) as rows_found from region
union all select 'nation', count(*) from nation
union all select 'orders', count(*) from orders
union all select 'lineitem', count(*) from lineitem""",
)
oracle("list_files", [], "select 'events' as file, true as filled union all select 'orders', true")
oracle(
    "read_relaxed",
    [],
    "select strftime(o_orderdate, '%Y-%m') as partition_date, count(*) as orders from orders group by 1",
)
oracle(
    "publish_pending",
    LATEST_RUNS + MANIFEST,
    """select partition_date, run_id from latest where status = 'success' and pipeline_name = 'trips'
  and not exists (select 1 from manifest m where m.source_name = '1-URGENT'
    and m.partition_date = latest.partition_date and cast(m.row_id as varchar) = latest.run_id)""",
)
oracle(
    "publish_changed",
    [],
    f"""select strftime(cast(o_orderdate as date), '%Y-%m') as partition_date from orders
group by 1 having count(*) filter (o_orderpriority = '1-URGENT' and o_totalprice > {q.PRICE_CHANGED}) > 0""",
)
oracle(
    "json_props",
    [],
    """select cast(regexp_extract(props, '[0-9]+') as bigint) as k, count(*) as events
from events group by 1""",
)
oracle(
    "plan_sources",
    MONTHS,
    f"""select 'taxi_trips' as source_name, partition_date,
  replace('{TRIPS_URL}', '%s', partition_date) as source_url,
  'raw/taxi_trips/year=' || partition_date[1:4] || '/month=' || partition_date[6:7] ||
  '/yellow_tripdata_' || partition_date || '.parquet' as file_path
from calendar
union all
select 'weather', partition_date, '{WEATHER_URL}?{WEATHER_PLACE}&start_date=' || {text('month_start')} || '&end_date=' ||
  {text('month_end')} || '&{WEATHER_HOURLY}',
  'raw/weather/year=' || partition_date[1:4] || '/month=' || partition_date[6:7] ||
  '/weather_' || partition_date || '.json'
from calendar
union all
select 'taxi_zones', '', '{ZONES_URL}', 'raw/taxi_zones/taxi_zone_lookup.csv'""",
)

# Names, types, quality
oracle(
    "rename_canonical",
    TRIPS,
    f"select {TRIP_COLUMNS} from trips",
)
oracle("cast_types", TRIPS, f"select {TRIP_COLUMNS} from trips")
COUNTS = """count(*) as total_rows,
  count(*) filter (clean and not is_duplicate and not is_outlier) as valid_rows,
  count(*) filter (is_invalid) as invalid_rows,
  count(*) filter (is_null or is_duplicate or (clean and is_outlier)) as quarantined_rows"""
oracle(
    "classify_counts",
    CLASSED,
    f"""select {COUNTS}, count(*) filter (is_null) as null_rows,
  count(*) filter (is_duplicate) as duplicate_rows,
  count(*) filter (clean and is_outlier and not is_duplicate) as outlier_rows,
  count(*) filter (is_null and is_invalid) as null_and_invalid_rows
from t_classed""",
)
RULE_COUNTS = ", ".join(f"count(*) filter ({r}) as {r}" for r in RULES)
oracle("rule_counts", CLASSED, f"select {RULE_COUNTS} from t_classed")
oracle(
    "rule_flags",
    CLASSED,
    f"select trip_key, pickup_datetime, {', '.join(RULES)}, is_null, is_outlier from t_classed",
)
oracle("valid_rows", CLASSED, "select * from t_valid")
oracle(
    "invalid_rows",
    CLASSED,
    f"select {TRIP_COLUMNS}, {reasons()} as violation_reasons from t_classed where is_invalid",
)
WHY = "case when is_null then 'null' when is_duplicate then 'duplicate' else 'outlier' end"
HELD = "is_null or is_duplicate or (clean and is_outlier)"
oracle(
    "quarantined_rows",
    CLASSED,
    f"select {TRIP_COLUMNS}, {WHY} as quarantine_reason from t_classed where {HELD}",
)
oracle("null_rows", CLASSED, f"select {TRIP_COLUMNS} from t_classed where is_null")
oracle("duplicate_rows", CLASSED, f"select {TRIP_COLUMNS} from t_classed where is_duplicate")
oracle(
    "outlier_rows",
    CLASSED,
    f"select {TRIP_COLUMNS} from t_classed where clean and is_outlier and not is_duplicate",
)
oracle(
    "violation_reasons",
    CLASSED,
    f"""select {reasons()} as violation_reasons, count(*) as rows_found
from t_classed where is_invalid group by 1""",
)
oracle(
    "quarantine_reasons",
    CLASSED,
    f"""select {WHY} as quarantine_reason, count(*) as rows_found
from t_classed where {HELD} group by 1""",
)
oracle(
    "outcome_rows",
    CLASSED,
    f"""select {TRIP_COLUMNS}, 'valid' as class, cast(null as varchar) as violation_reasons,
  cast(null as varchar) as quarantine_reason from t_valid
union all
select {TRIP_COLUMNS}, 'invalid', {reasons()}, null from t_classed where is_invalid
union all
select {TRIP_COLUMNS}, 'quarantined', null, {WHY} from t_classed where {HELD}""",
)
_required = "pickup_datetime, dropoff_datetime, passenger_count, " + CRITICAL.split(", ", 2)[2]
oracle(
    "quality_report",
    CLASSED,
    f"""select {COUNTS}, count(*) filter (is_duplicate) as duplicate_count,
  {', '.join(f'count(*) filter ({c} is null) as null_counts_{c}' for c in _required.split(', '))},
  {', '.join(f'count(*) filter ({r}) as error_categories_{r}' for r in RULES)},
  count(*) filter (is_null) as quarantine_categories_null,
  count(*) filter (is_duplicate) as quarantine_categories_duplicate,
  count(*) filter (clean and is_outlier and not is_duplicate) as quarantine_categories_outlier,
  {', '.join(f'{f}(cast({c} as double)) as {c}_{f}'
             for c in ('trip_distance', 'fare_amount', 'tip_amount', 'passenger_count')
             for f in ('min', 'max'))}
from t_classed""",
)
oracle(
    "threshold_gate",
    CLASSED,
    """select *, invalid_ratio <= 0.2e0 and null_ratio <= 0.1e0 as passed from (
  select count(*) as total_rows, count(*) filter (is_invalid) as invalid_rows,
    count(*) filter (is_null) as null_rows,
    cast(count(*) filter (is_invalid) as double) / greatest(count(*), 1) as invalid_ratio,
    cast(count(*) filter (is_null) as double) / greatest(count(*), 1) as null_ratio
  from t_classed) r""",
)

# Derived columns
oracle("normalize", NORMAL, f"select * {PICKUP_DATE} from normal")
oracle(
    "payment_labels",
    TRIPS,
    f"""select payment_type, {case('payment_type', PAYMENT_LABELS)} as label, count(*) as trips
from trips group by 1, 2""",
)
oracle(
    "weekday_demand",
    NORMAL,
    f"""select pickup_day_of_week, count(*) as trips, {total('total_charge')} as revenue
from normal group by 1""",
)
oracle("avg_speed", NORMAL, "select trip_key, pickup_datetime, average_speed from normal")
oracle(
    "airport_trips",
    NORMAL,
    f"""select is_airport_trip, count(*) as trips, {mean('trip_distance')} as avg_miles
from normal group by 1""",
)
oracle("total_charge", NORMAL, "select trip_key, pickup_datetime, total_charge from normal")
oracle(
    "wmo_labels",
    [],
    f"""select code, {case('code', WEATHER_LABELS)} as label, count(*) as events
from (select cast(regexp_extract(props, '[0-9]+') as bigint) as code from events) e group by 1, 2""",
)
oracle(
    "hour_bucket_demand",
    RIDES,
    """select date_trunc('hour', pickup_datetime) as pickup_hour, count(*) as rides
from rides group by 1""",
)
oracle(
    "month_series",
    MONTHS,
    f"""select partition_date, {text('month_start')} as month_start, count(o_orderkey) as orders
from calendar left join orders on strftime(o_orderdate, '%Y-%m') = partition_date group by 1, 2""",
)
oracle(
    "day_series",
    [],
    f"""select {text('day')} as day, count(event_id) as events
from (select unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)),
    interval 1 day)) as day from events) s
  left join events on date_trunc('day', ts) = day group by 1""",
)
oracle(
    "month_bounds",
    [],
    f"""select {text("date_trunc('month', o_orderdate)")} as first_day,
  {text('last_day(o_orderdate)')} as last_day, count(*) as orders
from orders group by 1, 2""",
)

# Joins
oracle(
    "enrich_hourly",
    CURATED,
    f"""select * {PICKUP_DATE} from curated""",
)
oracle(
    "enrich_hourly_dedupe",
    RIDES + WEATHER,
    """select trip_key, temperature + 1 as temperature, weather_condition,
  temperature is not null as weather_joined
from rides left join weather on date_trunc('hour', pickup_datetime) = weather_hour""",
)
oracle(
    "enrich_hourly_fan_out",
    RIDES
    + WEATHER
    + [
        """doubled as (select * from weather
  union all select * replace (temperature + 1 as temperature) from weather)"""
    ],
    f"""select temperature is not null as weather_joined, count(*) as trips,
  {total('temperature')} as temperatures
from rides left join doubled on date_trunc('hour', pickup_datetime) = weather_hour group by 1""",
)
oracle(
    "weather_coverage",
    CURATED,
    """select count(*) as total_rows, count(*) filter (not weather_joined) as unmatched_rows,
  case when count(*) > 0 then cast(count(*) filter (weather_joined) as double) / count(*)
    else 0 end as coverage
from curated""",
)
oracle("stg_trips", STG, f"select * {PICKUP_DATE} from stg")
oracle("fct_trips", FACT, f"select * {PICKUP_DATE} from fact")
for _end in ("pickup", "dropoff"):
    oracle(
        f"orphan_{_end}_zones",
        FACT,
        f"""select {_end}_location_id, count(*) as trips from fact
where {_end}_location_id not in (select location_id from zones) group by 1""",
    )

# Marts and serving
oracle("daily_demand", DAILY, f"select * {DATE} from daily")
oracle("hourly_demand", HOURLY, f"select * {DATE} from hourly")
oracle("route_performance", ROUTE, "select * from route")
oracle("weather_impact", IMPACT, f"select * {DATE} from impact")
oracle(
    "mart_row_counts",
    DAILY + [hourly("hourly", "normal"), route("route", "normal")] + IMPACT + ZONES,
    """select 'dim_zones' as mart, count(*) as mart_rows from zones
union all select 'daily_demand', count(*) from daily
union all select 'hourly_demand', count(*) from hourly
union all select 'route_performance', count(*) from route
union all select 'weather_impact', count(*) from impact""",
)
oracle("demand_all", DAILY, f"select * {DATE} from daily")
oracle(
    "demand_filtered",
    DAILY,
    f"select * {DATE} from daily where {IN_DEMAND} and pickup_location_id = {q.DEMAND_ZONE}",
)
oracle(
    "revenue_by_date",
    DAILY,
    f"""select {text('date')} as date, {total('total_revenue')} as total_revenue,
  cast(sum(trip_count) as bigint) as trip_count
from daily group by 1""",
)
oracle(
    "top_routes",
    ROUTE,
    """select * from route
order by total_revenue desc nulls first, pickup_location_id, dropoff_location_id limit 10""",
)
oracle(
    "weather_impact_filtered",
    IMPACT,
    f"""select * {DATE} from impact where date between date '{q.WEATHER_START}'
  and date '{q.WEATHER_END}' and weather_condition = '{q.WEATHER_LABEL}'""",
)
oracle(
    "kpi",
    DAILY,
    f"""select cast(sum(trip_count) as bigint) as trips, {total('total_revenue')} as revenue,
  avg(average_trip_duration) as avg_duration
from daily where {IN_DEMAND}""",
)
oracle(
    "daily_trips_in_range",
    DAILY,
    f"""select {text('date')} as date, cast(sum(trip_count) as bigint) as trips
from daily where {IN_DEMAND} group by 1""",
)
oracle(
    "trips_by_hour",
    HOURLY,
    "select hour, cast(sum(trip_count) as bigint) as trips from hourly group by 1",
)
oracle(
    "top_zones",
    DAILY + ZONES,
    f"""select zone, cast(sum(trip_count) as bigint) as trips
from daily join zones on pickup_location_id = location_id where {IN_DEMAND}
group by 1 order by trips desc nulls first, zone limit 10""",
)
oracle(
    "top_zone_ids",
    DAILY,
    """select pickup_location_id, cast(sum(trip_count) as bigint) as trips
from daily group by 1 order by trips desc nulls first, pickup_location_id limit 10""",
)
oracle(
    "revenue_trend",
    DAILY,
    f"""select {text('date')} as date, {total('total_revenue')} as revenue
from daily where {IN_DEMAND} group by 1""",
)
oracle(
    "top_routes_named",
    ROUTE + ZONES,
    """select p.zone as pickup, o.zone as dropoff, trip_count, total_revenue
from route join zones p on pickup_location_id = p.location_id
  join zones o on dropoff_location_id = o.location_id
order by total_revenue desc nulls first, p.zone, o.zone, pickup_location_id, dropoff_location_id
limit 10""",
)
oracle(
    "weather_summary",
    IMPACT,
    """select weather_condition, cast(sum(trip_count) as bigint) as trips,
  avg(average_duration) as avg_duration
from impact group by 1""",
)
oracle(
    "payment_breakdown",
    NORMAL,
    "select payment_type, count(*) as trip_count from normal group by 1",
)

# Dataset tests
oracle(
    "not_null_check",
    FACT,
    """select count(*) as checked_rows, count(*) filter (weather_condition is null) as violations
from fact""",
)
oracle(
    "unique_zone_ids",
    ZONES,
    """select count(*) as checked_rows, (select count(*) from (select location_id from zones
  where location_id is not null group by 1 having count(*) > 1) v) as violations
from zones""",
)
oracle(
    "unique_trip_keys",
    TRIPS,
    "select trip_key, count(*) as trips from trips group by 1 having count(*) > 1",
)
oracle(
    "accepted_payment",
    NORMAL,
    f"""select count(*) as checked_rows, count(distinct payment_type) filter
  (payment_type not in ({', '.join(f"'{v}'" for v in PAYMENT_LABELS.values())})) as violations
from normal""",
)
oracle(
    "accepted_event_types",
    [],
    """select event_type, count(*) as events from events
where event_type not in ('view', 'click') group by 1""",
)
_DUP_KEYS = {
    "dup_keys_daily": (DAILY, "daily", "date, pickup_location_id"),
    "dup_keys_hourly": (HOURLY, "hourly", "date, hour"),
    "dup_keys_route": (ROUTE, "route", "pickup_location_id, dropoff_location_id"),
    "dup_keys_weather": (IMPACT, "impact", "date, weather_condition, precipitation"),
}
for _key, (_ctes, _mart, _columns) in _DUP_KEYS.items():
    oracle(
        _key,
        _ctes,
        f"""select count(*) as checked_rows, (select count(*) from (select {_columns} from {_mart}
  group by all having count(*) > 1) v) as violations
from {_mart}""",
    )
_MART_OF = {
    "dim_zones": "zones",
    "fct_trips": "fact",
    "daily_demand": "f_daily",
    "hourly_demand": "f_hourly",
    "route_performance": "f_route",
    "weather_impact": "f_impact",
}
_NOT_NULL = [
    ("dim_zones", "location_id"),
    ("dim_zones", "zone"),
    ("fct_trips", "pickup_datetime"),
    ("fct_trips", "dropoff_datetime"),
    ("daily_demand", "date"),
    ("daily_demand", "pickup_location_id"),
    ("daily_demand", "trip_count"),
    ("hourly_demand", "date"),
    ("hourly_demand", "hour"),
    ("route_performance", "pickup_location_id"),
    ("route_performance", "dropoff_location_id"),
    ("weather_impact", "date"),
    ("weather_impact", "weather_condition"),
]
_checks = [
    f"""select 'not_null_{t}_{c}' as "check", count(*) as violations from {_MART_OF[t]}
where {c} is null"""
    for t, c in _NOT_NULL
]
_checks.append(
    """select 'unique_dim_zones_location_id', count(*) from (select location_id from zones
where location_id is not null group by 1 having count(*) > 1) v"""
)
for _end in ("pickup", "dropoff"):
    _checks.append(
        f"""select 'relationships_fct_trips_{_end}_location_id',
count(distinct {_end}_location_id) from fact
where {_end}_location_id not in (select location_id from zones)"""
    )
_checks.append(
    f"""select 'accepted_values_fct_trips_payment_type', count(distinct payment_type) from fact
where payment_type not in ({', '.join(f"'{v}'" for v in PAYMENT_LABELS.values())})"""
)
for _key, (_, _mart, _columns) in _DUP_KEYS.items():
    _name = {"daily": "daily_demand", "hourly": "hourly_demand", "route": "route_performance"}.get(
        _mart, "weather_impact"
    )
    _checks.append(
        f"""select 'unique_{_name}', count(*) from (select {_columns} from {_MART_OF[_name]}
group by all having count(*) > 1) v"""
    )
oracle(
    "mart_check_results",
    FACT
    + [daily("f_daily", "fact"), hourly("f_hourly", "fact"), route("f_route", "fact")]
    + [impact("f_impact", "fact")],
    " union all ".join(_checks),
)
oracle(
    "curated_null_counts",
    CURATED,
    "select "
    + ", ".join(
        f"count(*) filter ({c} is null) as {c}"
        for c in (
            "pickup_datetime",
            "pickup_location_id",
            "total_charge",
            "average_speed",
            "temperature",
        )
    )
    + " from curated",
)
oracle(
    "curated_ranges",
    CURATED,
    "select "
    + ", ".join(
        f"{f}({c}) as {c}_{f}"
        for c in ("trip_distance", "trip_duration_seconds", "pickup_hour", "total_charge")
        for f in ("min", "max")
    )
    + " from curated",
)
oracle(
    "reconcile_counts",
    NORMAL,
    """select *, valid_rows = normalized_rows as reconciled from (
  select (select count(*) from trips) as total_rows, (select count(*) from t_valid) as valid_rows,
    (select count(*) from normal) as normalized_rows) c""",
)
oracle("dates_written", NORMAL, f"select distinct {text('pickup_date')} as pickup_date from normal")

# History, manifest, orchestration
oracle(
    "runs_upsert",
    RUNS,
    """select run_id, pipeline_name, partition_date,
  case when completed_at is null then 'running' else status end as status, started_at,
  completed_at, case when completed_at is not null then input_rows end as input_rows,
  case when completed_at is not null then output_rows end as output_rows,
  case when completed_at is not null then error_message end as error_message,
  coalesce(completed_at, started_at) as recorded_at
from runs""",
)
oracle(
    "list_runs",
    RUNS,
    "select * from runs order by started_at desc, run_id desc limit 50",
)
oracle("latest_run_per_partition", LATEST_RUNS, "select * from latest")
oracle(
    "latest_run",
    RUNS,
    "select * from runs order by status = 'success' desc, started_at desc, run_id desc limit 1",
)
oracle(
    "completed_partitions",
    LATEST_RUNS,
    "select pipeline_name, partition_date from latest where status = 'success'",
)
oracle(
    "pending_partitions",
    LATEST_GAP_RUNS + MONTHS,
    """select partition_date from calendar where partition_date not in
  (select partition_date from latest where status = 'success' and pipeline_name = 'trips')""",
)
oracle("manifest_upsert", MANIFEST, "select * from manifest")
oracle(
    "manifest_lookup",
    MANIFEST,
    "select * from manifest where source_name = '1-URGENT' and partition_date = '1997-03'",
)
oracle(
    "list_ingestions",
    MANIFEST,
    """select source_name, partition_date, downloaded_at, file_size, row_count, status
from manifest""",
)
oracle(
    "rows_per_source",
    MANIFEST,
    """select source_name, cast(sum(row_count) as bigint) as row_count
from manifest where status = 'success' group by 1""",
)
oracle(
    "ingest_summary",
    MANIFEST,
    """select count(*) as total, count(*) filter (status = 'success') as success,
  count(*) filter (status <> 'success') as failed from manifest""",
)
oracle(
    "pending_ingests",
    MANIFEST + MONTHS,
    """select s.source_name, c.partition_date,
  s.source_name || '/' || c.partition_date || '/part.parquet' as file_path
from (select distinct source_name from manifest_log) s cross join calendar c
where not exists (select 1 from manifest m where m.source_name = s.source_name
    and m.partition_date = c.partition_date and m.status = 'success'
    and m.file_size = (select max(l.file_size) from manifest_log l
      where l.source_name = s.source_name and l.partition_date = c.partition_date))""",
)

# Metrics and alerts
NEWEST = [
    "newest as (select * from runs order by started_at desc, run_id desc limit 1)",
    """good as (select * from runs where status = 'success'
  order by started_at desc, run_id desc limit 2)""",
]
METRICS = (
    RUNS
    + MANIFEST
    + NEWEST
    + [
        """metrics as (
  select 'rows_ingested' as metric, source_name as label, cast(sum(row_count) as double) as value
  from manifest where status = 'success' group by 2
  union all select 'job_failures', null, count(*) filter (status = 'failed') from runs
  union all select 'last_partition_status', null, cast(status = 'success' as int) from newest
  union all select 'current_partition', partition_date, 1 from newest
  union all select 'run_duration_seconds', null, date_diff('microsecond', started_at,
    completed_at) / 1e6 from newest where completed_at is not null
  union all select 'rows_transformed', null, output_rows from newest where status = 'success'
  union all select 'rows_rejected', null, input_rows - output_rows from newest
    where status = 'success'
  union all select 'last_success_timestamp', null, epoch(completed_at) from newest
    where status = 'success' and completed_at is not null)"""
    ]
)
oracle("run_metrics", METRICS, "select * from metrics")
oracle(
    "metric_rules",
    METRICS,
    """select alert, severity, metric, value from metrics join (values
  ('last_partition_status', '=', 0, 'PipelineFailure', 'critical'),
  ('rows_transformed', '=', 0, 'NoDataReceived', 'critical'),
  ('job_failures', '>', 3, 'HighJobFailureRate', 'warning'),
  ('run_duration_seconds', '>', 3600, 'SlowPipeline', 'warning'))
  r(metric, op, bound, alert, severity) using (metric)
where case op when '=' then value = bound else value > bound end""",
)
CHANGE_STEPS = NEWEST + [
    """change as (
  select previous_partition, previous_rows, last_partition, last_rows,
    cast(last_rows as double) / previous_rows as ratio
  from (select lag(partition_date) over w as previous_partition, lag(input_rows) over w
      as previous_rows, partition_date as last_partition, coalesce(input_rows, 0) as last_rows
    from good window w as (order by started_at, run_id)) p
  where previous_rows <> 0)""",
    """gaps as (
  select before_gap, after_gap from (
    select partition_date as before_gap, lead(partition_date) over (order by partition_date)
      as after_gap
    from (select distinct partition_date from runs where status = 'success') p) l
  where after_gap <> strftime(cast(before_gap || '-01' as date) + interval 1 month, '%Y-%m'))""",
]
CHANGE, GAPS = RUNS + CHANGE_STEPS, GAP_RUNS + CHANGE_STEPS
oracle("row_count_change", CHANGE, "select * from change")
oracle("missing_partitions", GAPS, "select * from gaps")
oracle(
    "alerts",
    GAPS,
    """select 'pipeline_failure' as name, 'critical' as severity,
  'Partition ' || partition_date || ' failed: ' || error_message as message
from newest where status = 'failed'
union all select 'no_data', 'critical', 'No successful runs recorded.'
where not exists (select 1 from runs where status = 'success')
union all select 'no_data', 'critical', 'Latest run produced 0 rows.' from
  (select * from good order by started_at desc, run_id desc limit 1) g
  where coalesce(output_rows, 0) = 0
union all select 'row_count_change', 'warning', printf(
  'Input rows changed %.1fx between partitions %s and %s.', ratio, previous_partition,
  last_partition) from change where ratio > 2 or ratio < 0.5
union all select 'excessive_duration', 'warning', printf('Latest run took %.0fs (>3600s).',
  date_diff('microsecond', started_at, completed_at) / 1e6) from
  (select * from good order by started_at desc, run_id desc limit 1) g
  where date_diff('microsecond', started_at, completed_at) / 1e6 > 3600
union all select 'missing_partition', 'warning', 'Gap in processed partitions between ' ||
  before_gap || ' and ' || after_gap || '.' from
  (select * from gaps order by before_gap limit 1) g""",
)
