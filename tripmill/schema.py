"""Names, types and constants of the trip model."""

from __future__ import annotations

from pyspark.sql import types as T

# Source column name -> canonical column name.
TRIP_COLUMN_NAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "Airport_fee": "airport_fee",
}

# The trip contract. A null in any required column except
# passenger_count sends the row to quarantine.
REQUIRED_TYPES = {
    "pickup_datetime": T.TimestampNTZType(),
    "dropoff_datetime": T.TimestampNTZType(),
    "passenger_count": T.LongType(),
    "trip_distance": T.DoubleType(),
    "pickup_location_id": T.LongType(),
    "dropoff_location_id": T.LongType(),
    "payment_type": T.LongType(),
    "fare_amount": T.DoubleType(),
    "tip_amount": T.DoubleType(),
}
REQUIRED = tuple(REQUIRED_TYPES)
CRITICAL = tuple(c for c in REQUIRED if c != "passenger_count")

# Measures that are cast when a feed carries them, besides the required ones.
# Types of the columns a feed may lack.
OPTIONAL_TYPES = {
    "extra": T.DoubleType(),
    "mta_tax": T.DoubleType(),
    "tolls_amount": T.DoubleType(),
    "improvement_surcharge": T.DoubleType(),
    "total_amount": T.DoubleType(),
    "congestion_surcharge": T.DoubleType(),
    "airport_fee": T.DoubleType(),
}

# Limits of the quality rules.
LOCATION_ID_RANGE = (1, 265)
MAX_PASSENGERS = 9
PAYMENT_CODES = (0, 1, 2, 3, 4, 5, 6)
MAX_PLAUSIBLE_MILES = 200.0
MAX_PLAUSIBLE_SECONDS = 86_400
RANGE_REPORTED = ("trip_distance", "fare_amount", "tip_amount", "passenger_count")

# Payment code -> label.
PAYMENT_LABELS = {
    0: "not_recorded",
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided_trip",
}

# WMO weather code -> label.
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
UNKNOWN_LABEL = "unknown"

# Airport zones and the money columns that make up total_charge.
AIRPORT_ZONES = (1, 132, 138)
CHARGE_COLUMNS = (
    "fare_amount",
    "tip_amount",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
)

# Columns of the staging, weather, curated and fact tables, and model types.
STAGING_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_date",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
    "trip_distance",
    "trip_duration_seconds",
    "average_speed",
    "fare_amount",
    "tip_amount",
    "total_charge",
    "payment_type",
    "is_airport_trip",
)
WEATHER_COLUMNS = ("temperature", "precipitation", "wind_speed", "weather_condition")
CURATED_COLUMNS = STAGING_COLUMNS + WEATHER_COLUMNS + ("weather_joined",)

# Column -> type of the staging model over curated trips; payment_type,
# weather_condition and the two booleans pass through unchanged.
STAGING_MODEL_TYPES = {
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "pickup_date": "date",
    "pickup_hour": "int",
    "pickup_day_of_week": "int",
    "pickup_location_id": "int",
    "dropoff_location_id": "int",
    "passenger_count": "int",
    "trip_distance": "double",
    "trip_duration_seconds": "double",
    "average_speed": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_charge": "double",
    "temperature": "double",
    "precipitation": "double",
    "wind_speed": "double",
}

FACT_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_date",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_location_id",
    "pickup_zone",
    "pickup_borough",
    "dropoff_location_id",
    "dropoff_zone",
    "dropoff_borough",
    "passenger_count",
    "trip_distance",
    "trip_duration_seconds",
    "average_speed",
    "fare_amount",
    "tip_amount",
    "total_charge",
    "payment_type",
    "is_airport_trip",
    "temperature",
    "precipitation",
    "wind_speed",
    "weather_condition",
    "weather_joined",
)

ZONES_CSV_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"
WEATHER_JSON_SCHEMA = (
    "timezone string, hourly struct<time:array<string>,temperature_2m:array<double>,"
    "precipitation:array<double>,wind_speed_10m:array<double>,weather_code:array<bigint>>"
)
RUN_LOG_SCHEMA = (
    "run_id string, pipeline_name string, partition_date string, status string, "
    "started_at timestamp, completed_at timestamp, input_rows bigint, output_rows bigint, "
    "error_message string, recorded_at timestamp"
)
PUBLISH_LOG_SCHEMA = (
    "partition_date string, version string, zones_digest string, published_at timestamp"
)
COMMIT_LOG_SCHEMA = (
    "table_name string, partition_date string, commit_id string, row_count bigint, "
    "checksum string, table_schema string, dates array<string>, file_count bigint, "
    "byte_count bigint, committed_at timestamp"
)
MANIFEST_SCHEMA = (
    "source_name string, source_url string, partition_date string, downloaded_at timestamp, "
    "file_path string, file_size bigint, checksum string, row_count bigint, status string"
)
