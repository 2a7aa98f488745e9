"""Derived columns of validated trips."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from tripmill.functions.calendar import monday_based_weekday, whole_seconds
from tripmill.functions.labels import payment_label
from tripmill.schema import AIRPORT_ZONES, CHARGE_COLUMNS, STAGING_COLUMNS


def average_speed(miles: Column, seconds: Column) -> Column:
    """Miles per hour; null unless the trip took time."""
    return F.when(seconds > 0, miles / (seconds / F.lit(3600.0)))


def total_charge(columns: list[str]) -> Column | None:
    """Sum of the money columns that exist, null as 0; None when there are none."""
    amounts = [
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in CHARGE_COLUMNS if c in columns
    ]
    return reduce(add, amounts) if amounts else None


def airport_trip() -> Column:
    return F.col("pickup_location_id").isin(*AIRPORT_ZONES) | F.col("dropoff_location_id").isin(
        *AIRPORT_ZONES
    )


def normalize(valid: DataFrame) -> DataFrame:
    """Add the staging columns to valid trips; every input column is kept."""
    pickup = F.col("pickup_datetime")
    seconds = whole_seconds(pickup, F.col("dropoff_datetime"))
    derived = {
        "pickup_date": F.to_date(pickup),
        "pickup_hour": F.hour(pickup),
        "pickup_day_of_week": monday_based_weekday(pickup),
        "trip_duration_seconds": seconds,
        "average_speed": average_speed(F.col("trip_distance").cast("double"), seconds),
        "is_airport_trip": airport_trip(),
    }
    if "passenger_count" in valid.columns:
        derived["passenger_count"] = F.coalesce(F.col("passenger_count"), F.lit(0)).cast("bigint")
    if "payment_type" in valid.columns:
        derived["payment_type"] = payment_label(F.col("payment_type"))
    charge = total_charge(valid.columns)
    if charge is not None:
        derived["total_charge"] = charge
    return valid.withColumns(derived)


def staging_columns(normalized: DataFrame) -> DataFrame:
    """Only the documented staging columns."""
    return normalized.select(*STAGING_COLUMNS)
