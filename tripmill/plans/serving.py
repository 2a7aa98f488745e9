"""Parameterised queries over the marts, each returning a DataFrame.

Optional filters are added only when given, so what is given reaches the scan as a pushed
predicate. Ties in a ranking are broken by key, nulls rank first as in the served database.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tripmill.functions.measures import stable_sum
from tripmill.operators.joins import dimension_join, fits_broadcast
from tripmill.plans.history import list_runs
from tripmill.plans.marts import Marts

MAX_LIMIT = 1000


def check_limit(limit: int) -> int:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}, got {limit}")
    return limit


def _in_dates(mart: DataFrame, start: date | None, end: date | None) -> DataFrame:
    if start is not None:
        mart = mart.where(F.col("date") >= F.lit(start))
    if end is not None:
        mart = mart.where(F.col("date") <= F.lit(end))
    return mart


def _ascending(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.orderBy(*(F.col(k).asc_nulls_last() for k in keys))


def _top(rows: DataFrame, by: str, ties: list[str], limit: int) -> DataFrame:
    ranking = [F.col(by).desc_nulls_first(), *(F.col(t).asc_nulls_last() for t in ties)]
    return rows.orderBy(*ranking).limit(check_limit(limit))


def demand(
    marts: Marts,
    start: date | None = None,
    end: date | None = None,
    location_id: int | None = None,
) -> DataFrame:
    rows = _in_dates(marts.daily_demand, start, end)
    if location_id is not None:
        rows = rows.where(F.col("pickup_location_id") == location_id)
    return _ascending(rows, "date", "pickup_location_id")


def revenue(marts: Marts, start: date | None = None, end: date | None = None) -> DataFrame:
    rows = _in_dates(marts.daily_demand, start, end)
    totals = rows.groupBy("date").agg(
        stable_sum(F.col("total_revenue")).alias("total_revenue"),
        F.sum("trip_count").alias("trip_count"),
    )
    return _ascending(totals, "date")


def routes(marts: Marts, limit: int = 10) -> DataFrame:
    keys = ["pickup_location_id", "dropoff_location_id"]
    return _top(marts.route_performance, "total_revenue", keys, limit)


def weather_impact(
    marts: Marts,
    start: date | None = None,
    end: date | None = None,
    weather_condition: str | None = None,
) -> DataFrame:
    rows = _in_dates(marts.weather_impact, start, end)
    if weather_condition is not None:
        rows = rows.where(F.col("weather_condition") == weather_condition)
    return _ascending(rows, "date", "weather_condition", "precipitation")


def kpi(marts: Marts, start: date, end: date) -> DataFrame:
    """Trips, revenue and the unweighted mean of the daily zone averages."""
    return _in_dates(marts.daily_demand, start, end).agg(
        F.sum("trip_count").alias("trips"),
        stable_sum(F.col("total_revenue")).alias("revenue"),
        F.avg("average_trip_duration").alias("avg_duration"),
    )


def trips_by_day(marts: Marts, start: date, end: date) -> DataFrame:
    rows = _in_dates(marts.daily_demand, start, end)
    return _ascending(rows.groupBy("date").agg(F.sum("trip_count").alias("trips")), "date")


def trips_by_hour(marts: Marts) -> DataFrame:
    totals = marts.hourly_demand.groupBy("hour").agg(F.sum("trip_count").alias("trips"))
    return _ascending(totals, "hour")


def top_zones(marts: Marts, start: date, end: date, limit: int = 10) -> DataFrame:
    """Pickup zones by trips. Trips are summed per zone id before names are joined."""
    per_id = (
        _in_dates(marts.daily_demand, start, end)
        .groupBy("pickup_location_id")
        .agg(F.sum("trip_count").alias("trips"))
    )
    names = marts.dim_zones.select(F.col("location_id").alias("pickup_location_id"), "zone")
    named = dimension_join(per_id, names, ["pickup_location_id"], "inner")
    totals = named.groupBy("zone").agg(F.sum("trips").alias("trips"))
    return _top(totals, "trips", ["zone"], limit)


def top_zone_ids(marts: Marts, limit: int = 10) -> DataFrame:
    totals = marts.daily_demand.groupBy("pickup_location_id").agg(
        F.sum("trip_count").alias("trips")
    )
    return _top(totals, "trips", ["pickup_location_id"], limit)


def revenue_trend(marts: Marts, start: date, end: date) -> DataFrame:
    rows = _in_dates(marts.daily_demand, start, end)
    totals = rows.groupBy("date").agg(stable_sum(F.col("total_revenue")).alias("revenue"))
    return _ascending(totals, "date")


def top_routes_named(marts: Marts, limit: int = 10) -> DataFrame:
    """Routes by revenue with the names of both zones; routes to unnamed zones are left out."""
    rows = marts.route_performance.select(
        "pickup_location_id", "dropoff_location_id", "trip_count", "total_revenue"
    )
    fits = fits_broadcast(marts.dim_zones.select("location_id", "zone"))  # measured once
    for end in ("pickup", "dropoff"):
        key = f"{end}_location_id"
        names = marts.dim_zones.select(F.col("location_id").alias(key), F.col("zone").alias(end))
        rows = dimension_join(rows, names, [key], "inner", fits)
    ties = ["pickup", "dropoff", "pickup_location_id", "dropoff_location_id"]
    ranked = _top(rows, "total_revenue", ties, limit)
    return ranked.select("pickup", "dropoff", "trip_count", "total_revenue")


def weather_summary(marts: Marts) -> DataFrame:
    """Trips and the unweighted mean duration per weather condition."""
    totals = marts.weather_impact.groupBy("weather_condition").agg(
        F.sum("trip_count").alias("trips"), F.avg("average_duration").alias("avg_duration")
    )
    return totals.orderBy(F.col("trips").desc(), F.col("weather_condition").asc_nulls_last())


def payment_breakdown(fact: DataFrame) -> DataFrame:
    totals = fact.groupBy("payment_type").agg(F.count(F.lit(1)).alias("trip_count"))
    return totals.orderBy(F.col("trip_count").desc(), F.col("payment_type").asc_nulls_last())


def pipeline_runs(runs: DataFrame, limit: int = 50) -> DataFrame:
    return list_runs(runs, limit=check_limit(limit))
