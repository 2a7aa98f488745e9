"""Staging model, zone dimension, fact and the four marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tripmill.functions.measures import mean_of, merged_parts, sum_of, sum_parts
from tripmill.operators.joins import role_join
from tripmill.schema import CURATED_COLUMNS, FACT_COLUMNS, STAGING_MODEL_TYPES


def stg_trips(curated: DataFrame) -> DataFrame:
    """Curated trips with the column types of the staging model."""
    return curated.select(
        *(
            F.col(c).cast(STAGING_MODEL_TYPES[c]).alias(c) if c in STAGING_MODEL_TYPES else F.col(c)
            for c in CURATED_COLUMNS
        )
    )


def fct_trips(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """One row per trip with the zone and borough of both ends (null when unknown)."""
    roles = {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"}
    named = role_join(staged, zones, "location_id", ["zone", "borough"], roles)
    return named.select(*FACT_COLUMNS)


@dataclass(frozen=True)
class Rollup:
    """A mart: key columns (``{"output": "input"}``) and measures (``{name: (kind, column)}``)."""

    keys: dict[str, str]
    measures: dict[str, tuple[str, str]]

    def columns(self) -> list[str]:
        """Columns that are summed, each once."""
        return list(dict.fromkeys(column for _, column in self.measures.values()))


DAILY_DEMAND = Rollup(
    {"date": "pickup_date", "pickup_location_id": "pickup_location_id"},
    {
        "average_trip_duration": ("avg", "trip_duration_seconds"),
        "total_distance": ("sum", "trip_distance"),
        "total_revenue": ("sum", "total_charge"),
        "average_fare": ("avg", "fare_amount"),
    },
)
HOURLY_DEMAND = Rollup(
    {"date": "pickup_date", "hour": "pickup_hour"},
    {
        "average_trip_duration": ("avg", "trip_duration_seconds"),
        "average_fare": ("avg", "fare_amount"),
    },
)
ROUTE_PERFORMANCE = Rollup(
    {"pickup_location_id": "pickup_location_id", "dropoff_location_id": "dropoff_location_id"},
    {
        "average_distance": ("avg", "trip_distance"),
        "average_duration": ("avg", "trip_duration_seconds"),
        "total_revenue": ("sum", "total_charge"),
        "average_tip": ("avg", "tip_amount"),
    },
)
WEATHER_IMPACT = Rollup(
    {
        "date": "pickup_date",
        "weather_condition": "weather_condition",
        "precipitation": "precipitation",
    },
    {
        "average_duration": ("avg", "trip_duration_seconds"),
        "average_fare": ("avg", "fare_amount"),
    },
)
ROLLUPS = {
    "daily_demand": DAILY_DEMAND,
    "hourly_demand": HOURLY_DEMAND,
    "route_performance": ROUTE_PERFORMANCE,
    "weather_impact": WEATHER_IMPACT,
}


def _measures(rollup: Rollup, parts: dict[str, dict[str, Column]]) -> list[Column]:
    finish = {"sum": sum_of, "avg": mean_of}
    return [finish[kind](parts[c]).alias(name) for name, (kind, c) in rollup.measures.items()]


def rolled_up(fact: DataFrame, rollup: Rollup) -> DataFrame:
    """The mart over fact rows.

    Every measure has a partial form, so a hot group reaches the exchange as one row per task.
    """
    keys = [F.col(source).alias(name) for name, source in rollup.keys.items()]
    parts = {c: sum_parts(F.col(c)) for c in rollup.columns()}
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"), *_measures(rollup, parts))


def rollup_parts(fact: DataFrame, rollup: Rollup) -> DataFrame:
    """The mart's groups with the parts of its sums, to be merged with those of other trips."""
    keys = [F.col(source).alias(name) for name, source in rollup.keys.items()]
    parts = [
        part.alias(f"{c}_{name}")
        for c in rollup.columns()
        for name, part in sum_parts(F.col(c)).items()
    ]
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"), *parts)


def merged_rollup(parts: DataFrame, rollup: Rollup) -> DataFrame:
    """The mart out of the parts of several months."""
    sums = {c: merged_parts(c) for c in rollup.columns()}
    return parts.groupBy(*rollup.keys).agg(F.sum("trip_count").alias("trip_count"), *_measures(rollup, sums))


def daily_demand(fact: DataFrame) -> DataFrame:
    return rolled_up(fact, DAILY_DEMAND)


def hourly_demand(fact: DataFrame) -> DataFrame:
    return rolled_up(fact, HOURLY_DEMAND)


def route_performance(fact: DataFrame) -> DataFrame:
    return rolled_up(fact, ROUTE_PERFORMANCE)


def weather_impact(fact: DataFrame) -> DataFrame:
    """Trips without weather form a group of their own (null condition)."""
    return rolled_up(fact, WEATHER_IMPACT)


@dataclass(frozen=True)
class Marts:
    dim_zones: DataFrame
    daily_demand: DataFrame
    hourly_demand: DataFrame
    route_performance: DataFrame
    weather_impact: DataFrame

    def items(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def build_marts(fact: DataFrame, zones: DataFrame) -> Marts:
    return Marts(
        dim_zones=zones,
        daily_demand=daily_demand(fact),
        hourly_demand=hourly_demand(fact),
        route_performance=route_performance(fact),
        weather_impact=weather_impact(fact),
    )


def mart_row_counts(marts: Marts) -> DataFrame:
    """One row per mart: its name and number of rows."""
    counted = [
        mart.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("mart"), "rows")
        for name, mart in marts.items().items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result
