"""Dataset tests. Each returns the violations; no rows means the test passes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tripmill.operators.joins import orphans
from tripmill.schema import PAYMENT_LABELS


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def unique(rows: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row; nulls are not compared."""
    return unique_together(rows.where(F.col(column).isNotNull()), [column])


def unique_together(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations (nulls equal) held by more than one row, with their row count."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def accepted_values(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Non-null values outside the list, with their row count."""
    return (
        rows.where(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def relationships(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return orphans(child, key, parent, parent_key)


def null_counts(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))


def value_ranges(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row with ``<column>_min`` and ``<column>_max``."""
    return rows.agg(
        *(f(F.col(c)).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max)))
    )


def absent_columns(rows: DataFrame, expected: tuple[str, ...]) -> list[str]:
    """Expected columns the schema lacks; answered without a job."""
    return [c for c in expected if c not in rows.columns]


def summary(rows: DataFrame, violations: DataFrame) -> DataFrame:
    """One row: how many rows were checked and how many violations were found."""
    checked = rows.select(F.lit(1).alias("checked"), F.lit(0).alias("violation"))
    found = violations.select(F.lit(0).alias("checked"), F.lit(1).alias("violation"))
    both = checked.unionByName(found)
    return both.agg(
        F.coalesce(F.sum("checked"), F.lit(0)).cast("bigint").alias("checked_rows"),
        F.coalesce(F.sum("violation"), F.lit(0)).cast("bigint").alias("violations"),
    )


# Columns that must not be null and keys that must be unique, per table.
REQUIRED_COLUMNS = {
    "dim_zones": ("location_id", "zone"),
    "fct_trips": ("pickup_datetime", "dropoff_datetime"),
    "daily_demand": ("date", "pickup_location_id", "trip_count"),
    "hourly_demand": ("date", "hour"),
    "route_performance": ("pickup_location_id", "dropoff_location_id"),
    "weather_impact": ("date", "weather_condition"),
}
MART_KEYS = {
    "daily_demand": ["date", "pickup_location_id"],
    "hourly_demand": ["date", "hour"],
    "route_performance": ["pickup_location_id", "dropoff_location_id"],
    "weather_impact": ["date", "weather_condition", "precipitation"],
}
ZONE_KEYS = ("pickup_location_id", "dropoff_location_id")


@dataclass(frozen=True)
class Check:
    name: str
    violations: DataFrame


def key_checks(fact: DataFrame, marts) -> list[Check]:
    """Tests on keys and values: uniqueness, zone relationships, accepted labels."""
    zones, tables = marts.dim_zones, marts.items()
    labels = list(PAYMENT_LABELS.values())
    return [
        Check("unique_dim_zones_location_id", unique(zones, "location_id")),
        *(
            Check(f"relationships_fct_trips_{key}", relationships(fact, key, zones, "location_id"))
            for key in ZONE_KEYS
        ),
        Check(
            "accepted_values_fct_trips_payment_type", accepted_values(fact, "payment_type", labels)
        ),
        *(
            Check(f"unique_{table}", unique_together(tables[table], columns))
            for table, columns in MART_KEYS.items()
        ),
    ]


FACT_GROUPS = (*ZONE_KEYS, "payment_type")


def fact_profile(fact: DataFrame) -> DataFrame:
    """What the tests of the fact need, from one grouped scan of it.

    One row per pair of zones and payment label, with the null counts of the required columns;
    the profiles of several months can simply be put together.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED_COLUMNS["fct_trips"]]
    return fact.groupBy(*FACT_GROUPS).agg(F.count(F.lit(1)).alias("trips"), *nulls)


def mart_check_results(profile: DataFrame, marts) -> DataFrame:
    """One row per dataset test of the dimension, the fact and the marts: name, violations.

    The fact is seen through its profile. The null tests of a table are one scan of it.
    """
    parts = []
    for table, columns in REQUIRED_COLUMNS.items():
        if table == "fct_trips":
            sums = (F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(c) for c in columns)
            counted = profile.agg(*sums)
        else:
            counted = null_counts(marts.items()[table], columns)
        entries = ", ".join(f"'not_null_{table}_{c}', `{c}`" for c in columns)
        parts.append(counted.selectExpr(f"stack({len(columns)}, {entries}) as (check, violations)"))
    for check in key_checks(profile, marts):
        found = check.violations.agg(F.count(F.lit(1)).alias("violations"))
        parts.append(found.select(F.lit(check.name).alias("check"), "violations"))
    return reduce(DataFrame.unionByName, parts)
