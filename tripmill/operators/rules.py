"""Declarative quality rules: a name, a description and an SQL predicate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from tripmill.functions.calendar import whole_seconds
from tripmill.schema import (
    CRITICAL,
    LOCATION_ID_RANGE,
    MAX_PASSENGERS,
    MAX_PLAUSIBLE_MILES,
    MAX_PLAUSIBLE_SECONDS,
    PAYMENT_CODES,
    RANGE_REPORTED,
    REQUIRED,
)


@dataclass(frozen=True)
class Rule:
    """``predicate`` holds for a violating row; a null comparison is no violation."""

    name: str
    description: str
    predicate: str

    @property
    def flag(self) -> str:
        """SQL that is true for a violating row and false for any other."""
        return f"coalesce({self.predicate}, false)"


_FIRST_ZONE, _LAST_ZONE = LOCATION_ID_RANGE
_CODES = ", ".join(str(code) for code in PAYMENT_CODES)

TRIP_RULES = (
    Rule(
        "dropoff_before_pickup",
        "a trip ends no earlier than it starts",
        "dropoff_datetime < pickup_datetime",
    ),
    Rule("negative_distance", "distance is zero or more", "trip_distance < 0"),
    Rule("negative_fare", "fare is zero or more", "fare_amount < 0"),
    Rule("negative_tip", "tip is zero or more", "tip_amount < 0"),
    Rule(
        "invalid_passenger_count",
        f"0 to {MAX_PASSENGERS} passengers",
        f"passenger_count NOT BETWEEN 0 AND {MAX_PASSENGERS}",
    ),
    Rule(
        "invalid_pickup_location",
        f"pickup zone id {_FIRST_ZONE} to {_LAST_ZONE}",
        f"pickup_location_id NOT BETWEEN {_FIRST_ZONE} AND {_LAST_ZONE}",
    ),
    Rule(
        "invalid_dropoff_location",
        f"dropoff zone id {_FIRST_ZONE} to {_LAST_ZONE}",
        f"dropoff_location_id NOT BETWEEN {_FIRST_ZONE} AND {_LAST_ZONE}",
    ),
    Rule(
        "invalid_payment_type",
        f"payment code is one of {_CODES}",
        f"payment_type NOT IN ({_CODES})",
    ),
)
RULES_BY_NAME = {rule.name: rule for rule in TRIP_RULES}


def trip_outlier() -> Column:
    """Implausibly long in miles or time; unknown counts as plausible."""
    duration = whole_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    too_far = F.col("trip_distance") > MAX_PLAUSIBLE_MILES
    return F.coalesce(too_far | (duration > MAX_PLAUSIBLE_SECONDS), F.lit(False))


@dataclass(frozen=True)
class QualityProfile:
    """What classification needs to know about a table; the trip preset is ``TRIPS``."""

    rules: tuple[Rule, ...] = TRIP_RULES
    required: tuple[str, ...] = REQUIRED
    critical: tuple[str, ...] = CRITICAL
    ranges: tuple[str, ...] = RANGE_REPORTED
    outlier: Callable[[], Column] = trip_outlier

    def missing(self) -> Column:
        return any_null(self.critical)

    def broken(self) -> Column:
        return F.expr(" or ".join(rule.flag for rule in self.rules))

    def reasons(self) -> Column:
        """Names of the broken rules in rule order, joined with ', '."""
        named = ", ".join(f"if({rule.predicate}, '{rule.name}', null)" for rule in self.rules)
        return F.expr(f"concat_ws(', ', {named})")


def any_null(columns: tuple[str, ...] | list[str]) -> Column:
    return F.expr(" or ".join(f"`{c}` is null" for c in columns))


TRIPS = QualityProfile()
