"""Bring a raw trip frame to canonical names and types."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripmill.errors import QualityError
from tripmill.schema import OPTIONAL_TYPES, REQUIRED, REQUIRED_TYPES, TRIP_COLUMN_NAMES


def rename_canonical(trips: DataFrame) -> DataFrame:
    """Rename the known source columns that are present; others ride along."""
    return trips.withColumnsRenamed(TRIP_COLUMN_NAMES)


def require_columns(trips: DataFrame) -> DataFrame:
    absent = [name for name in REQUIRED if name not in trips.columns]
    if absent:
        raise QualityError(f"Missing required columns: {absent}")
    return trips


def cast_types(trips: DataFrame) -> DataFrame:
    """Strict casts of the known columns (ANSI: a value that does not fit raises)."""
    wanted = {**OPTIONAL_TYPES, **REQUIRED_TYPES}
    return trips.select(
        *(F.col(c).cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in trips.columns)
    )


def check_structure(trips: DataFrame) -> DataFrame:
    """Types of the required columns, checked on the plan's schema without running it."""
    for name, expected in REQUIRED_TYPES.items():
        actual = trips.schema[name].dataType
        if actual != expected:
            raise QualityError(
                f"Column {name} has type {actual.simpleString()}, expected {expected.simpleString()}"
            )
    return trips


def canonical_trips(raw: DataFrame) -> DataFrame:
    """Raw columns -> canonical names, required columns present, types cast and checked."""
    return check_structure(cast_types(require_columns(rename_canonical(raw))))
