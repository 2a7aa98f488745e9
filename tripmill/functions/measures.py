"""Sums and averages of doubles that do not depend on row order.

A plain double sum changes in its last bits with the order in which tasks finish, so a
retried stage or another partitioning yields another mart. Here a value is split into whole
units of 10**-DIGITS and the rest. The units go, as two limbs, into 64-bit sums that are
exact: a group holds some 10**12 rows of 10**5 before a limb could overflow. The rest, which is
0.0 for any amount of at most DIGITS decimals, is added as a double, so nothing is cut off.
Values of LARGE or more, NaN and infinities are added as doubles as a whole.

The parts of a sum are additive themselves: a table can keep them and be merged later.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DIGITS = 5
LIMB = 1 << 20
LARGE = 1e10
PARTS = ("high", "low", "rest", "n")


def sum_parts(value: Column) -> dict[str, Column]:
    """Aggregates that make up the sum of a column; ``n`` counts its values."""
    value = value.cast("double")
    unit = F.lit(float(10**DIGITS))
    small = F.abs(value) < F.lit(LARGE)
    units = F.floor(F.when(small, value) * unit + 0.5)
    high = F.floor(units / F.lit(float(LIMB)))
    return {
        "high": F.sum(high),
        "low": F.sum(units - high * F.lit(LIMB)),
        "rest": F.sum(F.when(small, value - units / unit).otherwise(value)),
        "n": F.count(value),
    }


def merged_parts(prefix: str) -> dict[str, Column]:
    """The same aggregates from columns that hold parts, ``<prefix>_<part>``."""
    return {part: F.sum(f"{prefix}_{part}") for part in PARTS}


def sum_of(parts: dict[str, Column]) -> Column:
    """The sum; null when there were no values."""
    units = parts["high"].cast("decimal(20,0)") * F.lit(LIMB).cast("decimal(10,0)")
    units = units + parts["low"].cast("decimal(20,0)")
    exact = (units / F.lit(10**DIGITS).cast("decimal(10,0)")).cast("double")
    return F.coalesce(exact, F.lit(0.0)) + parts["rest"]


def mean_of(parts: dict[str, Column]) -> Column:
    """The mean of the non-null values; null when there are none."""
    return sum_of(parts) / F.nullif(parts["n"], F.lit(0))


def stable_sum(value: Column) -> Column:
    return sum_of(sum_parts(value))


def stable_avg(value: Column) -> Column:
    return mean_of(sum_parts(value))


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0.0 when whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
