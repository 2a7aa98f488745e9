"""Joins of a large fact with a dimension, and the hourly weather join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripmill.functions.calendar import hour_number
from tripmill.functions.measures import share
from tripmill.operators.latest import latest_per_key
from tripmill.schema import WEATHER_COLUMNS

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_TEXT_BYTES = 64 * 1024 * 1024
SALTS = 32
HOT_SHARE = 1000


def fits_broadcast(
    dim: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_text_bytes: int = MAX_BROADCAST_TEXT_BYTES,
) -> bool:
    """Measure a dimension by one pass over it that returns a single row."""
    texts = [name for name, kind in dim.dtypes if kind in ("string", "binary")]
    text_bytes = " + ".join(["0L", *(f"coalesce(sum(octet_length(`{c}`)), 0L)" for c in texts)])
    size = dim.agg(
        F.count(F.lit(1)).alias("rows"), F.expr(text_bytes).alias("text_bytes")
    ).first()
    return size["rows"] <= max_rows and size["text_bytes"] <= max_text_bytes


def hot_keys(rows: DataFrame, on: list[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold one row in ``share`` or more; there are at most ``share`` of them."""
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counted.agg(F.sum("_n").alias("_total"))
    held = counted.crossJoin(F.broadcast(total))  # one row
    return held.where(F.col("_n") * share >= F.col("_total")).select(*on)


def dimension_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    fits: bool | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``dim`` to ``fact`` on equally named columns ("left" or "inner").

    A dimension measured to be small is broadcast and the fact is not shuffled. A larger
    one is shuffled; then rows of the fact's hot keys, as counted, are salted by their content
    and only the dimension rows of these keys are sent to every salt.
    """
    if fits is None:
        fits = fits_broadcast(dim)
    if fits:
        return fact.join(F.broadcast(dim), on, how)
    salt, hot = "_salt", "_hot"
    marked = F.broadcast(hot_keys(fact, on).withColumn(hot, F.lit(True)))  # HOT_SHARE keys at most
    content = F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int")
    salted_fact = fact.join(marked, on, "left").withColumn(
        salt, F.when(F.col(hot), content).otherwise(F.lit(0))
    )
    copies = F.when(F.col(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_dim = dim.join(marked, on, "left").withColumn(salt, F.explode(copies)).drop(hot)
    return salted_fact.drop(hot).join(salted_dim, [*on, salt], how).drop(salt)


def role_join(
    fact: DataFrame, dim: DataFrame, key: str, attributes: list[str], roles: dict[str, str]
) -> DataFrame:
    """Left join one dimension once per role, e.g. ``{"pickup": "pickup_location_id"}``.

    Each role adds ``<role>_<attribute>`` columns. The dimension is measured once.
    """
    fits = fits_broadcast(dim.select(key, *attributes))
    for role, fact_key in roles.items():
        view = dim.select(
            F.col(key).alias(fact_key), *(F.col(a).alias(f"{role}_{a}") for a in attributes)
        )
        fact = dimension_join(fact, view, [fact_key], "left", fits)
    return fact


def enrich_hourly(trips: DataFrame, weather: DataFrame, dedupe: bool = False) -> DataFrame:
    """Left join hourly weather on the pickup hour.

    ``weather_joined`` tells whether a temperature is known, not whether an hour matched.
    Two weather rows in one hour double its trips unless ``dedupe`` keeps one per hour.
    """
    hourly = weather.select("weather_hour", *WEATHER_COLUMNS)
    if dedupe:
        hourly = latest_per_key(hourly, ["weather_hour"], list(WEATHER_COLUMNS))
    hour = "_hour"
    keyed = trips.withColumn(hour, hour_number(F.col("pickup_datetime")))
    by_hour = hourly.select(hour_number(F.col("weather_hour")).alias(hour), *WEATHER_COLUMNS)
    joined = dimension_join(keyed, by_hour, [hour])
    return joined.drop(hour).withColumn("weather_joined", F.col("temperature").isNotNull())


def weather_coverage(enriched: DataFrame) -> DataFrame:
    """One row: trips, trips without a temperature and the covered share (0.0 when empty)."""
    counted = enriched.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.col("weather_joined")).alias("unmatched_rows"),
    )
    matched = F.col("total_rows") - F.col("unmatched_rows")
    return counted.withColumn("coverage", share(matched, F.col("total_rows")))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys without a parent, with the number of child rows of each.

    The child is reduced to one row per key before the join, so a hot key joins once.
    """
    keys = parent.select(F.col(parent_key).alias(key))
    counted = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(keys, [key], "left_anti")


def null_safe_lookup(rows: DataFrame, **values) -> DataFrame:
    """Rows whose columns equal the given values, None matching null."""
    for name, value in values.items():
        rows = rows.where(F.col(name).eqNullSafe(F.lit(value)))
    return rows
