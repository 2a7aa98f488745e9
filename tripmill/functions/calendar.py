"""Calendar columns over naive timestamps.

``date_trunc`` and ``timestampdiff`` go through the session time zone, which moves naive
times around daylight-saving changes; the forms below never leave ``timestamp_ntz``.
"""

from __future__ import annotations

import calendar
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def hour_start(ts: Column) -> Column:
    """Naive timestamp floored to its hour."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))


def hour_number(ts: Column) -> Column:
    """Hours since 1970 of a naive timestamp: an integer key, which joins faster than a time."""
    return F.unix_date(F.to_date(ts)).cast("bigint") * 24 + F.hour(ts)


def whole_seconds(start: Column, end: Column) -> Column:
    """Elapsed whole seconds between two naive timestamps, truncated toward zero."""
    return (end - start).cast("interval second").cast("bigint")


def monday_based_weekday(ts: Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(ts)


def month_key(day: Column) -> Column:
    """'YYYY-MM' of a date or timestamp."""
    return F.date_format(day, "yyyy-MM")


def month_start(key: Column) -> Column:
    """First day of a 'YYYY-MM' key."""
    return F.to_date(F.concat(key, F.lit("-01")), "yyyy-MM-dd")


def next_month(key: Column) -> Column:
    return month_key(F.add_months(month_start(key), 1))


def month_sequence(first: Column, last: Column) -> Column:
    """Array of month starts covering both dates."""
    return F.sequence(
        F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")
    )


def day_sequence(first: Column, last: Column) -> Column:
    return F.sequence(F.to_date(first), F.to_date(last), F.expr("interval 1 day"))


def months_between_dates(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per month in [start, end]: month_start, month_end, partition_date."""
    if end < start:
        raise ValueError("end date is before start date")
    months = spark.range(1).select(
        F.explode(month_sequence(F.lit(start), F.lit(end))).alias("month_start")
    )
    return months.select(
        "month_start",
        F.last_day("month_start").alias("month_end"),
        month_key(F.col("month_start")).alias("partition_date"),
    )


def month_bounds(partition: str) -> tuple[date, date]:
    """First and last day of a 'YYYY-MM' month."""
    year, month = (int(part) for part in partition.split("-"))
    return date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1])
