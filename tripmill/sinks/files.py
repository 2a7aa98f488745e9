"""Parquet and JSON sinks, and the tables of an external serving database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmill.plans.marts import Marts, stg_trips


def write_once(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write a path that must not exist yet, unless it is to be replaced."""
    rows.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def write_outcomes(outcomes: DataFrame, root: str, partition: str) -> str:
    """Replace one validated month: a ``class=`` folder each for valid, invalid, quarantined.

    All classes are written by one job.
    """
    path = f"{root}/partition={partition}"
    outcomes.write.mode("overwrite").partitionBy("class").parquet(path)
    return path


def write_report(report: DataFrame, root: str, partition: str) -> None:
    """One JSON document per month; the report is a single row."""
    report.coalesce(1).write.mode("overwrite").json(f"{root}/partition={partition}")


def write_staging(rows: DataFrame, root: str, partition: str) -> str:
    """Replace what one source month staged: ``source_month=<month>/pickup_date=<date>``.

    A stray trip of another month lands under its own source month and so never wipes a
    date that the other month has staged.
    """
    path = f"{root}/source_month={partition}"
    _by_date(rows).write.mode("overwrite").partitionBy("pickup_date").parquet(path)
    return path


def _by_date(rows: DataFrame) -> DataFrame:
    # Rebalancing puts a date into one partition, and so one file, until it exceeds the
    # advisory partition size; then AQE splits it. A hot date never ends up in one task.
    return _sorted(rows.hint("rebalance", F.col("pickup_date")))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.sortWithinPartitions("pickup_date", "pickup_datetime")


def write_dates(rows: DataFrame, root: str, clustered: bool = False) -> None:
    """Replace exactly the dates present in ``rows``, leaving other ``pickup_date=`` folders.

    ``clustered`` rows come straight from files of one date each: they are not shuffled.
    """
    (
        (_sorted(rows) if clustered else _by_date(rows))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("pickup_date")
        .parquet(root)
    )


def write_month_dates(rows: DataFrame, root: str, partition: str) -> str:
    """Replace all that one source month has in a ``source_month=/pickup_date=`` table.

    The rows come straight from files of one date each and are not shuffled. Dates that the
    month no longer has vanish with its folder.
    """
    path = f"{root}/source_month={partition}"
    _sorted(rows).write.mode("overwrite").partitionBy("pickup_date").parquet(path)
    return path


def write_month(rows: DataFrame, root: str, partition: str) -> str:
    """Replace the rows that one source month adds to a small table."""
    path = f"{root}/source_month={partition}"
    rows.hint("rebalance").write.mode("overwrite").parquet(path)
    return path


def dates_written(rows: DataFrame) -> DataFrame:
    """Distinct pickup dates as sorted ISO strings."""
    days = rows.select(F.date_format("pickup_date", "yyyy-MM-dd").alias("pickup_date"))
    return days.distinct().orderBy("pickup_date")


def write_marts(marts: Marts, root: str) -> None:
    """Replace one Parquet folder per mart."""
    for name, mart in marts.items().items():
        mart.write.mode("overwrite").parquet(f"{root}/{name}")


def read_marts(spark: SparkSession, root: str) -> Marts:
    names = Marts.__dataclass_fields__
    return Marts(**{name: spark.read.parquet(f"{root}/{name}") for name in names})


def staging_view(curated: DataFrame, name: str = "stg_trips") -> None:
    """Register the staging model as a view; nothing is computed."""
    stg_trips(curated).createOrReplaceTempView(name)


def load_marts_jdbc(marts: Marts, url: str, schema: str, **properties: str) -> None:
    """Replace the tables of an external serving database."""
    for name, mart in marts.items().items():
        mart.write.jdbc(url, f"{schema}.{name}", mode="overwrite", properties=properties)


def serving_marts_jdbc(spark: SparkSession, url: str, schema: str, **properties: str) -> Marts:
    names = Marts.__dataclass_fields__
    return Marts(
        **{n: spark.read.jdbc(url, f"{schema}.{n}", properties=properties) for n in names}
    )
