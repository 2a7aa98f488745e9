"""Serving tables: snapshots of the marts and the pointer to the one that readers see.

A publication writes tables of its own, ``<mart>__<version>``. Once all of them are there, one
record appended to the log of publications makes them what ``serving_marts`` resolves. So a
reader never gets marts of two publications, and a job that dies between two tables leaves the
former set in place. A reader keeps its set while newer ones come, until ``keep`` of them have.

For SQL, a view named like the mart selects from the newest tables. Views are replaced one
after the other; whoever needs marts that belong together takes ``serving_marts``.
"""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmill.errors import MissingPartitionError
from tripmill.plans.history import append_log, read_log
from tripmill.plans.marts import Marts, mart_row_counts

PUBLICATIONS_SCHEMA = "version string, published_at timestamp, row_counts map<string, bigint>"
KEEP = 3
NAMES = tuple(Marts.__dataclass_fields__)


def _log_path(spark: SparkSession, database: str) -> str:
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/publications"


def publications(spark: SparkSession, database: str) -> DataFrame:
    """version, published_at and row_counts of all publications, the newest first."""
    log = read_log(spark, _log_path(spark, database), PUBLICATIONS_SCHEMA)
    return log.orderBy(F.desc("published_at"), F.desc("version"))


def _tables(spark: SparkSession, database: str, version: str) -> Marts:
    return Marts(**{name: spark.table(f"{database}.{name}__{version}") for name in NAMES})


def serving_marts(spark: SparkSession, database: str, version: str | None = None) -> Marts:
    """The marts of one publication: the newest, or the one named by ``version``."""
    if version is None:
        newest = publications(spark, database).first()
        if newest is None:
            raise MissingPartitionError(f"Nothing is published in {database}")
        version = newest.version
    return _tables(spark, database, version)


def load_marts(
    marts: Marts, database: str, location: str | None = None, keep: int = KEEP
) -> dict[str, int]:
    """Publish the marts as a new snapshot; returns the rows of each loaded table.

    A new database is kept at ``location``, which all executors must reach. Of older
    publications ``keep - 1`` stay readable.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    spark = marts.dim_zones.sparkSession
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    started = datetime.now(timezone.utc)
    version = f"{started:%Y%m%d%H%M%S%f}_{uuid4().hex[:8]}"
    for name, mart in marts.items().items():
        mart.write.saveAsTable(f"{database}.{name}__{version}")
    loaded = mart_row_counts(_tables(spark, database, version)).collect()
    counts = {row.mart: row.rows for row in loaded}
    record = [(version, datetime.now(timezone.utc), counts)]
    append_log(
        spark.createDataFrame(record, PUBLICATIONS_SCHEMA).coalesce(1), _log_path(spark, database)
    )
    _show(spark, database, version)
    retire(spark, database, keep)
    return counts


def _show(spark: SparkSession, database: str, version: str) -> None:
    """Point the views at a publication; a table that stood under a mart's name gives way."""
    for name in NAMES:
        view = f"{database}.{name}"
        if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
            spark.sql(f"DROP TABLE {view}")
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {database}.{name}__{version}")


def retire(spark: SparkSession, database: str, keep: int = KEEP) -> list[str]:
    """Drop tables older than the newest ``keep`` publications, failed ones among them.

    Tables of a publication that is under way are newer and stay. Returns what was dropped.
    """
    kept = [row.version for row in publications(spark, database).limit(keep).collect()]
    if len(kept) < keep:
        return []
    oldest = min(kept)
    dropped = []
    for row in spark.sql(f"SHOW TABLES IN {database} LIKE '*__*'").collect():  # a few per publication
        name, _, version = row.tableName.rpartition("__")
        if name in NAMES and version < oldest:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{row.tableName}")
            dropped.append(row.tableName)
    return dropped
