"""Commit records: what the steps wrote, by table and month.

A step writes the folder of a month and then appends a record of it: rows, a checksum of their
content, the schema, the dates, the files and their bytes. So whoever comes next compares
contents and not runs, reads a month that has no rows, and needs neither the footers of all
files for a schema nor a listing of all folders for their size.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from tripmill.errors import MissingPartitionError
from tripmill.functions.digest import rows_checksum
from tripmill.operators.latest import latest_per_key
from tripmill.plans.history import append_log, read_log, utc_now
from tripmill.schema import COMMIT_LOG_SCHEMA
from tripmill.sources.landed import list_files
from tripmill.sources.trips import read_parquet


def latest_commits(log: DataFrame) -> DataFrame:
    """The newest record of every table and month."""
    return latest_per_key(log, ["table_name", "partition_date"], ["committed_at", "commit_id"])


def merged_schema(schemas: list[StructType]) -> StructType:
    """All columns by name, in the order in which they first come up."""
    fields = {}
    for field in (f for schema in schemas for f in schema.fields):
        known = fields.setdefault(field.name, field)
        if known.dataType != field.dataType:
            raise ValueError(f"{field.name} is {known.dataType.simpleString()} and {field.dataType.simpleString()}")
    return StructType(list(fields.values()))


def schema_of(text: str) -> StructType:
    return StructType.fromJson(json.loads(text))


def stored_bytes(commits: DataFrame, manifest: DataFrame) -> DataFrame:
    """Bytes of what the newest commits and ingestions hold; no folder is listed."""
    held = commits.select(F.col("byte_count").alias("size"))
    held = held.unionByName(manifest.select(F.col("file_size").alias("size")))
    return held.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def commits(self) -> DataFrame:
        return latest_commits(read_log(self.spark, self.path, COMMIT_LOG_SCHEMA))

    def record(
        self,
        table: str,
        partition: str,
        folder: str,
        schema: StructType,
        date_column: str | None = None,
        totals: list[Column] | None = None,
    ) -> Row:
        """Record what ``folder`` now holds for a month; returns the record with ``totals`` added.

        Everything is measured in one pass over what was written. ``date_column`` adds the
        distinct dates of the month's rows.
        """
        rows = read_parquet(self.spark, folder, f"{folder} was not written", schema)
        day = F.date_format(date_column, "yyyy-MM-dd") if date_column else F.lit(None).cast("string")
        measured = rows.agg(
            F.count(F.lit(1)).alias("row_count"),
            rows_checksum([F.col(f"`{c}`") for c in sorted(rows.columns)]).alias("checksum"),
            F.sort_array(F.collect_set(day)).alias("dates"),
            *(totals or []),
        )
        files = list_files(self.spark, folder, "*.parquet").agg(
            F.count(F.lit(1)).alias("file_count"),
            F.coalesce(F.sum("file_size"), F.lit(0)).alias("byte_count"),
        )
        found = measured.crossJoin(files).first()  # one row each
        record = {
            "table_name": table,
            "partition_date": partition,
            "commit_id": uuid4().hex,
            "table_schema": schema.json(),
            "committed_at": utc_now(),
            **found.asDict(),
        }
        names = [part.split()[0] for part in COMMIT_LOG_SCHEMA.split(", ")]
        one = self.spark.createDataFrame([tuple(record[n] for n in names)], COMMIT_LOG_SCHEMA)
        append_log(one.coalesce(1), self.path)
        return Row(**record)

    def find(self, table: str, partition: str) -> Row | None:
        log = read_log(self.spark, self.path, COMMIT_LOG_SCHEMA)
        own = log.where((F.col("table_name") == table) & (F.col("partition_date") == partition))
        return own.sort(F.desc("committed_at"), F.desc("commit_id")).limit(1).first()

    def months(self, table: str) -> list[str]:
        """Months that a table holds, with rows or without."""
        rows = self.commits().where(F.col("table_name") == table).select("partition_date").collect()
        return sorted(row.partition_date for row in rows)

    def schema(self, table: str, partition: str | None = None) -> StructType:
        """The recorded schema of a month, or the merged one of all months."""
        own = self.commits().where(F.col("table_name") == table)
        if partition:
            own = own.where(F.col("partition_date") == partition)
        seen = own.groupBy("table_schema").agg(F.min("partition_date").alias("first"))
        known = [row.table_schema for row in seen.orderBy("first").collect()]  # one per version
        if not known:
            raise MissingPartitionError(f"No data in {table}" + (f" for {partition}" if partition else ""))
        return merged_schema([schema_of(text) for text in known])
