"""Run history and ingestion manifest: append-only logs and their latest-row views.

A record is never updated in place. A job appends the new state of a run or source, readers
take the latest row per key, and ``compact`` rewrites a grown log into a new folder.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripmill.operators.joins import null_safe_lookup
from tripmill.operators.latest import latest_per_key
from tripmill.schema import MANIFEST_SCHEMA, RUN_LOG_SCHEMA

MANIFEST_KEYS = ["source_name", "partition_date"]


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The log at ``path``; empty before the first append."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_log(records: DataFrame, path: str) -> None:
    records.write.mode("append").parquet(path)


def _one_row(spark: SparkSession, schema: str, fields: dict) -> DataFrame:
    columns = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(fields.get(c) for c in columns)], schema).coalesce(1)


def compact(latest: DataFrame, target: str) -> None:
    """Write the current view of a log to a new folder in few files."""
    latest.hint("rebalance").write.mode("errorifexists").parquet(target)


# Runs


def latest_runs(log: DataFrame) -> DataFrame:
    """One row per run: its last recorded state (a final state beats ``running`` on a tie)."""
    ranked = log.withColumn("_final", F.col("status") != "running")
    return latest_per_key(ranked, ["run_id"], ["recorded_at", "_final"]).drop("_final")


def list_runs(
    runs: DataFrame, pipeline_name: str | None = None, limit: int | None = None
) -> DataFrame:
    """Runs, newest start first."""
    if pipeline_name is not None:
        runs = runs.where(F.col("pipeline_name") == pipeline_name)
    ordered = runs.orderBy(F.col("started_at").desc_nulls_last(), F.col("run_id").desc())
    return ordered if limit is None else ordered.limit(limit)


def latest_run_per_partition(runs: DataFrame) -> DataFrame:
    return latest_per_key(runs, ["pipeline_name", "partition_date"], ["started_at", "run_id"])


def completed_partitions(runs: DataFrame) -> DataFrame:
    """Partitions whose latest run succeeded (an older success does not count)."""
    done = latest_run_per_partition(runs).where("status = 'success'")
    return done.select("pipeline_name", "partition_date")


def pending_partitions(planned: DataFrame, runs: DataFrame, pipeline_name: str) -> DataFrame:
    """Planned ``partition_date`` values that are not completed."""
    done = completed_partitions(runs).where(F.col("pipeline_name") == pipeline_name)
    return planned.join(done.select("partition_date"), ["partition_date"], "left_anti")


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest successful run, or the newest run when none succeeded."""
    succeeded = (F.col("status") == "success").cast("int")
    newest = F.col("started_at").desc_nulls_last()
    return runs.orderBy(succeeded.desc_nulls_last(), newest, F.col("run_id").desc()).limit(1)


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def record(self, **fields) -> None:
        append_log(_one_row(self.spark, RUN_LOG_SCHEMA, {"recorded_at": utc_now(), **fields}), self.path)

    def runs(self) -> DataFrame:
        return latest_runs(read_log(self.spark, self.path, RUN_LOG_SCHEMA))

    def is_complete(self, pipeline_name: str, partition: str) -> bool:
        done = completed_partitions(self.runs())
        return not null_safe_lookup(
            done, pipeline_name=pipeline_name, partition_date=partition
        ).isEmpty()


# Ingestion manifest


def latest_ingestions(log: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """One row per source and partition; a missing partition is stored as ''."""
    keyed = log.withColumn("partition_date", F.coalesce("partition_date", F.lit("")))
    return latest_per_key(keyed, MANIFEST_KEYS, ["downloaded_at", *(tie_break or [])])


def manifest_lookup(manifest: DataFrame, source: str, partition: str | None) -> DataFrame:
    return null_safe_lookup(manifest, source_name=source, partition_date=partition or "")


def list_ingestions(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy("source_name", "partition_date")


def folder_of(file_path: Column) -> Column:
    return F.regexp_extract(file_path, "^(.*)/[^/]+$", 1)


def pending_ingests(planned: DataFrame, manifest: DataFrame, folders: DataFrame) -> DataFrame:
    """Planned sources that are not recorded as success with what their folder now holds.

    ``folders`` has ``folder`` and the total ``file_size`` of the files in it: a month may land
    in one file or several, under any name, and a part that lands late makes it pending again.
    """
    recorded = manifest.where("status = 'success'").select(*MANIFEST_KEYS, "file_size")
    held = planned.select(*MANIFEST_KEYS, folder_of(F.col("file_path")).alias("folder"))
    held = held.join(folders.select("folder", "file_size"), ["folder"])
    ingested = held.join(recorded, [*MANIFEST_KEYS, "file_size"], "left_semi").select(*MANIFEST_KEYS)
    return planned.join(ingested, MANIFEST_KEYS, "left_anti")


class ManifestLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def record(self, **fields) -> None:
        append_log(_one_row(self.spark, MANIFEST_SCHEMA, {"downloaded_at": utc_now(), **fields}), self.path)

    def ingestions(self) -> DataFrame:
        return latest_ingestions(read_log(self.spark, self.path, MANIFEST_SCHEMA))


def rows_per_source(manifest: DataFrame) -> DataFrame:
    succeeded = manifest.where("status = 'success'")
    return succeeded.groupBy("source_name").agg(
        F.sum(F.coalesce("row_count", F.lit(0))).alias("row_count")
    )


def ingest_summary(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(~F.col("status").eqNullSafe("success")).alias("failed"),
    )
