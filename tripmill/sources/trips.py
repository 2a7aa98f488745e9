"""Trip tables: raw months, validated, staging and curated rows."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tripmill.errors import MissingPartitionError
from tripmill.sources import blocks

_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def union_relaxed(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns; differing types widen to their common type."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_parquet(
    spark: SparkSession, path: str, missing: str, schema: StructType | None = None, **options
) -> DataFrame:
    """A folder of Parquet files; with a known ``schema`` it may hold no file and no footer is read."""
    reader = spark.read.options(**options)
    try:
        return (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            raise MissingPartitionError(missing) from error
        raise


def _condition(error: PySparkException | Py4JJavaError) -> str | None:
    """The error condition; Spark errors of file jobs reach classic sessions as plain JVM errors."""
    if isinstance(error, PySparkException):
        return error.getCondition()
    cause = error.java_exception
    while cause is not None and not hasattr(cause, "getCondition"):
        cause = cause.getCause()
    return cause.getCondition() if cause is not None else None


def read_parquet_relaxed(spark: SparkSession, path: str, missing: str) -> DataFrame:
    """Parquet files of one directory whose column types may differ between files.

    Files that agree are one scan. Only where they disagree (say BIGINT and DOUBLE) the
    files are grouped by schema, one scan per distinct schema, and widened by a union. Either
    way a column that some file lacks is null there.
    """
    try:
        return read_parquet(spark, path, missing, mergeSchema=True)
    except (PySparkException, Py4JJavaError) as error:
        if not str(_condition(error)).startswith("CANNOT_MERGE"):
            raise
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path")
    return union_by_name(
        [
            spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths)
            for paths in _alike(files)
        ]
    )


def _alike(files: DataFrame) -> list[list[str]]:
    """Paths of one directory by schema; their footers are read by tasks, only the paths come back."""
    footer = blocks.footers(files.where(blocks.in_tasks(F.col("path"))))
    # Files of a scheme that tasks cannot open are groups of their own.
    alone = files.where(~blocks.in_tasks(F.col("path"))).withColumn("footer", F.col("path"))
    grouped = footer.unionByName(alone).groupBy("footer").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return sorted(row.paths for row in grouped.select("paths").collect())


def scan_month(spark: SparkSession, root: str, partition: str) -> DataFrame:
    """Raw trips of one 'YYYY-MM' month: only that directory is listed and read."""
    year, month = partition.split("-")
    path = f"{root}/year={year}/month={month}"
    return read_parquet_relaxed(spark, path, f"No raw trip data for {partition}")


def read_validated(
    spark: SparkSession, root: str, partition: str, label: str = "valid", schema: StructType | None = None
) -> DataFrame:
    """One class of one validated month, without the columns only other classes fill."""
    path = f"{root}/partition={partition}"
    rows = read_parquet(spark, path, f"No validated data for {partition}", schema)
    unused = {
        "valid": ("violation_reasons", "quarantine_reason"),
        "invalid": ("quarantine_reason",),
        "quarantined": ("violation_reasons",),
    }[label]
    return rows.where(F.col("class") == label).drop("class", *unused)


def read_dates(
    spark: SparkSession,
    root: str,
    start: date,
    end: date,
    by_source_month: bool = True,
    schema: StructType | None = None,
) -> DataFrame:
    """Trips picked up in [start, end] from ``pickup_date=`` folders.

    Staged and curated trips lie one level below their source month; all source months count.
    Only the folders of the range are listed, dates without a folder are skipped.
    """
    days = [start + timedelta(days=n) for n in range((end - start).days + 1)]
    wanted = ",".join(day.isoformat() for day in days)
    level = "source_month=*/" if by_source_month else ""
    missing = f"No data between {start} and {end} in {root}"
    path = f"{root}/{level}pickup_date={{{wanted}}}"
    merge = schema is None
    rows = read_parquet(spark, path, missing, schema, mergeSchema=merge, basePath=root)
    return rows.drop("source_month")


def read_staged(
    spark: SparkSession, root: str, partition: str, schema: StructType | None = None
) -> DataFrame:
    """All trips that one source month has staged, whatever their dates."""
    path = f"{root}/source_month={partition}"
    return read_parquet(spark, path, f"No trips staged for {partition}", schema)


def read_curated(
    spark: SparkSession, root: str, partition: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """All curated trips, or those of one source month.

    Columns are united by name over the files, unless a recorded ``schema`` names them all.
    """
    path = f"{root}/source_month={partition}" if partition else root
    missing = f"No curated data for {partition}" if partition else "No curated data"
    return read_parquet(spark, path, missing, schema, mergeSchema=schema is None).drop("source_month")
