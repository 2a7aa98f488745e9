"""Planned source files, and what has landed of them: sizes, checksums, row counts."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripmill.functions.calendar import months_between_dates
from tripmill.plans.history import folder_of
from tripmill.settings import Settings
from tripmill.sources import blocks
from tripmill.sources.trips import read_parquet_relaxed

LISTING_SCHEMA = "path string, file_size bigint, modified_at timestamp"

# Where the files of a source lie (year, month) and how its URL asks for hours.
TRIPS_KEY = "raw/taxi_trips/year=%1$s/month=%2$s/yellow_tripdata_%1$s-%2$s.parquet"
ZONES_KEY = "raw/taxi_zones/taxi_zone_lookup.csv"
WEATHER_KEY = "raw/weather/year=%1$s/month=%2$s/weather_%1$s-%2$s.json"
WEATHER_VARIABLES = "temperature_2m%2Cprecipitation%2Cwind_speed_10m%2Cweather_code"
WEATHER_ZONE = "America%2FNew_York"


def planned_sources(months: DataFrame, settings: Settings) -> DataFrame:
    """One row per file a range of months needs: trips and weather per month, zones once.

    ``months`` has ``month_start``, ``month_end`` and ``partition_date`` ('YYYY-MM').
    """
    key = F.col("partition_date")
    year, month = F.substring(key, 1, 4), F.substring(key, 6, 2)
    position = f"latitude={settings.weather_latitude}&longitude={settings.weather_longitude}"
    monthly = {
        "taxi_trips": (F.format_string(settings.trips_url, key), TRIPS_KEY),
        "weather": (
            F.concat(
                F.lit(f"{settings.weather_url}?{position}&start_date="),
                F.date_format("month_start", "yyyy-MM-dd"),
                F.lit("&end_date="),
                F.date_format("month_end", "yyyy-MM-dd"),
                F.lit(f"&hourly={WEATHER_VARIABLES}&timezone={WEATHER_ZONE}"),
            ),
            WEATHER_KEY,
        ),
    }
    files = [
        F.struct(
            F.lit(name).alias("source_name"),
            key.alias("partition_date"),
            url.alias("source_url"),
            F.format_string(path, year, month).alias("file_path"),
        )
        for name, (url, path) in monthly.items()
    ]
    zones = months.agg(F.count(F.lit(1))).select(
        F.lit("taxi_zones").alias("source_name"),
        F.lit("").alias("partition_date"),
        F.lit(settings.zones_url).alias("source_url"),
        F.lit(ZONES_KEY).alias("file_path"),
    )
    return months.select(F.inline(F.array(*files))).unionByName(zones)


def plan(spark: SparkSession, start: date, end: date, settings: Settings) -> DataFrame:
    return planned_sources(months_between_dates(spark, start, end), settings)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Every file below a folder with size and time; contents are not read."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob)
            .load(root)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    return files.select(
        "path",
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"),
    )


def stored_bytes(listing: DataFrame) -> DataFrame:
    return listing.agg(F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"))


def relative_to(path: Column, root: str) -> Column:
    """Part of a listed path below ``root`` (which may lack the scheme)."""
    return F.substring_index(path, root.rstrip("/") + "/", -1)


def file_checksums(spark: SparkSession, *paths: str) -> DataFrame:
    """SHA-256 and size of files of any size; each is hashed by one task, block by block.

    Files of a scheme that tasks cannot open come whole from Spark's reader, which takes less than 2 GB.
    Spark's listing leaves out empty files; they have no row.
    """
    files = spark.read.format("binaryFile").load(list(paths))
    ours = blocks.in_tasks(F.col("_metadata.file_path"))  # chooses files where they are listed
    whole = files.where(~ours).select(
        "path", F.sha2("content", 256).alias("checksum"), F.col("length").alias("file_size")
    )
    return blocks.digests(files.where(ours)).unionByName(whole)


def text_rows(document: Column) -> Column:
    """Rows of a JSON text: hours of a weather document, else list length, else 1."""
    hours = F.json_array_length(F.get_json_object(document, "$.hourly.time"))
    listed = F.json_array_length(document)
    return F.when(hours > 0, hours).otherwise(F.coalesce(listed, F.lit(1))).cast("bigint")


def file_rows(spark: SparkSession, kind: str, *paths: str) -> DataFrame:
    """Rows per file (``path``, ``row_count``) of parquet, csv or json files."""
    if kind == "json":
        documents = spark.read.text(list(paths), wholetext=True)
        return documents.select(
            F.col("_metadata.file_path").alias("path"), text_rows(F.col("value")).alias("row_count")
        )
    if kind == "parquet":
        rows = spark.read.parquet(*paths)
    elif kind == "csv":
        rows = spark.read.option("header", True).csv(list(paths))
    else:
        raise ValueError(f"Unsupported format: {kind}")
    counted = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    # Files without rows do not show up in a scan; the listing keeps them with 0.
    listed = spark.read.format("binaryFile").load(list(paths)).select("path")
    return listed.join(counted, "path", "left").select(
        "path", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )


_FORMATS = {"taxi_trips": "parquet", "taxi_zones": "csv", "weather": "json"}


def planned_folders(planned: DataFrame) -> DataFrame:
    """Distinct (source_name, folder) of planned sources: a few per month."""
    return planned.select("source_name", folder_of(F.col("file_path")).alias("folder")).distinct()


def list_planned(spark: SparkSession, planned: DataFrame, settings: Settings) -> DataFrame:
    """folder, path and file_size of the files in the folders of planned sources only."""
    folders = [row.folder for row in planned_folders(planned).collect()]
    listing = list_files(spark, f"{settings.root.rstrip('/')}/{{{','.join(sorted(folders))}}}")
    folder = folder_of(relative_to(F.col("path"), settings.root))
    return listing.select(folder.alias("folder"), "path", "file_size")


def _digest(rows: list[Column]) -> Column:
    """An order-independent digest of a group's rows."""
    row = F.xxhash64(*rows)
    return F.lower(F.concat(F.hex(F.bit_xor(row)), F.hex(F.bit_xor(F.xxhash64(F.lit(1), row)))))


def folder_contents(spark: SparkSession, kind: str, root: str, folders: list[str]) -> DataFrame:
    """folder (below the root), row_count and checksum of tables or documents, from one pass over them.

    Rows are digested where they are read and in any order, so files may be of any size and number.
    """
    folder = relative_to(folder_of(F.col("_metadata.file_path")), root)
    wanted = f"{root.rstrip('/')}/{{{','.join(sorted(folders))}}}"
    if kind == "json":
        documents = spark.read.text(wanted, wholetext=True)
        found = documents.select(folder.alias("folder"), text_rows(F.col("value")).alias("n"), "value")
        digest = _digest([F.col("value")])
        return found.groupBy("folder").agg(F.sum("n").alias("row_count"), digest.alias("checksum"))
    if kind == "parquet":
        rows = read_parquet_relaxed(spark, wanted, "No files")
    else:
        rows = spark.read.option("header", True).csv(wanted)
    columns = [F.col(f"`{c}`") for c in rows.columns if c not in ("year", "month")]
    return rows.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("row_count"), _digest(columns).alias("checksum")
    )


def landed_records(spark: SparkSession, planned: DataFrame, settings: Settings) -> DataFrame:
    """Manifest rows of the planned sources as found below the raw folder.

    A month may have landed as several part files: sizes and rows are those of the folder, and
    the checksum digests its rows. A source without any landed file is recorded as failed.
    """
    wanted = planned.withColumn("folder", folder_of(F.col("file_path")))
    listing = list_planned(spark, planned, settings)
    sizes = listing.groupBy("folder").agg(F.sum("file_size").alias("file_size"))
    there = sizes.join(planned_folders(planned), "folder").select("source_name", "folder").collect()
    contents = spark.createDataFrame([], "folder string, row_count bigint, checksum string")
    for source, kind in _FORMATS.items():
        folders = [r.folder for r in there if r.source_name == source]
        if folders:
            contents = contents.unionByName(folder_contents(spark, kind, settings.root, folders))
    # Files without rows do not show up in a scan; they count 0 rows.
    found = sizes.join(contents, "folder", "left")
    empty = F.coalesce("row_count", F.lit(0))
    found = found.select("folder", "file_size", empty.alias("row_count"), "checksum")
    records = wanted.join(found, "folder", "left")
    return records.select(
        "source_name",
        "source_url",
        "partition_date",
        F.current_timestamp().alias("downloaded_at"),
        "file_path",
        "file_size",
        "checksum",
        "row_count",
        F.when(F.col("row_count").isNull(), "failed").otherwise("success").alias("status"),
    )
