"""Zone lookup CSV -> zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.schema import ZONES_CSV_SCHEMA


def dim_zones(zones: DataFrame) -> DataFrame:
    renamed = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}
    columns = ("location_id", "borough", "zone", "service_zone")
    return zones.withColumnsRenamed(renamed).select(*columns)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return dim_zones(spark.read.schema(ZONES_CSV_SCHEMA).option("header", True).csv(path))
