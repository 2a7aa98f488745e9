"""Hourly weather: JSON documents of parallel arrays, one document per month."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripmill.errors import MissingPartitionError
from tripmill.functions.calendar import hour_start
from tripmill.functions.labels import weather_label
from tripmill.schema import WEATHER_JSON_SCHEMA

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm[:ss]"


def weather_document(text: Column) -> Column:
    """JSON text -> typed document struct."""
    return F.from_json(text, WEATHER_JSON_SCHEMA)


def parse_weather(documents: DataFrame) -> DataFrame:
    """Documents with an ``hourly`` struct of arrays -> one row per hour."""
    hours = documents.select(
        F.inline(
            F.arrays_zip(
                F.col("hourly.time").alias("time"),
                F.col("hourly.temperature_2m").alias("temperature"),
                F.col("hourly.precipitation").alias("precipitation"),
                F.col("hourly.wind_speed_10m").alias("wind_speed"),
                F.col("hourly.weather_code").alias("weather_code"),
            )
        )
    )
    return hours.select(
        hour_start(F.to_timestamp_ntz("time", F.lit(TIME_FORMAT))).alias("weather_hour"),
        "temperature",
        "precipitation",
        "wind_speed",
        weather_label(F.col("weather_code")).alias("weather_condition"),
    )


def read_weather(spark: SparkSession, *paths: str) -> DataFrame:
    documents = spark.read.schema(WEATHER_JSON_SCHEMA).option("multiLine", True).json(list(paths))
    return parse_weather(documents)


def no_weather(spark: SparkSession) -> DataFrame:
    return parse_weather(spark.createDataFrame([], WEATHER_JSON_SCHEMA))


def read_weather_months(spark: SparkSession, root: str, months: list[str]) -> DataFrame:
    """Weather of the given months ('YYYY-MM'); months without a file are skipped."""
    folders = ",".join(f"year={m[:4]}/month={m[5:7]}" for m in sorted(set(months)))
    documents = spark.read.schema(WEATHER_JSON_SCHEMA).option("multiLine", True)
    try:
        return parse_weather(documents.json(f"{root}/{{{folders}}}"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingPartitionError(f"No weather data for {', '.join(sorted(set(months)))}") from error
