"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Naive local times stay naive: every time function used by the library is independent of
# the session zone, UTC only keeps instants in logs readable. AQE coalesces small shuffle
# partitions, splits skewed joins and splits skewed partitions before a write.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The three class folders are written side by side instead of sorting rows by class.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Do not record a Python call site for every column expression (halves plan building).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tripmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
