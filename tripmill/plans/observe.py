"""Metrics and alerts over the run history and the manifest, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripmill.functions.calendar import next_month
from tripmill.plans.history import rows_per_source
from tripmill.sources.trips import union_by_name

# Metric name, comparison, limit, alert, severity.
METRIC_RULES = (
    ("last_partition_status", "=", 0.0, "PipelineFailure", "critical"),
    ("rows_transformed", "=", 0.0, "NoDataReceived", "critical"),
    ("job_failures", ">", 3.0, "HighJobFailureRate", "warning"),
    ("run_duration_seconds", ">", 3600.0, "SlowPipeline", "warning"),
)

# Texts of the alerts.
NO_RUNS = "No pipeline runs recorded."
RUN_FAILED = "Partition %s failed: %s"
NO_SUCCESS = "No successful runs recorded."
NO_ROWS = "Latest run produced 0 rows."
ROWS_CHANGED = "Input rows changed %.1fx between partitions %s and %s."
RUN_SLOW = "Latest run took %.0fs (>%.0fs)."
MONTH_GAP = "Gap in processed partitions between %s and %s."


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds with fractions between two times; null while a run has no end."""
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("double")


def _epoch(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def _newest(runs: DataFrame, count: int) -> DataFrame:
    """The newest runs by start, best first; each task keeps ``count`` rows."""
    order = [F.col("started_at").desc_nulls_last(), F.col("run_id").desc()]
    return runs.orderBy(*order).limit(count)


def run_metrics(runs: DataFrame, manifest: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Rows of (metric, label, value); metrics that do not apply are left out.

    ``stored`` is an optional one-row frame with the stored ``bytes``.
    """
    no_label = F.lit(None).cast("string")
    succeeded = F.col("status") == "success"
    produced = F.coalesce("output_rows", F.lit(0))
    taken = F.coalesce("input_rows", F.lit(0))
    measures = [
        ("last_partition_status", no_label, succeeded.cast("double")),
        ("current_partition", F.col("partition_date"), F.lit(1.0)),
        (
            "run_duration_seconds",
            no_label,
            elapsed_seconds(F.col("started_at"), F.col("completed_at")),
        ),
        ("rows_transformed", no_label, F.when(succeeded, produced).cast("double")),
        ("rows_rejected", no_label, F.when(succeeded, taken - produced).cast("double")),
        ("last_success_timestamp", no_label, F.when(succeeded, _epoch(F.col("completed_at")))),
    ]
    entries = F.array(
        *(
            F.struct(F.lit(m).alias("metric"), label.alias("label"), value.alias("value"))
            for m, label, value in measures
        )
    )
    of_newest = _newest(runs, 1).select(F.inline(entries)).where("value is not null")
    failures = runs.agg(F.count_if(F.col("status") == "failed").cast("double").alias("value"))
    parts = [
        rows_per_source(manifest).select(
            F.lit("rows_ingested").alias("metric"),
            F.col("source_name").alias("label"),
            F.col("row_count").cast("double").alias("value"),
        ),
        failures.select(F.lit("job_failures").alias("metric"), no_label.alias("label"), "value"),
        of_newest,
    ]
    if stored is not None:
        parts.append(
            stored.select(
                F.lit("storage_bytes").alias("metric"),
                no_label.alias("label"),
                F.col("bytes").cast("double").alias("value"),
            )
        )
    return union_by_name(parts)


def metric_rules(metrics: DataFrame) -> DataFrame:
    """Rules that fire on the metric rows."""
    fired = [
        metrics.where(
            (F.col("metric") == metric)
            & ((F.col("value") > limit) if comparison == ">" else (F.col("value") == limit))
        ).select(
            F.lit(alert).alias("alert"), F.lit(severity).alias("severity"), "metric", "value"
        )
        for metric, comparison, limit, alert, severity in METRIC_RULES
    ]
    return union_by_name(fired)


def row_count_change(runs: DataFrame) -> DataFrame:
    """The two newest successful runs side by side with the ratio of their input rows.

    No row when there are fewer than two, or when the earlier one has no input rows.
    """
    newest = _newest(runs.where("status = 'success'"), 2)
    # Two rows at most, so one window partition is enough.
    order = Window.orderBy(F.col("started_at").asc_nulls_first(), F.col("run_id").asc())
    paired = newest.select(
        F.lag("partition_date").over(order).alias("previous_partition"),
        F.lag("input_rows").over(order).alias("previous_rows"),
        F.col("partition_date").alias("last_partition"),
        F.coalesce("input_rows", F.lit(0)).cast("bigint").alias("last_rows"),
    ).where("previous_rows <> 0")
    return paired.withColumn("ratio", F.col("last_rows") / F.col("previous_rows"))


def missing_partitions(runs: DataFrame, first_only: bool = False) -> DataFrame:
    """Neighbouring successful months that are not one month apart."""
    months = runs.where("status = 'success' and partition_date is not null")
    # Distinct months before the window: its one partition is bounded by the calendar.
    order = Window.orderBy("partition_date")
    pairs = months.select("partition_date").distinct().select(
        F.col("partition_date").alias("before_gap"),
        F.lead("partition_date").over(order).alias("after_gap"),
    )
    gaps = pairs.where("after_gap is not null").where(
        F.col("after_gap") != next_month(F.col("before_gap"))
    )
    return gaps.orderBy("before_gap").limit(1) if first_only else gaps


def alerts(runs: DataFrame, row_ratio: float = 2.0, max_seconds: float = 3600.0) -> DataFrame:
    """Rows of (name, severity, message); none when all is well."""

    def alert(rows: DataFrame, name: str, severity: str, message: Column) -> DataFrame:
        return rows.select(
            F.lit(name).alias("name"), F.lit(severity).alias("severity"), message.alias("message")
        )

    totals = runs.agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "success").alias("successes"),
    )
    newest = _newest(runs, 1)
    last_success = _newest(runs.where("status = 'success'"), 1)
    seconds = elapsed_seconds(F.col("started_at"), F.col("completed_at"))
    change = row_count_change(runs).where(
        (F.col("ratio") > row_ratio) | (F.col("ratio") < 1 / row_ratio)
    )
    found = [
        alert(
            newest.where("status = 'failed'"),
            "pipeline_failure",
            "critical",
            F.format_string(
                RUN_FAILED,
                F.col("partition_date"),
                F.coalesce("error_message", F.lit("None")),
            ),
        ),
        alert(
            totals.where("successes = 0"),
            "no_data",
            "critical",
            F.when(F.col("runs") == 0, NO_RUNS).otherwise(NO_SUCCESS),
        ),
        alert(
            last_success.where(F.coalesce("output_rows", F.lit(0)) == 0),
            "no_data",
            "critical",
            F.lit(NO_ROWS),
        ),
        alert(
            change,
            "row_count_change",
            "warning",
            F.format_string(
                ROWS_CHANGED,
                F.col("ratio"),
                F.col("previous_partition"),
                F.col("last_partition"),
            ),
        ),
        alert(
            last_success.where(seconds > max_seconds),
            "excessive_duration",
            "warning",
            F.format_string(RUN_SLOW, seconds, F.lit(float(max_seconds))),
        ),
        alert(
            missing_partitions(runs, first_only=True),
            "missing_partition",
            "warning",
            F.format_string(
                MONTH_GAP,
                F.col("before_gap"),
                F.col("after_gap"),
            ),
        ),
    ]
    return union_by_name(found)
