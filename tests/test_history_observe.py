from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tripmill.operators import checks
from tripmill.operators.joins import null_safe_lookup
from tripmill.operators.latest import latest_per_key
from tripmill.plans import history, observe
from tripmill.schema import MANIFEST_SCHEMA, RUN_LOG_SCHEMA

START = datetime(2025, 5, 1, 12, tzinfo=timezone.utc)


def run(order, partition, status, input_rows=None, output_rows=None, error=None, seconds=10.0):
    started = START + timedelta(minutes=order)
    ended = None if status == "running" else started + timedelta(seconds=seconds)
    name = f"{partition}-{status}-{order}"
    return (name, "p", partition, status, started, ended, input_rows, output_rows, error, ended or started)


@pytest.fixture
def make_runs(spark):
    return lambda *rows: spark.createDataFrame(list(rows), RUN_LOG_SCHEMA)


def names(runs, **limits):
    return sorted(r.name for r in observe.alerts(runs, **limits).collect())


def test_no_runs(make_runs):
    rows = observe.alerts(make_runs()).collect()
    assert [(r.name, r.severity, r.message) for r in rows] == [
        ("no_data", "critical", "No pipeline runs recorded.")
    ]


def test_failed_latest_run(make_runs):
    runs = make_runs(run(1, "2025-01", "failed", error="boom"))
    assert names(runs) == ["no_data", "pipeline_failure"]
    messages = {r.message for r in observe.alerts(runs).collect()}
    assert messages == {"Partition 2025-01 failed: boom", "No successful runs recorded."}


def test_zero_output(make_runs):
    assert names(make_runs(run(1, "2025-01", "success", 100, 0))) == ["no_data"]


def test_row_count_change_goes_by_start_time(make_runs):
    runs = make_runs(
        run(1, "2025-02", "success", 1_000_000, 900_000), run(2, "2025-01", "success", 100_000, 90_000)
    )
    assert names(runs) == ["row_count_change"]
    message = observe.alerts(runs).first().message
    assert message == "Input rows changed 0.1x between partitions 2025-02 and 2025-01."


def test_previous_run_without_rows_gives_no_ratio(make_runs):
    runs = make_runs(run(1, "2025-01", "success", 0, 1), run(2, "2025-02", "success", 5, 5))
    assert names(runs) == []


def test_first_gap_only(make_runs):
    months = ("2024-11", "2025-01", "2025-04")
    runs = make_runs(*(run(i, m, "success", 100, 90) for i, m in enumerate(months)))
    assert names(runs) == ["missing_partition"]
    assert observe.alerts(runs).first().message == (
        "Gap in processed partitions between 2024-11 and 2025-01."
    )
    assert observe.missing_partitions(runs).count() == 2


def test_year_end_is_no_gap(make_runs):
    runs = make_runs(run(1, "2024-12", "success", 9, 9), run(2, "2025-01", "success", 9, 9))
    assert names(runs) == []


def test_slow_run(make_runs):
    runs = make_runs(run(1, "2025-01", "success", 100, 90, seconds=3700.4))
    assert names(runs) == ["excessive_duration"]
    assert observe.alerts(runs).first().message == "Latest run took 3700s (>3600s)."
    assert names(runs, max_seconds=4000.0) == []


def test_healthy(make_runs):
    runs = make_runs(
        run(1, "2025-01", "success", 110_000, 99_000), run(2, "2025-02", "success", 100_000, 90_000)
    )
    assert names(runs) == []


def test_run_log_keeps_the_last_state(spark, tmp_path):
    log = history.RunLog(spark, str(tmp_path / "runs"))
    assert log.runs().count() == 0
    assert not log.is_complete("p", "2025-01")
    fields = {"run_id": "r1", "pipeline_name": "p", "partition_date": "2025-01", "started_at": START}
    log.record(**fields, status="running")
    assert [r.status for r in log.runs().collect()] == ["running"]
    log.record(**fields, status="success", completed_at=START, input_rows=100, output_rows=90)
    assert [(r.status, r.output_rows) for r in log.runs().collect()] == [("success", 90)]
    assert log.is_complete("p", "2025-01")
    target = str(tmp_path / "compacted")
    history.compact(log.runs(), target)
    assert spark.read.parquet(target).count() == 1


def test_latest_failure_reopens_a_partition(make_runs):
    runs = make_runs(run(1, "2025-01", "success", 1, 1), run(2, "2025-01", "failed", error="x"))
    assert history.completed_partitions(runs).count() == 0
    planned = runs.select("partition_date").distinct()
    assert history.pending_partitions(planned, runs, "p").count() == 1


def test_latest_run_prefers_a_success(make_runs):
    runs = make_runs(run(1, "2025-01", "success", 1, 1), run(2, "2025-02", "failed"))
    assert history.latest_run(runs).first().partition_date == "2025-01"
    only_failed = make_runs(run(1, "2025-01", "failed"), run(2, "2025-02", "failed"))
    assert history.latest_run(only_failed).first().partition_date == "2025-02"


def test_list_runs_newest_first(make_runs):
    runs = make_runs(*(run(i, f"2025-0{i}", "success", 1, 1) for i in (1, 2, 3)))
    assert [r.partition_date for r in history.list_runs(runs, "p", 2).collect()] == ["2025-03", "2025-02"]
    assert history.list_runs(runs, "other").count() == 0


@pytest.fixture
def manifest_log(spark):
    def row(source, partition, minute, rows, status):
        at = START + timedelta(minutes=minute)
        return (source, "u", partition, at, f"raw/{source}/{partition}", 10, "c", rows, status)

    return spark.createDataFrame(
        [
            row("trips", "2025-01", 1, None, "failed"),
            row("trips", "2025-01", 2, 100, "success"),
            row("trips", "2025-02", 1, 50, "success"),
            row("zones", None, 1, 265, "success"),
            row("weather", "2025-01", 1, None, "failed"),
        ],
        MANIFEST_SCHEMA,
    )


def test_manifest_keeps_the_latest_record(manifest_log):
    manifest = history.latest_ingestions(manifest_log)
    assert manifest.count() == 4
    assert history.manifest_lookup(manifest, "trips", "2025-01").first().row_count == 100
    assert history.manifest_lookup(manifest, "zones", None).first().partition_date == ""
    assert [r.source_name for r in history.list_ingestions(manifest).collect()] == [
        "trips",
        "trips",
        "weather",
        "zones",
    ]
    sums = {r.source_name: r.row_count for r in history.rows_per_source(manifest).collect()}
    assert sums == {"trips": 150, "zones": 265}
    assert tuple(history.ingest_summary(manifest).first()) == (4, 3, 1)


def test_manifest_log_replaces_by_source_and_partition(spark, tmp_path):
    log = history.ManifestLog(spark, str(tmp_path / "manifest"))
    log.record(source_name="trips", partition_date="2025-01", status="failed")
    log.record(source_name="trips", partition_date="2025-01", status="success", row_count=5)
    log.record(source_name="zones", status="success", row_count=4)
    rows = {(r.source_name, r.partition_date): r.status for r in log.ingestions().collect()}
    assert rows == {("trips", "2025-01"): "success", ("zones", ""): "success"}


def test_pending_needs_record_and_file(spark, manifest_log):
    planned = manifest_log.select("source_name", "partition_date", "file_path").dropDuplicates().where(
        "partition_date is not null"
    )
    planned = planned.withColumn("file_path", F.concat("file_path", F.lit("/any-name.parquet")))
    manifest = history.latest_ingestions(manifest_log)
    sizes = manifest.where("partition_date = '2025-01'").select(
        F.concat(F.lit("raw/"), "source_name", F.lit("/2025-01")).alias("folder"), "file_size"
    )
    pending = history.pending_ingests(planned, manifest, sizes)
    assert sorted((r.source_name, r.partition_date) for r in pending.collect()) == [
        ("trips", "2025-02"),
        ("weather", "2025-01"),
    ]


def test_a_folder_that_has_changed_is_pending(spark, manifest_log):
    planned = spark.createDataFrame(
        [("trips", "2025-01", "raw/trips/2025-01/x.parquet")], "source_name string, partition_date string, file_path string"
    )
    manifest = history.latest_ingestions(manifest_log)
    sizes = manifest.where("source_name = 'trips' and partition_date = '2025-01'").select(
        F.lit("raw/trips/2025-01").alias("folder"), "file_size"
    )
    assert history.pending_ingests(planned, manifest, sizes).isEmpty()
    grown = sizes.withColumn("file_size", F.col("file_size") + 1)
    assert history.pending_ingests(planned, manifest, grown).count() == 1


def test_metrics(make_runs, manifest_log, spark):
    runs = make_runs(
        run(1, "2025-01", "failed", error="x"), run(2, "2025-02", "success", 100, 90, seconds=12.5)
    )
    stored = spark.sql("select 77L as bytes")
    rows = observe.run_metrics(runs, history.latest_ingestions(manifest_log), stored).collect()
    found = {(r.metric, r.label): r.value for r in rows}
    assert found[("rows_ingested", "trips")] == 150.0
    assert found[("job_failures", None)] == 1.0
    assert found[("last_partition_status", None)] == 1.0
    assert found[("current_partition", "2025-02")] == 1.0
    assert found[("run_duration_seconds", None)] == 12.5
    assert (found[("rows_transformed", None)], found[("rows_rejected", None)]) == (90.0, 10.0)
    assert found[("storage_bytes", None)] == 77.0
    assert found[("last_success_timestamp", None)] == (START + timedelta(minutes=2, seconds=12.5)).timestamp()


def test_metrics_of_a_failed_latest_run(make_runs, manifest_log):
    runs = make_runs(run(1, "2025-01", "success", 1, 1), run(2, "2025-02", "failed"))
    rows = observe.run_metrics(runs, history.latest_ingestions(manifest_log))
    metrics = {r.metric for r in rows.collect()}
    assert not metrics & {"rows_transformed", "rows_rejected", "last_success_timestamp"}
    assert {r.alert for r in observe.metric_rules(rows).collect()} == {"PipelineFailure"}


def test_latest_row_is_picked_before_the_exchange(spark):
    log = spark.range(0, 1000, 1, 4).selectExpr("id % 3 as k", "id as v")
    latest = latest_per_key(log, ["k"], ["v"])
    assert sorted(r.v for r in latest.collect()) == [997, 998, 999]
    plan = plan_of(latest)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert "WindowGroupLimit" in plan


def test_null_safe_lookup(spark):
    rows = spark.createDataFrame([("a", None), ("a", "x")], "s string, p string")
    assert null_safe_lookup(rows, s="a", p=None).count() == 1


def test_dataset_tests_find_violations(spark):
    rows = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, None), (None, "a"), (None, "a")], "k int, v string"
    )
    assert checks.not_null(rows, "v").count() == 1
    assert [r.k for r in checks.unique(rows, "k").collect()] == [1]
    assert checks.unique_together(rows, ["k", "v"]).count() == 1
    assert [(r.v, r["rows"]) for r in checks.accepted_values(rows, "v", ["a"]).collect()] == [("b", 1)]
    parent = spark.createDataFrame([(2,)], "id int")
    assert [(r.k, r["rows"]) for r in checks.relationships(rows, "k", parent, "id").collect()] == [(1, 2)]
    summary = checks.summary(rows, checks.not_null(rows, "v")).first()
    assert (summary.checked_rows, summary.violations) == (5, 1)
    assert tuple(checks.summary(rows, rows.where("false")).first()) == (5, 0)
