from __future__ import annotations

import json
from dataclasses import replace
from datetime import date, datetime

import landing
import pytest
from pyspark.sql import functions as F

from tripmill.errors import IngestError, MissingPartitionError, QualityError
from tripmill.functions.calendar import month_bounds
from tripmill.functions.digest import rows_checksum
from tripmill.operators import checks
from tripmill.plans import history, monthly, serving
from tripmill.plans.commits import CommitLog
from tripmill.plans.marts import build_marts
from tripmill.schema import CRITICAL, CURATED_COLUMNS, STAGING_COLUMNS
from tripmill.settings import Settings
from tripmill.sinks.files import staging_view, write_month_dates
from tripmill.sinks.serving import serving_marts
from tripmill.sources.trips import read_curated, read_dates, read_validated


@pytest.fixture
def settings(tmp_path):
    landing.land_all(tmp_path)
    return Settings(
        root=str(tmp_path),
        max_invalid_ratio=1.0,
        max_null_ratio=1.0,
        serving_database=f"marts_{tmp_path.name.replace('-', '_')}",
    )


def test_range_resolution():
    settings = Settings(root="/x")
    day = date(2025, 1, 15)
    assert monthly.resolve_range(settings, day="2025-01-15") == (day, day)
    assert monthly.resolve_range(settings) == (date(2025, 1, 1), date(2025, 1, 31))
    assert month_bounds("2024-02") == (date(2024, 2, 1), date(2024, 2, 29))
    assert month_bounds("2025-02")[1] == date(2025, 2, 28)


def month_rows(spark, path):
    """All rows of a month-keyed table as strings, sorted."""
    return sorted(map(str, spark.read.parquet(path).collect()))


def state(spark, settings):
    """What the job leaves behind: curated, fact and marts."""
    marts = serving_marts(spark, settings.serving_database).items()
    tables = {name: sorted(map(str, mart.collect())) for name, mart in marts.items()}
    return {**tables, "curated": month_rows(spark, settings.curated), "fact": month_rows(spark, settings.fact)}


def other(settings, tmp_path, name):
    """The same landed files under another root."""
    root = tmp_path / name
    landing.land_all(root)
    return Settings(
        root=str(root), max_invalid_ratio=1.0, max_null_ratio=1.0, serving_database=f"{settings.serving_database}_{name}"
    )


def test_one_month_step_by_step(spark, settings):
    report = monthly.validate_month(spark, settings, "2025-01")
    assert (report.total_rows, report.valid_rows) == (7, 6)
    assert (report.invalid_rows, report.quarantined_rows) == (1, 0)
    saved = spark.read.json(f"{settings.reports}/partition=2025-01").first()
    assert saved.error_categories.negative_fare == 1
    assert saved.null_counts.passenger_count == 1
    assert monthly.normalize_month(spark, settings, "2025-01") == (6, 6)
    coverage = monthly.enrich_range(spark, settings, date(2025, 1, 1), date(2025, 1, 31))
    assert (coverage.total_rows, coverage.unmatched_rows, coverage.coverage) == (6, 0, 1.0)
    curated = read_curated(spark, settings.curated)
    assert checks.absent_columns(curated, CURATED_COLUMNS) == []
    without = curated.drop("wind_speed")
    assert checks.absent_columns(without, STAGING_COLUMNS + ("wind_speed",)) == ["wind_speed"]
    assert set(checks.null_counts(curated, CRITICAL).first()) == {0}
    invalid = read_validated(spark, settings.validated, "2025-01", "invalid")
    assert invalid.first().violation_reasons == "negative_fare"
    assert "quarantine_reason" not in invalid.columns


def test_gate_stops_before_anything_is_written(spark, settings, tmp_path):
    strict = Settings(root=str(tmp_path), max_invalid_ratio=0.1)
    with pytest.raises(QualityError, match="Invalid row ratio 14.29% exceeds 10%"):
        monthly.validate_month(spark, strict, "2025-01")
    assert not (tmp_path / "validated").exists()


def test_full_range(spark, settings):
    results = monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    assert [(r.partition, r.status) for r in results] == [("2025-01", "success"), ("2025-02", "success")]
    assert [(r.input_rows, r.output_rows) for r in results] == [(7, 6), (5, 5)]
    # Stray trips arrive with the month whose file brought them.
    curated = read_curated(spark, settings.curated)
    assert curated.count() == 11
    assert curated.where("temperature is null").isEmpty()
    published = monthly.publish_marts(spark, settings)
    assert published.loaded_rows["dim_zones"] == 4
    assert published.loaded_rows["daily_demand"] == 9
    assert len(published.checks) == 21
    log = history.RunLog(spark, settings.run_log)
    assert log.runs().count() == 2
    assert log.is_complete(settings.pipeline_name, "2025-02")
    assert not log.is_complete(settings.pipeline_name, "2025-03")

    before = state(spark, settings)
    again = monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    assert [r.status for r in again] == ["skipped", "skipped"]
    forced = monthly.backfill(spark, settings, "2025-01-01", "2025-01-31")
    assert [r.status for r in forced] == ["success"]
    assert state(spark, settings) == before
    latest = history.latest_run_per_partition(log.runs())
    assert latest.count() == 2 and log.runs().count() == 3

    marts = serving_marts(spark, settings.serving_database)
    demand = serving.demand(marts, location_id=138).collect()
    assert [(r.trip_count, r.total_revenue) for r in demand] == [(1, 44.0), (2, 81.5)]
    top = serving.top_zones(marts, date(2024, 1, 1), date(2025, 12, 31)).collect()
    assert (top[0].zone, top[0].trips) == ("Mill Yard", 4)


def test_validation_by_digests_is_the_same(spark, settings, tmp_path):
    landing.write_trips(tmp_path, "2025-01", [*landing.january(), *landing.january()[:3]])
    reports, rows = [], []
    for digests in (False, True):
        reports.append(monthly.validate_month(spark, replace(settings, digest_duplicates=digests), "2025-01"))
        rows.append(month_rows(spark, f"{settings.validated}/partition=2025-01"))
    assert reports[0] == reports[1] and reports[0].duplicate_count > 0
    assert rows[0] == rows[1]


def test_order_of_months_makes_no_difference(spark, settings, tmp_path):
    monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    turned = other(settings, tmp_path, "turned")
    monthly.run_range(spark, turned, day="2025-02-10")
    monthly.run_range(spark, turned, day="2025-01-10")
    assert state(spark, turned) == state(spark, settings)


def test_months_left_behind_by_a_failure_are_published_later(spark, settings, tmp_path):
    monthly.run_range(spark, settings, day="2025-01-15")
    with pytest.raises(MissingPartitionError):
        monthly.run_range(spark, settings, start="2025-02-01", end="2025-03-31")
    assert read_curated(spark, settings.curated).count() == 11
    assert spark.read.parquet(settings.fact).count() == 6
    results = monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    assert [r.status for r in results] == ["skipped", "skipped"]
    assert spark.read.parquet(settings.fact).count() == 11
    whole = other(settings, tmp_path, "whole")
    monthly.run_range(spark, whole, start="2025-01-01", end="2025-02-28")
    assert state(spark, whole) == state(spark, settings)


def test_dates_that_a_corrected_feed_lacks_vanish(spark, settings, tmp_path):
    monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    kept = [row for row in landing.january() if row["tpep_pickup_datetime"].day != 9]
    landing.write_trips(tmp_path, "2025-01", kept)
    monthly.backfill(spark, settings, "2025-01-01", "2025-01-31")
    for path in (settings.staging, settings.curated, settings.fact):
        rows = spark.read.parquet(path)
        assert rows.count() == 10 and rows.where("pickup_date = '2025-01-09'").isEmpty()
    daily = serving_marts(spark, settings.serving_database).daily_demand
    assert daily.where("date = '2025-01-09'").isEmpty() and daily.count() == 8


def test_merged_marts_equal_marts_of_the_whole_fact(spark, settings):
    monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    fact = spark.read.parquet(settings.fact)
    stored = serving_marts(spark, settings.serving_database)
    whole = build_marts(fact, stored.dim_zones).items()
    for name, mart in stored.items().items():
        assert sorted(map(str, mart.collect())) == sorted(map(str, whole[name].select(*mart.columns).collect()))


def test_failed_month_is_recorded_and_stops_the_range(spark, settings):
    with pytest.raises(MissingPartitionError):
        monthly.run_range(spark, settings, start="2025-03-01", end="2025-04-30")
    runs = history.RunLog(spark, settings.run_log).runs().collect()
    assert [(r.partition_date, r.status) for r in runs] == [("2025-03", "failed")]
    assert "No raw trip data for 2025-03" in runs[0].error_message


def test_rerun_gives_the_same_result(spark, settings):
    first = monthly.validate_month(spark, settings, "2025-01")
    second = monthly.validate_month(spark, settings, "2025-01")
    assert first == second
    assert read_validated(spark, settings.validated, "2025-01").count() == 6


def test_months_without_data_are_skipped(spark, settings):
    span = (date(2025, 1, 1), date(2025, 3, 31))
    assert sorted(monthly.validate_range(spark, settings, *span)) == ["2025-01", "2025-02"]
    assert monthly.normalize_range(spark, settings, *span) == {"2025-01": (6, 6), "2025-02": (5, 5)}
    assert monthly.enrich_range(spark, settings, *span).total_rows == 11


def test_trips_of_a_month_without_weather_are_curated(spark, tmp_path):
    span = (date(2025, 1, 1), date(2025, 3, 31))
    january_only = Settings(root=str(tmp_path / "january"), max_invalid_ratio=1.0, max_null_ratio=1.0)
    landing.write_trips(tmp_path / "january", "2025-01", landing.january())
    landing.write_trips(tmp_path / "january", "2025-02", [row for row in landing.february() if row["tpep_pickup_datetime"].month == 2])
    monthly.validate_range(spark, january_only, *span)
    monthly.normalize_range(spark, january_only, *span)
    with pytest.raises(MissingPartitionError, match="No weather data"):
        monthly.enrich_range(spark, january_only, *span)
    landing.write_weather(tmp_path / "january", "2025-01")
    coverage = monthly.enrich_range(spark, january_only, *span)
    assert (coverage.total_rows, coverage.unmatched_rows) == (9, 3)
    february = read_curated(spark, january_only.curated, "2025-02")
    assert february.count() == 3
    assert february.where("weather_joined or temperature is not null").isEmpty()


def test_failing_dataset_test_blocks_the_serving_tables(spark, settings, tmp_path):
    landing.write_zones(tmp_path).write_text("LocationID,Borough,Zone,service_zone\n100,M,Y,B\n")
    with pytest.raises(QualityError, match="relationships_fct_trips_pickup_location_id"):
        monthly.run_range(spark, settings, day="2025-01-15")
    assert not spark.catalog.databaseExists(settings.serving_database)
    lenient = Settings(
        root=settings.root, serving_database=settings.serving_database, fail_on_checks=False
    )
    results = monthly.publish_marts(spark, lenient).checks
    assert sum(r.violations > 0 for r in results) == 2 and len(results) == 21
    assert spark.table(f"{settings.serving_database}.dim_zones").count() == 1


def test_only_changed_months_are_published(spark, settings, tmp_path):
    monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    root = tmp_path / "marts" / "fct_trips"

    def files(month):
        return {p.name for p in root.glob(f"source_month={month}/*/*.parquet")}

    january, february = files("2025-01"), files("2025-02")
    monthly.backfill(spark, settings, "2025-02-01", "2025-02-28")
    assert (files("2025-01"), files("2025-02")) == (january, february)  # run again to the same rows
    corrected = [{**row, "tip_amount": 1.5} for row in landing.february()]
    landing.write_trips(tmp_path, "2025-02", corrected)
    monthly.backfill(spark, settings, "2025-02-01", "2025-02-28")
    assert files("2025-01") == january
    assert files("2025-02") != february
    zones = landing.write_zones(tmp_path)
    zones.write_text(zones.read_text().replace("Mill Yard", "Mill Court"))
    monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    fact = spark.read.parquet(str(root))
    assert fact.where("pickup_zone = 'Mill Yard'").isEmpty()
    assert fact.count() == 11
    assert monthly.publish_marts(spark, settings, rebuild=True).loaded_rows["daily_demand"] == 9


def test_current_metrics_and_alerts(spark, settings):
    with pytest.raises(IngestError):
        monthly.ingest_range(spark, settings, date(2025, 1, 1), date(2025, 3, 31))
    monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    assert monthly.ingest_range(spark, settings, date(2025, 1, 1), date(2025, 2, 28)).total == 0
    metrics = {(r.metric, r.label): r.value for r in monthly.current_metrics(spark, settings).collect()}
    assert metrics["rows_ingested", "taxi_trips"] == 12
    assert metrics["storage_bytes", None] > 10_000
    assert monthly.current_alerts(spark, settings).isEmpty()
    tight = Settings(root=settings.root, alert_row_ratio=1.1, alert_max_seconds=0.0)
    names = {r.name for r in monthly.current_alerts(spark, tight).collect()}
    assert names == {"row_count_change", "excessive_duration"}


def test_fact_roles(spark, settings):
    monthly.run_range(spark, settings, day="2025-01-15")
    fact = spark.read.parquet(settings.fact)
    row = fact.where(F.col("pickup_location_id") == 132).first()
    assert (row.pickup_zone, row.dropoff_borough) == ("Long Runway", "Bronx")
    staging_view(read_curated(spark, settings.curated))
    assert spark.table("stg_trips").schema["passenger_count"].dataType.simpleString() == "int"
    assert fact.schema["pickup_hour"].dataType.simpleString() == "int"
    assert fact.schema["trip_duration_seconds"].dataType.simpleString() == "double"


def joined(spark, settings):
    """Sums that weather, tips and rows change, of the curated trips and of the fact."""
    measures = [F.sum("temperature").alias("t"), F.sum("tip_amount").alias("tips"), F.count(F.lit(1)).alias("n")]
    return [tuple(spark.read.parquet(path).agg(*measures).first()) for path in (settings.curated, settings.fact)]


def warmer(tmp_path, month, by):
    path = landing.write_weather(tmp_path, month)
    document = json.loads(path.read_text())
    document["hourly"]["temperature_2m"] = [t + by for t in document["hourly"]["temperature_2m"]]
    path.write_text(json.dumps(document))


def test_what_single_steps_rewrite_is_published(spark, settings, tmp_path):
    span = (date(2025, 1, 1), date(2025, 2, 28))
    monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    curated, fact = joined(spark, settings)
    assert curated == fact
    # Weather that came corrected, joined by a step of its own.
    warmer(tmp_path, "2025-01", 100)
    monthly.enrich_range(spark, settings, *span)
    monthly.publish_marts(spark, settings)
    curated, fact = joined(spark, settings)
    assert curated == fact and fact[0] > 400
    # Trips that came corrected, validated, normalized and enriched by steps of their own.
    landing.write_trips(tmp_path, "2025-02", [{**row, "tip_amount": 9.0} for row in landing.february()[1:]])
    monthly.validate_range(spark, settings, *span)
    monthly.normalize_range(spark, settings, *span)
    monthly.enrich_range(spark, settings, *span)
    results = monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    assert [r.status for r in results] == ["skipped", "skipped"]
    curated, fact = joined(spark, settings)
    assert curated == fact and fact[2] == 10
    whole = other(settings, tmp_path, "whole")
    landing.write_trips(tmp_path / "whole", "2025-02", [{**row, "tip_amount": 9.0} for row in landing.february()[1:]])
    warmer(tmp_path / "whole", "2025-01", 100)
    monthly.run_range(spark, whole, start="2025-01-01", end="2025-02-28")
    assert state(spark, whole) == state(spark, settings)


def test_a_month_without_rows_is_a_success(spark, settings, tmp_path):
    landing.write_trips(tmp_path, "2025-03", [])
    april = [{**row, **{c: row[c].replace(month=4) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}} for row in landing.january()[:3]]
    landing.write_trips(tmp_path, "2025-04", april)
    landing.write_weather(tmp_path, "2025-04")  # none for March
    results = monthly.run_range(spark, settings, start="2025-02-01", end="2025-04-30")
    assert [(r.status, r.input_rows, r.output_rows) for r in results] == [("success", 5, 5), ("success", 0, 0), ("success", 3, 3)]
    report = spark.read.json(f"{settings.reports}/partition=2025-03").first()
    assert (report.total_rows, report.valid_rows, report.invalid_rows) == (0, 0, 0)
    log = CommitLog(spark, settings.commit_log)
    for table in ("validated", "staging", "curated", "fact"):
        assert (log.find(table, "2025-03").row_count, log.find(table, "2025-03").dates) == (0, [])
    assert set(monthly.curated_trips(spark, settings, "2025-03").columns) == set(monthly.curated_trips(spark, settings, "2025-04").columns)
    assert spark.read.parquet(settings.fact).count() == 8
    assert monthly.publish_marts(spark, settings).loaded_rows["daily_demand"] > 0
    # A month that had rows and comes without any.
    landing.write_trips(tmp_path, "2025-02", [])
    monthly.backfill(spark, settings, "2025-02-01", "2025-02-28")
    assert spark.read.parquet(settings.fact).count() == 3
    for label in ("valid", "invalid", "quarantined"):
        assert read_validated(spark, settings.validated, "2025-02", label, log.schema("validated", "2025-02")).isEmpty()


def test_only_empty_months(spark, settings, tmp_path):
    for month in ("2025-01", "2025-02"):
        landing.write_trips(tmp_path, month, [])
    results = monthly.run_range(spark, settings, start="2025-01-01", end="2025-02-28")
    assert [r.output_rows for r in results] == [0, 0]
    assert serving_marts(spark, settings.serving_database).daily_demand.isEmpty()


def test_commits_record_what_was_written(spark, settings, tmp_path):
    monthly.run_range(spark, settings, day="2025-01-15")
    log = CommitLog(spark, settings.commit_log)
    staged = log.find("staging", "2025-01")
    files = list((tmp_path / "staging" / "trips").rglob("*.parquet"))
    assert (staged.row_count, staged.file_count, staged.byte_count) == (6, len(files), sum(f.stat().st_size for f in files))
    assert staged.dates == monthly.written_dates(spark, settings, "staging", "2025-01") == ["2025-01-04", "2025-01-09", "2025-01-17", "2025-01-30"]
    monthly.backfill(spark, settings, "2025-01-01", "2025-01-31")
    again = log.find("staging", "2025-01")
    assert again.commit_id != staged.commit_id and again.checksum == staged.checksum
    assert log.months("curated") == ["2025-01"] and log.find("curated", "2025-02") is None
    with pytest.raises(MissingPartitionError):
        log.schema("curated", "2025-02")


def test_late_columns_come_from_the_recorded_schemas(spark, tmp_path):
    """A column that later months have is null in earlier ones, without a look at their footers."""
    log, root = CommitLog(spark, str(tmp_path / "log")), str(tmp_path / "curated")
    at = datetime(2025, 1, 3, 8)
    early = spark.createDataFrame([(1, at, date(2025, 1, 3))], "a int, pickup_datetime timestamp_ntz, pickup_date date")
    late = spark.createDataFrame([(2, "x", at, date(2025, 2, 3))], "a int, b string, pickup_datetime timestamp_ntz, pickup_date date")
    for month, rows in (("2025-01", early), ("2025-02", late)):
        log.record("curated", month, write_month_dates(rows, root, month), rows.schema)
    rows = read_curated(spark, root, schema=log.schema("curated"))
    assert sorted(rows.select("a", "b").collect()) == [(1, None), (2, "x")]
    dates = read_dates(spark, root, date(2025, 2, 1), date(2025, 2, 3), schema=log.schema("curated"))
    assert [tuple(r) for r in dates.select("a", "b").collect()] == [(2, "x")]
    other = late.withColumn("a", F.lit("3"))
    log.record("curated", "2025-03", write_month_dates(other, root, "2025-03"), other.schema)
    with pytest.raises(ValueError, match="a is"):
        log.schema("curated")


def test_checksum_sees_repeated_rows_and_no_order(spark):
    def of(rows):
        return spark.createDataFrame(rows, "a int, b string").agg(rows_checksum([F.col("a"), F.col("b")])).first()[0]

    assert of([(1, "x"), (2, None), (3, "y")]) == of([(3, "y"), (2, None), (1, "x")])
    assert len({of(x) for x in ([], [(1, "x")], [(1, "x")] * 2, [(1, "x")] * 3, [(1, "x"), (2, "y"), (2, "y")], [(1, "x"), (3, "y"), (3, "y")])}) == 6
