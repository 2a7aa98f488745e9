"""The monthly batch job: validate, normalize, enrich, then marts, checks and serving tables.

Every step reads what the step before has written, so a retry or a lost executor repeats
one step's tasks and no lineage grows across steps. A step replaces the output of its month.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from tripmill.errors import IngestError, MissingPartitionError, QualityError
from tripmill.functions.calendar import month_bounds, months_between_dates
from tripmill.operators.canonical import canonical_trips
from tripmill.operators.checks import fact_profile, mart_check_results
from tripmill.operators.classify import Classification, gate_row, nest_report
from tripmill.operators.joins import enrich_hourly, weather_coverage
from tripmill.operators.latest import latest_per_key
from tripmill.operators.normalize import normalize
from tripmill.plans import history, observe
from tripmill.plans.commits import CommitLog, schema_of, stored_bytes
from tripmill.plans.marts import ROLLUPS, Marts, fct_trips, merged_rollup, rollup_parts, stg_trips
from tripmill.schema import FACT_COLUMNS, MANIFEST_SCHEMA, PUBLISH_LOG_SCHEMA
from tripmill.settings import Settings
from tripmill.sinks import files as sinks
from tripmill.sinks.serving import load_marts
from tripmill.sources import landed
from tripmill.sources.trips import (
    read_curated,
    read_parquet,
    read_staged,
    read_validated,
    scan_month,
    union_by_name,
)
from tripmill.sources.weather import no_weather, read_weather_months
from tripmill.sources.zones import read_zones


@dataclass(frozen=True)
class MonthResult:
    partition: str
    status: str
    input_rows: int | None = None
    output_rows: int | None = None


@dataclass(frozen=True)
class Published:
    marts: Marts
    checks: list[Row]
    loaded_rows: dict[str, int]


def resolve_range(
    settings: Settings, day: str | None = None, start: str | None = None, end: str | None = None
) -> tuple[date, date]:
    """One day stands for its month; otherwise start and end with the configured defaults."""
    if day:
        return date.fromisoformat(day), date.fromisoformat(day)
    return (
        date.fromisoformat(start or settings.default_start),
        date.fromisoformat(end or settings.default_end),
    )


def month_keys(spark: SparkSession, start: date, end: date) -> list[str]:
    months = months_between_dates(spark, start, end).sort("partition_date")
    return [row.partition_date for row in months.select("partition_date").collect()]


def register_landed(spark: SparkSession, settings: Settings, start: date, end: date) -> DataFrame:
    """Record the planned sources whose folders hold something else than was last recorded."""
    log = history.read_log(spark, settings.manifest_log, MANIFEST_SCHEMA)
    planned = landed.plan(spark, start, end, settings)
    listing = landed.list_planned(spark, planned, settings)
    folders = listing.groupBy("folder").agg(F.sum("file_size").alias("file_size"))
    pending = history.pending_ingests(planned, history.latest_ingestions(log), folders)
    records = landed.landed_records(spark, pending, settings).collect()  # one row per source and month
    appended = spark.createDataFrame(records, MANIFEST_SCHEMA)
    if records:
        history.append_log(appended.coalesce(1), settings.manifest_log)
    return appended


def require_landed(records: DataFrame) -> Row:
    """Totals of a registration; raises when a planned file has not landed."""
    totals = history.ingest_summary(records).first()
    if totals.failed:
        raise IngestError(f"{totals.failed} ingestion(s) failed")
    return totals


def check_gate(profile: DataFrame, settings: Settings) -> None:
    gate = gate_row(profile, settings.max_invalid_ratio, settings.max_null_ratio).first()
    if gate.invalid_ratio > settings.max_invalid_ratio:
        raise QualityError(
            f"Invalid row ratio {gate.invalid_ratio:.2%} exceeds {settings.max_invalid_ratio:.0%}"
        )
    if gate.null_ratio > settings.max_null_ratio:
        raise QualityError(
            f"Null row ratio {gate.null_ratio:.2%} exceeds {settings.max_null_ratio:.0%}"
        )


def validate_month(spark: SparkSession, settings: Settings, partition: str) -> Row:
    """Gate, split and report one month; nothing is written when the gate fails.

    The gate needs one narrow scan without an exchange. With ``digest_duplicates`` a second scan
    exchanges a digest of each possible duplicate, and whole rows only of repeated ones. The report adds the class totals of
    what was written to it, so that it counts what is there.
    """
    trips = canonical_trips(scan_month(spark, settings.raw_trips, partition))
    quality = Classification(trips)
    profile_row = quality.row_profile().collect()
    profile = spark.createDataFrame(profile_row, quality.row_profile().schema)
    check_gate(profile, settings)

    outcomes = (quality.measured() if settings.digest_duplicates else quality).outcomes()
    path = sinks.write_outcomes(outcomes, settings.validated, partition)
    reason = F.col("quarantine_reason")
    totals = {
        "valid_rows": F.col("class") == "valid",
        "duplicate": (F.col("class") == "quarantined") & (reason == "duplicate"),
        "outlier": (F.col("class") == "quarantined") & (reason == "outlier"),
    }
    written = CommitLog(spark, settings.commit_log).record(
        "validated", partition, path, outcomes.schema, totals=[F.count_if(c).alias(n) for n, c in totals.items()]
    )
    flat = profile.withColumns({name: F.lit(written[name]) for name in totals})
    report = nest_report(flat, quality.profile)
    sinks.write_report(report, settings.reports, partition)
    return report.first()


def normalize_month(spark: SparkSession, settings: Settings, partition: str) -> tuple[int, int]:
    """Stage the valid trips of a month by pickup date; returns rows read and rows staged."""
    log = CommitLog(spark, settings.commit_log)
    schema = recorded_schema(log, "validated", partition)
    valid = read_validated(spark, settings.validated, partition, schema=schema)
    rows = normalize(valid)
    path = sinks.write_staging(rows, settings.staging, partition)
    staged = log.record("staging", partition, path, rows.schema, "pickup_date")
    return valid.count(), staged.row_count


def recorded_schema(log: CommitLog, table: str, partition: str) -> StructType | None:
    """The schema that the month was committed with; none if it was written without a record."""
    found = log.find(table, partition)
    return schema_of(found.table_schema) if found else None


def written_dates(spark: SparkSession, settings: Settings, table: str, partition: str) -> list[str]:
    """Dates that a month last wrote to ``staging``, ``curated`` or ``fact``."""
    found = CommitLog(spark, settings.commit_log).find(table, partition)
    return found.dates if found else []


def staged_trips(spark: SparkSession, settings: Settings, partition: str) -> DataFrame:
    schema = recorded_schema(CommitLog(spark, settings.commit_log), "staging", partition)
    return read_staged(spark, settings.staging, partition, schema)


def curated_trips(spark: SparkSession, settings: Settings, partition: str) -> DataFrame:
    schema = recorded_schema(CommitLog(spark, settings.commit_log), "curated", partition)
    return read_curated(spark, settings.curated, partition, schema)


def enrich_month(spark: SparkSession, settings: Settings, partition: str) -> tuple[Row, list[str]]:
    """Curate all that a month has staged; returns coverage and the dates that were written.

    Stray trips of other months are curated with the month whose file brought them, so the
    result does not depend on the order in which months run.
    """
    trips = staged_trips(spark, settings, partition)
    dates = curate_staged(spark, settings, partition, trips, [])
    return weather_coverage(curated_trips(spark, settings, partition)).first(), dates


def curate_staged(
    spark: SparkSession, settings: Settings, partition: str, trips: DataFrame, span: list[str]
) -> list[str]:
    """Curate the staged trips of a month; returns their dates.

    Where no month of these dates has weather, trips are curated without it, if any month of
    `span` has weather. A month without trips needs no weather.
    """
    dates = [row.pickup_date for row in sinks.dates_written(trips).collect()]
    try:
        months = [day[:7] for day in dates]
        weather = read_weather_months(spark, settings.raw_weather, months) if dates else no_weather(spark)
    except MissingPartitionError:
        if not span:
            raise
        weather = read_weather_months(spark, settings.raw_weather, span)
    rows = enrich_hourly(trips, weather)
    path = sinks.write_month_dates(rows, settings.curated, partition)
    CommitLog(spark, settings.commit_log).record("curated", partition, path, rows.schema, "pickup_date")
    return dates


def enrich_range(spark: SparkSession, settings: Settings, start: date, end: date) -> Row:
    """Curate the staged months that touch [start, end]; returns the coverage of all of them.

    Months without staged trips are skipped. Trips of months without weather are curated with
    null weather; only when the whole range has none, an error says so.
    """
    done = []
    span = month_keys(spark, start, end)
    for partition in span:
        try:
            trips = staged_trips(spark, settings, partition)
        except MissingPartitionError:
            continue
        curate_staged(spark, settings, partition, trips, span)
        done.append(curated_trips(spark, settings, partition))
    if not done:
        raise MissingPartitionError(f"No data staged between {start} and {end}")
    return weather_coverage(union_by_name(done)).first()


def run_month(spark: SparkSession, settings: Settings, log: history.RunLog, partition: str) -> MonthResult:
    run = {
        "run_id": uuid4().hex,
        "pipeline_name": settings.pipeline_name,
        "partition_date": partition,
        "started_at": history.utc_now(),
    }
    log.record(**run, status="running")
    first, last = month_bounds(partition)
    try:
        register_landed(spark, settings, first, last)
        report = validate_month(spark, settings, partition)
        _, staged = normalize_month(spark, settings, partition)
        enrich_month(spark, settings, partition)
    except Exception as error:
        log.record(
            **run, status="failed", completed_at=history.utc_now(), error_message=str(error)
        )
        raise
    log.record(
        **run,
        status="success",
        completed_at=history.utc_now(),
        input_rows=report.total_rows,
        output_rows=staged,
    )
    return MonthResult(partition, "success", report.total_rows, staged)


def pending_publications(current: DataFrame, published: DataFrame, zones_digest: str) -> DataFrame:
    """Months of ``current`` whose version is not what was last published with these zones.

    A version stands for what a month holds: the checksum of its curated trips, whatever call
    has written them.
    """
    current = current.select("partition_date", "version")
    last = latest_per_key(published, ["partition_date"], ["published_at", "version"])
    last = last.where(F.col("zones_digest") == zones_digest).select("partition_date", "version")
    return current.join(last, ["partition_date", "version"], "left_anti")


def zones_digest(zones: DataFrame) -> str:
    """Changes with any row of the dimension, whatever their order."""
    rows = F.xxhash64(*zones.columns)
    digest = zones.agg(F.count(F.lit(1)), F.bit_xor(rows), F.bit_xor(F.xxhash64(rows))).first()
    return "-".join(map(str, digest))


def curated_versions(spark: SparkSession, settings: Settings) -> DataFrame:
    """partition_date and version of the source months that are curated."""
    commits = CommitLog(spark, settings.commit_log).commits().where("table_name = 'curated'")
    return commits.select("partition_date", F.col("checksum").alias("version"))


def publish_month(spark: SparkSession, settings: Settings, zones: DataFrame, partition: str) -> None:
    """Replace what one source month adds to the fact and to the parts of the marts."""
    rows = fct_trips(stg_trips(curated_trips(spark, settings, partition)), zones)
    path = sinks.write_month_dates(rows, settings.fact, partition)
    CommitLog(spark, settings.commit_log).record("fact", partition, path, rows.schema, "pickup_date")
    fact = read_parquet(spark, path, f"No fact for {partition}", rows.schema).select(*FACT_COLUMNS)
    parts = {name: rollup_parts(fact, rollup) for name, rollup in ROLLUPS.items()}
    for name, part in {**parts, "fact_profile": fact_profile(fact)}.items():
        sinks.write_month(part, settings.parts(name), partition)


def merged_marts(spark: SparkSession, settings: Settings, zones: DataFrame) -> Marts:
    """All marts out of the parts of all months; trips are not read."""
    merged = {
        name: merged_rollup(read_parquet(spark, settings.parts(name), "Nothing is published"), rollup)
        for name, rollup in ROLLUPS.items()
    }
    return Marts(dim_zones=zones, **merged)


def publish_marts(spark: SparkSession, settings: Settings, rebuild: bool = False) -> Published:
    """Publish every curated month whose content is not published yet, test all and load the serving tables.

    What to publish follows from the checksums of curated months and the log of publications, so
    what a step by itself rewrote, or a failed call left behind, is taken up by the next, and a
    month that was run again to the same rows is not. ``rebuild`` publishes all curated months
    anew. One month costs one scan of its trips: marts are merged from parts that each month
    keeps, and the tests of the fact read a profile of it. A failing test stops the job before
    the serving tables are touched, unless the settings say otherwise; its months stay pending.
    """
    zones = read_zones(spark, settings.raw_zones)
    digest = zones_digest(zones)
    log = history.read_log(spark, settings.publish_log, PUBLISH_LOG_SCHEMA)
    versions = curated_versions(spark, settings)
    todo = versions if rebuild else pending_publications(versions, log, digest)
    months = {row.partition_date: row.version for row in todo.collect()}  # a row per month
    for partition in sorted(months):
        publish_month(spark, settings, zones, partition)

    sinks.write_marts(merged_marts(spark, settings, zones), settings.marts)
    marts = sinks.read_marts(spark, settings.marts)
    profile = spark.read.parquet(settings.parts("fact_profile"))
    results = mart_check_results(profile, marts).collect()
    failed = [f"{row.check} ({row.violations})" for row in results if row.violations]
    if failed and settings.fail_on_checks:
        raise QualityError(f"Dataset tests failed: {', '.join(failed)}")
    counts = load_marts(marts, settings.serving_database, settings.path("serving"))
    done = [(m, version, digest, history.utc_now()) for m, version in months.items()]
    if done:
        history.append_log(spark.createDataFrame(done, PUBLISH_LOG_SCHEMA).coalesce(1), settings.publish_log)
    return Published(marts, results, counts)


def ingest_range(spark: SparkSession, settings: Settings, start: date, end: date) -> Row:
    """Register the landed files of a range; fails when a planned file has not landed."""
    return require_landed(register_landed(spark, settings, start, end))


def current_metrics(spark: SparkSession, settings: Settings) -> DataFrame:
    """Metric rows of the job: run log, manifest and the bytes of what has landed and was committed."""
    manifest = history.ManifestLog(spark, settings.manifest_log).ingestions()
    stored = stored_bytes(CommitLog(spark, settings.commit_log).commits(), manifest)
    return observe.run_metrics(history.RunLog(spark, settings.run_log).runs(), manifest, stored)


def current_alerts(spark: SparkSession, settings: Settings) -> DataFrame:
    """Alerts of the job with the limits of its settings."""
    runs = history.RunLog(spark, settings.run_log).runs()
    return observe.alerts(runs, settings.alert_row_ratio, settings.alert_max_seconds)


def run_range(
    spark: SparkSession,
    settings: Settings,
    day: str | None = None,
    start: str | None = None,
    end: str | None = None,
    force: bool = False,
) -> list[MonthResult]:
    """Run every month of a range, skipping completed ones unless forced; then publish.

    Stops at the first month that fails; what was completed before is published by the next call.
    """
    log = history.RunLog(spark, settings.run_log)
    first, last = resolve_range(settings, day, start, end)
    months = month_keys(spark, first, last)
    planned = spark.createDataFrame([(m,) for m in months], "partition_date string")
    pending = history.pending_partitions(planned, log.runs(), settings.pipeline_name)
    todo = set(months) if force else {row.partition_date for row in pending.collect()}
    results = []
    for partition in months:
        if partition in todo:
            results.append(run_month(spark, settings, log, partition))
        else:
            results.append(MonthResult(partition, "skipped"))
    publish_marts(spark, settings)
    return results


def backfill(spark: SparkSession, settings: Settings, start: str, end: str) -> list[MonthResult]:
    return run_range(spark, settings, start=start, end=end, force=True)


def validate_range(spark: SparkSession, settings: Settings, start: date, end: date) -> dict[str, Row]:
    """Reports of the months that have raw data; months without are skipped."""
    reports = {}
    for partition in month_keys(spark, start, end):
        try:
            reports[partition] = validate_month(spark, settings, partition)
        except MissingPartitionError:
            continue
    return reports


def normalize_range(
    spark: SparkSession, settings: Settings, start: date, end: date
) -> dict[str, tuple[int, int]]:
    """Rows read and staged of the months that have validated data."""
    counts = {}
    for partition in month_keys(spark, start, end):
        try:
            counts[partition] = normalize_month(spark, settings, partition)
        except MissingPartitionError:
            continue
    return counts
