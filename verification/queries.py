"""Every registered query: library operators over the provided tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmill.functions.calendar import day_sequence, hour_start, month_key, month_sequence
from tripmill.functions.digest import rows_checksum
from tripmill.functions.labels import payment_label, weather_label
from tripmill.functions.measures import stable_avg, stable_sum
from tripmill.operators import checks
from tripmill.operators.canonical import canonical_trips, cast_types, rename_canonical
from tripmill.operators.classify import Classification
from tripmill.operators.joins import enrich_hourly, orphans, weather_coverage
from tripmill.operators.normalize import normalize, staging_columns
from tripmill.operators.rules import TRIP_RULES
from tripmill.plans import history, marts as mart_plans, monthly, observe, serving
from tripmill.plans.marts import Marts
from tripmill.schema import PAYMENT_LABELS, REQUIRED
from tripmill.settings import Settings
from tripmill.sinks.files import dates_written, write_dates
from tripmill.sources import landed, trips as trip_sources
from tripmill.sources.landed import planned_sources
from tripmill.sources.trips import read_dates, read_parquet_relaxed, union_by_name, union_relaxed
from tripmill.sources.weather import parse_weather, weather_document
from tripmill.sources.zones import read_zones
from verification.fixtures import table, view
from verification.landing import landing_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DEMAND_START, DEMAND_END, DEMAND_ZONE = date(1997, 1, 1), date(1998, 12, 31), 100
WEATHER_START, WEATHER_END, WEATHER_LABEL = date(2024, 1, 5), date(2024, 1, 20), "unknown"
PRICE_CHANGED = 470_000
STAGED_START, STAGED_END = date(1996, 2, 1), date(1996, 2, 29)


# Integer columns with nulls, by query. Result frames of the two engines show them differently
# (NaN or NA), so they leave as doubles; dates leave as ISO text for the same reason.
NULLABLE_INTEGERS = {
    **dict.fromkeys(
        (
            "union_by_name",
            "rename_canonical",
            "cast_types",
            "valid_rows",
            "invalid_rows",
            "quarantined_rows",
            "null_rows",
            "outlier_rows",
            "outcome_rows",
        ),
        ("passenger_count",),
    ),
    **dict.fromkeys(
        ("runs_upsert", "list_runs", "latest_run_per_partition", "latest_run"),
        ("input_rows", "output_rows"),
    ),
}


# Columns of sums and means, by query: the library adds exactly, the other engine in any order, so
# results are compared to 4 decimals.
OFF_TIES = 1.23e-5  # added first, as means of cents often end right between two roundings
DAILY = ("average_trip_duration", "total_distance", "total_revenue", "average_fare")
HOURLY = ("average_trip_duration", "average_fare")
ROUTE = ("average_distance", "average_duration", "total_revenue", "average_tip")
IMPACT = ("average_duration", "average_fare")
ROUNDED = {
    "weekday_demand": ("revenue",),
    "airport_trips": ("avg_miles",),
    "enrich_hourly_fan_out": ("temperatures",),
    "daily_demand": DAILY,
    "demand_all": DAILY,
    "demand_filtered": DAILY,
    "hourly_demand": HOURLY,
    "route_performance": ROUTE,
    "top_routes": ROUTE,
    "weather_impact": IMPACT,
    "weather_impact_filtered": IMPACT,
    "revenue_by_date": ("total_revenue",),
    "kpi": ("revenue", "avg_duration"),
    "revenue_trend": ("revenue",),
    "top_routes_named": ("total_revenue",),
    "weather_summary": ("avg_duration",),
}


def query(key: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name."""

    def register(build: Query) -> Query:
        name = key or build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            rows = build(spark, sf_dir)
            shown = {c: F.col(c).cast("string") for c, kind in rows.dtypes if kind == "date"}
            shown |= {c: F.col(c).cast("double") for c in NULLABLE_INTEGERS.get(name, ())}
            shown |= {c: F.round(F.col(c) + OFF_TIES, 4) for c in ROUNDED.get(name, ())}
            return rows.withColumns(shown) if shown else rows

        QUERIES[name] = run
        return build

    return register


# Inputs


def trips(spark, d):
    return canonical_trips(view(spark, d, "raw_trips"))


def quality(spark, d):
    return Classification(trips(spark, d))


def normalized(spark, d):
    return normalize(quality(spark, d).valid())


def rides(spark, d):
    return canonical_trips(view(spark, d, "rides"))


def weather(spark, d):
    hours = view(spark, d, "hourly_weather")
    return hours.select(
        F.col("weather_hour").cast("timestamp_ntz").alias("weather_hour"),
        "temperature",
        "precipitation",
        "wind_speed",
        weather_label(F.col("weather_code")).alias("weather_condition"),
    )


def curated(spark, d):
    return enrich_hourly(normalize(Classification(rides(spark, d)).valid()), weather(spark, d))


def zones(spark, d):
    return view(spark, d, "zones")


def fact(spark, d):
    return mart_plans.fct_trips(mart_plans.stg_trips(curated(spark, d)), zones(spark, d))


def demand_marts(spark, d, weather_impact=None):
    """Demand marts over the large trip table; the weather mart only where it is used."""
    base = normalized(spark, d)
    return Marts(
        dim_zones=zones(spark, d),
        daily_demand=mart_plans.daily_demand(base),
        hourly_demand=mart_plans.hourly_demand(base),
        route_performance=mart_plans.route_performance(base),
        weather_impact=weather_impact,
    )


def impact(spark, d):
    """The weather mart over the rides."""
    return mart_plans.weather_impact(mart_plans.stg_trips(curated(spark, d)))


def marts(spark, d):
    return demand_marts(spark, d, impact(spark, d))


def runs(spark, d):
    return view(spark, d, "runs")


def gap_runs(spark, d):
    """Runs that leave months out."""
    return view(spark, d, "gap_runs")


def manifest(spark, d):
    return history.latest_ingestions(view(spark, d, "manifest_log"), ["row_id"])


def order_months(spark, d):
    """Every month between the first and the last order."""
    ends = table(spark, d, "orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    months = ends.select(
        F.explode(month_sequence(F.to_date("first"), F.to_date("last"))).alias("month_start")
    )
    return months.select(
        "month_start",
        F.last_day("month_start").alias("month_end"),
        month_key(F.col("month_start")).alias("partition_date"),
    )


# Sources


@query()
def scan_month(spark, d):
    months = trips(spark, d).groupBy(month_key(F.col("pickup_datetime")).alias("partition_date"))
    return months.agg(
        F.count(F.lit(1)).alias("trips"),
        F.min("pickup_datetime").alias("first_pickup"),
        F.max("pickup_datetime").alias("last_pickup"),
    )


@query()
def scan_date_range(spark, d):
    staged = normalized(spark, d)
    return staged.where(F.col("pickup_date").between(F.lit(STAGED_START), F.lit(STAGED_END))).select(
        "trip_key", "pickup_datetime", "pickup_date", "trip_distance"
    )


@query()
def landed_months(spark, d):
    """Every month of rides, landed in its own folder and scanned by itself."""
    landing = landing_folder(spark, "raw")
    pickup = F.col("pickup_datetime")
    raw = view(spark, d, "rides").withColumns(
        {"year": F.date_format(pickup, "yyyy"), "month": F.date_format(pickup, "MM")}
    )
    raw.hint("rebalance", "year", "month").write.partitionBy("year", "month").parquet(landing)
    months = [row.m for row in raw.select(F.concat_ws("-", "year", "month").alias("m")).distinct().sort("m").collect()]
    return union_by_name(
        [
            canonical_trips(trip_sources.scan_month(spark, landing, month)).agg(
                F.lit(month).alias("partition_date"),
                F.count(F.lit(1)).alias("trips"),
                F.min("pickup_datetime").alias("first_pickup"),
                F.max("pickup_datetime").alias("last_pickup"),
            )
            for month in months
        ]
    )


@query()
def staged_dates(spark, d):
    """Rides staged by date, and the dates of a range read back."""
    landing = landing_folder(spark, "staged")
    columns = ("trip_key", "pickup_datetime", "pickup_date", "trip_distance")
    staged = rides(spark, d).withColumn("pickup_date", F.to_date("pickup_datetime")).select(*columns)
    write_dates(staged, landing)
    return read_dates(spark, landing, WEATHER_START, WEATHER_END, by_source_month=False).select(*columns)


@query("union_relaxed")
def union_relaxed_types(spark, d):
    other = rides(spark, d).withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("double"),
            "payment_type": F.col("payment_type").cast("int"),
        }
    )
    return union_relaxed([trips(spark, d), other])


@query("union_by_name")
def union_by_name_missing(spark, d):
    with_fee = rides(spark, d).withColumn("airport_fee", F.col("fare_amount") * 0.5)
    return union_by_name([trips(spark, d), with_fee])


@query()
def weather_parse(spark, d):
    """Hours packed into one JSON document per day, then parsed back from the text."""
    hours = view(spark, d, "hourly_weather").withColumn(
        "weather_hour", F.col("weather_hour").cast("timestamp_ntz")
    )
    entry = F.struct(
        F.date_format("weather_hour", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.col("temperature").alias("temperature_2m"),
        "precipitation",
        F.col("wind_speed").alias("wind_speed_10m"),
        "weather_code",
    )
    # A day has at most 24 hours, so a document is small.
    days = hours.groupBy(F.to_date("weather_hour").alias("day")).agg(
        F.sort_array(F.collect_list(entry)).alias("e")
    )
    names = ("time", "temperature_2m", "precipitation", "wind_speed_10m", "weather_code")
    document = F.struct(
        F.lit("America/New_York").alias("timezone"),
        F.struct(*(F.col("e").getField(n).alias(n) for n in names)).alias("hourly"),
    )
    texts = days.select(F.to_json(document).alias("text"))
    return parse_weather(texts.select(weather_document(F.col("text")).alias("doc")).select("doc.*"))


@query()
def dim_zones(spark, d):
    """Zones landed as a CSV file with the names of the feed, and read from it."""
    landing = landing_folder(spark, "zones")
    names = {"location_id": "LocationID", "borough": "Borough", "zone": "Zone"}
    columns = (*names.values(), "service_zone")
    zones(spark, d).withColumnsRenamed(names).select(*columns).write.option("header", True).csv(landing)
    return read_zones(spark, landing).withColumn("location_id", F.col("location_id").cast("bigint"))


@query()
def file_checksums(spark, d):
    """SHA-256 and size of landed text files, one of the keys of each month of orders."""
    landing = landing_folder(spark, "keys")
    keys = table(spark, d, "orders").select(
        month_key(F.to_date("o_orderdate")).alias("partition_date"),
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("value"),
    )
    one_task_each = keys.repartition("partition_date").sortWithinPartitions("partition_date", "o_orderkey")
    one_task_each.select("partition_date", "value").write.partitionBy("partition_date").text(landing)
    month = F.regexp_extract("path", "partition_date=([0-9-]+)", 1)
    found = landed.file_checksums(spark, f"{landing}/*/*.txt")
    return found.select(month.alias("partition_date"), "checksum", "file_size")


@query()
def checksum_text(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        F.sha2("text", 256).alias("checksum"),
        F.octet_length("text").cast("bigint").alias("bytes"),
    )


@query()
def file_rows(spark, d):
    """Rows of given Parquet files, counted by the reader of landed files."""
    tables = ("region", "nation", "orders", "lineitem")
    found = [landed.file_rows(spark, "parquet", f"{d}/{name}.parquet") for name in tables]
    name = F.regexp_extract("path", "([a-z]+)\\.parquet", 1)
    return union_by_name(found).groupBy(name.alias("file")).agg(F.sum("row_count").alias("rows_found"))


@query()
def list_files(spark, d):
    """Files of given tables, listed without reading them."""
    found = [landed.list_files(spark, f"{d}/{name}.parquet") for name in ("events", "orders")]
    name = F.regexp_extract("path", "([a-z]+)\\.parquet", 1)
    return union_by_name(found).select(name.alias("file"), (F.col("file_size") > 0).alias("filled")).distinct()


@query()
def read_relaxed(spark, d):
    """A month of orders through the reader of raw months."""
    orders = read_parquet_relaxed(spark, f"{d}/orders.parquet", "No orders")
    return orders.groupBy(month_key(F.col("o_orderdate")).alias("partition_date")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@query()
def publish_pending(spark, d):
    """Months whose newest run succeeded, less those whose publication is on record."""
    log = manifest(spark, d).where("source_name = '1-URGENT'").select(
        "partition_date", F.col("row_id").cast("string").alias("version"),
        F.lit("z").alias("zones_digest"), F.col("downloaded_at").alias("published_at"),
    )
    newest = history.latest_run_per_partition(runs(spark, d)).where("status = 'success' and pipeline_name = 'trips'")
    current = newest.select("partition_date", F.col("run_id").alias("version"))
    return monthly.pending_publications(current, log, "z").withColumnRenamed("version", "run_id")


@query()
def publish_changed(spark, d):
    """Months of orders whose content is not what was published: since then prices of urgent orders changed."""
    orders = table(spark, d, "orders").withColumn("partition_date", month_key(F.to_date("o_orderdate")))
    columns = [F.col(c) for c in orders.columns]
    versions = lambda rows: rows.groupBy("partition_date").agg(rows_checksum(columns).alias("version"))
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > PRICE_CHANGED)
    before = orders.withColumn("o_totalprice", F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    log = versions(before).withColumns({"zones_digest": F.lit("z"), "published_at": F.current_timestamp()})
    return monthly.pending_publications(versions(orders), log, "z").select("partition_date")


@query()
def json_props(spark, d):
    key = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, d, "events").groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("events"))


@query()
def plan_sources(spark, d):
    return planned_sources(order_months(spark, d), Settings(root="/data"))


# Names, types, quality


@query("rename_canonical")
def canonical_names(spark, d):
    return rename_canonical(view(spark, d, "raw_trips"))


@query("cast_types")
def cast_feed_types(spark, d):
    """A feed that delivers every column as text."""
    feed = trips(spark, d)
    return cast_types(feed.select(*(F.col(c).cast("string").alias(c) for c in feed.columns))).select(
        F.col("trip_key").cast("bigint").alias("trip_key"), *REQUIRED
    )


@query()
def classify_counts(spark, d):
    return quality(spark, d).counts().select(
        "total_rows",
        "valid_rows",
        "invalid_rows",
        "quarantined_rows",
        "null_rows",
        "duplicate_rows",
        "outlier_rows",
        "null_and_invalid_rows",
    )


@query()
def rule_counts(spark, d):
    return quality(spark, d).row_profile().select(*(rule.name for rule in TRIP_RULES))


@query()
def rule_flags(spark, d):
    names = [rule.name for rule in TRIP_RULES]
    return quality(spark, d).flags().select(
        "trip_key", "pickup_datetime", *names, "is_null", "is_outlier"
    )


@query()
def valid_rows(spark, d):
    return quality(spark, d).valid()


@query()
def invalid_rows(spark, d):
    return quality(spark, d).invalid()


@query()
def quarantined_rows(spark, d):
    return quality(spark, d).quarantined()


@query()
def null_rows(spark, d):
    return quality(spark, d).nulls()


@query()
def duplicate_rows(spark, d):
    return quality(spark, d).duplicates()


@query()
def outlier_rows(spark, d):
    return quality(spark, d).outliers()


@query()
def violation_reasons(spark, d):
    invalid = quality(spark, d).invalid()
    return invalid.groupBy("violation_reasons").agg(F.count(F.lit(1)).alias("rows_found"))


@query()
def quarantine_reasons(spark, d):
    held = quality(spark, d).quarantined()
    return held.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("rows_found"))


@query()
def outcome_rows(spark, d):
    """What one write job lays down for all three classes."""
    return quality(spark, d).outcomes()


@query()
def quality_report(spark, d):
    report = quality(spark, d).report()
    flat = [
        F.col(f"{group}.{name}").alias(f"{group}_{name}")
        for group in ("null_counts", "error_categories", "quarantine_categories")
        for name in report.schema[group].dataType.names
    ]
    ranges = [
        F.col(f"numeric_minmax.{name}.{end}").alias(f"{name}_{end}")
        for name in report.schema["numeric_minmax"].dataType.names
        for end in ("min", "max")
    ]
    totals = ("total_rows", "valid_rows", "invalid_rows", "quarantined_rows", "duplicate_count")
    return report.select(*totals, *flat, *ranges)


@query()
def threshold_gate(spark, d):
    return quality(spark, d).gate(0.20, 0.10)


# Derived columns


@query("normalize")
def normalized_trips(spark, d):
    staged = normalized(spark, d)
    return staged.select("trip_key", *staging_columns(staged).columns)


@query()
def payment_labels(spark, d):
    codes = trips(spark, d).groupBy("payment_type").agg(F.count(F.lit(1)).alias("trips"))
    return codes.select("payment_type", payment_label(F.col("payment_type")).alias("label"), "trips")


@query()
def weekday_demand(spark, d):
    return normalized(spark, d).groupBy("pickup_day_of_week").agg(
        F.count(F.lit(1)).alias("trips"), stable_sum(F.col("total_charge")).alias("revenue")
    )


@query()
def avg_speed(spark, d):
    return normalized(spark, d).select("trip_key", "pickup_datetime", "average_speed")


@query()
def airport_trips(spark, d):
    return normalized(spark, d).groupBy("is_airport_trip").agg(
        F.count(F.lit(1)).alias("trips"), stable_avg(F.col("trip_distance")).alias("avg_miles")
    )


@query()
def total_charge(spark, d):
    return normalized(spark, d).select("trip_key", "pickup_datetime", "total_charge")


@query()
def wmo_labels(spark, d):
    code = F.get_json_object("props", "$.k").cast("bigint")
    codes = table(spark, d, "events").groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return codes.select("code", weather_label(F.col("code")).alias("label"), F.col("n").alias("events"))


@query()
def hour_bucket_demand(spark, d):
    return rides(spark, d).groupBy(hour_start(F.col("pickup_datetime")).alias("pickup_hour")).agg(
        F.count(F.lit(1)).alias("rides")
    )


@query()
def month_series(spark, d):
    """Orders per month of the calendar, empty months included."""
    orders = table(spark, d, "orders")
    found = orders.groupBy(month_key(F.col("o_orderdate")).alias("partition_date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    months = order_months(spark, d).join(found, "partition_date", "left")
    return months.select("partition_date", "month_start", F.coalesce("n", F.lit(0)).alias("orders"))


@query()
def day_series(spark, d):
    """Events per day of the calendar, empty days included."""
    events = table(spark, d, "events")
    ends = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    days = ends.select(F.explode(day_sequence(F.col("first"), F.col("last"))).alias("day"))
    found = events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(found, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("events"))


@query()
def month_bounds(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").groupBy(
        F.trunc(day, "month").alias("first_day"), F.last_day(day).alias("last_day")
    ).agg(F.count(F.lit(1)).alias("orders"))


# Joins


@query("enrich_hourly")
def enriched_hourly(spark, d):
    return curated(spark, d)


@query("enrich_hourly_dedupe")
def enriched_hourly_dedupe(spark, d):
    """Two readings per hour, one of them kept."""
    hours = weather(spark, d)
    doubled = hours.unionByName(hours.withColumn("temperature", F.col("temperature") + 1.0))
    return enrich_hourly(rides(spark, d), doubled, dedupe=True).select(
        "trip_key", "temperature", "weather_condition", "weather_joined"
    )


@query("enrich_hourly_fan_out")
def enriched_hourly_fan_out(spark, d):
    """Two readings per hour double the trips of that hour."""
    hours = weather(spark, d)
    doubled = hours.unionByName(hours.withColumn("temperature", F.col("temperature") + 1.0))
    return enrich_hourly(rides(spark, d), doubled).groupBy("weather_joined").agg(
        F.count(F.lit(1)).alias("trips"), stable_sum(F.col("temperature")).alias("temperatures")
    )


@query("weather_coverage")
def weather_coverage_of_rides(spark, d):
    return weather_coverage(curated(spark, d))


@query()
def stg_trips(spark, d):
    return mart_plans.stg_trips(curated(spark, d))


@query()
def fct_trips(spark, d):
    return fact(spark, d)


@query()
def orphan_pickup_zones(spark, d):
    return orphans(fact(spark, d), "pickup_location_id", zones(spark, d), "location_id").select(
        "pickup_location_id", F.col("rows").alias("trips")
    )


@query()
def orphan_dropoff_zones(spark, d):
    return orphans(fact(spark, d), "dropoff_location_id", zones(spark, d), "location_id").select(
        "dropoff_location_id", F.col("rows").alias("trips")
    )


# Marts and serving


@query()
def daily_demand(spark, d):
    return mart_plans.daily_demand(normalized(spark, d))


@query()
def hourly_demand(spark, d):
    return mart_plans.hourly_demand(normalized(spark, d))


@query()
def route_performance(spark, d):
    return mart_plans.route_performance(normalized(spark, d))


@query()
def weather_impact(spark, d):
    return impact(spark, d)


@query()
def mart_row_counts(spark, d):
    return mart_plans.mart_row_counts(marts(spark, d)).select("mart", F.col("rows").alias("mart_rows"))


@query()
def demand_all(spark, d):
    return serving.demand(demand_marts(spark, d))


@query()
def demand_filtered(spark, d):
    return serving.demand(demand_marts(spark, d), DEMAND_START, DEMAND_END, DEMAND_ZONE)


@query()
def revenue_by_date(spark, d):
    return serving.revenue(demand_marts(spark, d))


@query()
def top_routes(spark, d):
    return serving.routes(demand_marts(spark, d))


@query()
def weather_impact_filtered(spark, d):
    return serving.weather_impact(marts(spark, d), WEATHER_START, WEATHER_END, WEATHER_LABEL)


@query()
def kpi(spark, d):
    return serving.kpi(demand_marts(spark, d), DEMAND_START, DEMAND_END)


@query()
def daily_trips_in_range(spark, d):
    return serving.trips_by_day(demand_marts(spark, d), DEMAND_START, DEMAND_END)


@query()
def trips_by_hour(spark, d):
    return serving.trips_by_hour(demand_marts(spark, d))


@query()
def top_zones(spark, d):
    return serving.top_zones(demand_marts(spark, d), DEMAND_START, DEMAND_END)


@query()
def top_zone_ids(spark, d):
    return serving.top_zone_ids(demand_marts(spark, d))


@query()
def revenue_trend(spark, d):
    return serving.revenue_trend(demand_marts(spark, d), DEMAND_START, DEMAND_END)


@query()
def top_routes_named(spark, d):
    return serving.top_routes_named(demand_marts(spark, d))


@query()
def weather_summary(spark, d):
    return serving.weather_summary(marts(spark, d))


@query()
def payment_breakdown(spark, d):
    return serving.payment_breakdown(normalized(spark, d))


# Dataset tests: a summary row where a sound table gives no violations


def _summary(rows, violations):
    return checks.summary(rows, violations)


@query()
def not_null_check(spark, d):
    rows = fact(spark, d)
    return _summary(rows, checks.not_null(rows, "weather_condition"))


@query()
def unique_zone_ids(spark, d):
    rows = zones(spark, d)
    return _summary(rows, checks.unique(rows, "location_id"))


@query()
def unique_trip_keys(spark, d):
    return checks.unique(trips(spark, d), "trip_key").select("trip_key", F.col("rows").alias("trips"))


@query()
def accepted_payment(spark, d):
    rows = normalized(spark, d)
    labels = list(PAYMENT_LABELS.values())
    return _summary(rows, checks.accepted_values(rows, "payment_type", labels))


@query()
def accepted_event_types(spark, d):
    rows = table(spark, d, "events")
    return checks.accepted_values(rows, "event_type", ["view", "click"]).select(
        "event_type", F.col("rows").alias("events")
    )


@query()
def dup_keys_daily(spark, d):
    rows = demand_marts(spark, d).daily_demand
    return _summary(rows, checks.unique_together(rows, ["date", "pickup_location_id"]))


@query()
def dup_keys_hourly(spark, d):
    rows = demand_marts(spark, d).hourly_demand
    return _summary(rows, checks.unique_together(rows, ["date", "hour"]))


@query()
def dup_keys_route(spark, d):
    rows = demand_marts(spark, d).route_performance
    return _summary(
        rows, checks.unique_together(rows, ["pickup_location_id", "dropoff_location_id"])
    )


@query()
def dup_keys_weather(spark, d):
    rows = impact(spark, d)
    return _summary(
        rows, checks.unique_together(rows, ["date", "weather_condition", "precipitation"])
    )


@query()
def mart_check_results(spark, d):
    """All dataset tests over the ride fact and its marts."""
    rides_fact = fact(spark, d)
    return checks.mart_check_results(
        checks.fact_profile(rides_fact), mart_plans.build_marts(rides_fact, zones(spark, d))
    )


@query()
def curated_null_counts(spark, d):
    return checks.null_counts(
        curated(spark, d),
        ("pickup_datetime", "pickup_location_id", "total_charge", "average_speed", "temperature"),
    )


@query()
def curated_ranges(spark, d):
    return checks.value_ranges(
        curated(spark, d),
        ("trip_distance", "trip_duration_seconds", "pickup_hour", "total_charge"),
    )


@query()
def reconcile_counts(spark, d):
    """Total, valid and normalized rows of one pass each; the last two must agree."""
    checked = quality(spark, d)
    total = checked.counts().select("total_rows", "valid_rows")
    staged = normalize(checked.valid()).agg(F.count(F.lit(1)).alias("normalized_rows"))
    return union_by_name([total, staged]).agg(
        F.max("total_rows").alias("total_rows"),
        F.max("valid_rows").alias("valid_rows"),
        F.max("normalized_rows").alias("normalized_rows"),
        (F.max("valid_rows") == F.max("normalized_rows")).alias("reconciled"),
    )


@query("dates_written")
def written_dates(spark, d):
    return dates_written(normalized(spark, d))


# History, manifest, orchestration


@query()
def runs_upsert(spark, d):
    """A log with the start and the end of every run, reduced to its latest states."""
    final = runs(spark, d)
    started = final.withColumns(
        {
            "status": F.lit("running"),
            "completed_at": F.lit(None).cast("timestamp_ntz"),
            "input_rows": F.lit(None).cast("bigint"),
            "output_rows": F.lit(None).cast("bigint"),
            "error_message": F.lit(None).cast("string"),
            "recorded_at": F.col("started_at"),
        }
    )
    ended = final.where("completed_at is not null").withColumn("recorded_at", F.col("completed_at"))
    return history.latest_runs(started.unionByName(ended))


@query()
def list_runs(spark, d):
    return serving.pipeline_runs(runs(spark, d))


@query()
def latest_run_per_partition(spark, d):
    return history.latest_run_per_partition(runs(spark, d))


@query()
def latest_run(spark, d):
    return history.latest_run(runs(spark, d))


@query()
def completed_partitions(spark, d):
    return history.completed_partitions(runs(spark, d))


@query()
def pending_partitions(spark, d):
    planned = order_months(spark, d).select("partition_date")
    return history.pending_partitions(planned, gap_runs(spark, d), "trips")


@query()
def manifest_upsert(spark, d):
    return manifest(spark, d)


@query()
def manifest_lookup(spark, d):
    return history.manifest_lookup(manifest(spark, d), "1-URGENT", "1997-03")


@query()
def list_ingestions(spark, d):
    return history.list_ingestions(manifest(spark, d)).select(
        "source_name", "partition_date", "downloaded_at", "file_size", "row_count", "status"
    )


@query()
def rows_per_source(spark, d):
    return history.rows_per_source(manifest(spark, d))


@query()
def ingest_summary(spark, d):
    return history.ingest_summary(manifest(spark, d))


@query()
def pending_ingests(spark, d):
    """Sources by month; a folder holds what the largest download of its month left behind."""
    log = view(spark, d, "manifest_log")
    path = F.concat_ws("/", "source_name", "partition_date")
    sources = log.select("source_name").distinct()
    months = order_months(spark, d).agg(F.array_agg("partition_date").alias("months"))
    # One row with all months of the calendar.
    planned = sources.crossJoin(F.broadcast(months)).select(
        "source_name", F.explode("months").alias("partition_date")
    )
    planned = planned.withColumn("file_path", F.concat(path, F.lit("/part.parquet")))
    folders = log.groupBy(path.alias("folder")).agg(F.max("file_size").alias("file_size"))
    return history.pending_ingests(planned, manifest(spark, d), folders)


# Metrics and alerts


@query()
def run_metrics(spark, d):
    return observe.run_metrics(runs(spark, d), manifest(spark, d))


@query()
def metric_rules(spark, d):
    return observe.metric_rules(observe.run_metrics(runs(spark, d), manifest(spark, d)))


@query()
def row_count_change(spark, d):
    return observe.row_count_change(runs(spark, d))


@query()
def missing_partitions(spark, d):
    return observe.missing_partitions(gap_runs(spark, d))


@query()
def alerts(spark, d):
    return observe.alerts(gap_runs(spark, d))
