from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import plan_of

from tripmill.functions.calendar import hour_start, whole_seconds
from tripmill.functions.labels import payment_label, weather_label
from tripmill.functions.measures import LIMB, mean_of, merged_parts, stable_avg, stable_sum, sum_of
from tripmill.operators import joins
from tripmill.operators.joins import dimension_join, enrich_hourly, fits_broadcast, weather_coverage
from tripmill.operators.normalize import normalize, staging_columns
from tripmill.schema import PAYMENT_LABELS, STAGING_COLUMNS, WEATHER_LABELS
from tripmill.sources.weather import parse_weather, weather_document
from pyspark.sql import functions as F


@pytest.fixture
def own_trips(make_trips):
    """A Sunday night, a Thursday noon and a ride across midnight."""
    return make_trips(
        {"pickup_datetime": datetime(2024, 9, 1, 23, 30), "dropoff_datetime": datetime(2024, 9, 2, 0, 54), "trip_distance": 21.0,
         "pickup_location_id": 7, "dropoff_location_id": 1, "payment_type": 4, "fare_amount": 61.25, "tip_amount": 0.0, "passenger_count": 5},
        {"pickup_datetime": datetime(2024, 9, 5, 12, 0, 30), "dropoff_datetime": datetime(2024, 9, 5, 12, 12, 30), "trip_distance": 1.6,
         "pickup_location_id": 44, "dropoff_location_id": 45, "payment_type": 0, "fare_amount": 9.5, "tip_amount": 1.75, "passenger_count": None},
        {"pickup_datetime": datetime(2024, 12, 31, 23, 59, 59), "dropoff_datetime": datetime(2025, 1, 1, 0, 0, 4), "trip_distance": 0.05,
         "pickup_location_id": 138, "dropoff_location_id": 138, "payment_type": 3, "fare_amount": 3.0, "tip_amount": 0.5, "passenger_count": 0},
    )


def test_derived_columns(own_trips):
    staged = normalize(own_trips)
    rows = staged.orderBy("pickup_datetime").collect()
    assert [(r.pickup_date, r.pickup_hour, r.pickup_day_of_week) for r in rows] == [
        (date(2024, 9, 1), 23, 6),
        (date(2024, 9, 5), 12, 3),
        (date(2024, 12, 31), 23, 1),
    ]
    assert [r.trip_duration_seconds for r in rows] == [84 * 60, 720, 5]
    assert [r.average_speed for r in rows] == pytest.approx([15.0, 8.0, 36.0])
    assert [r.payment_type for r in rows] == ["dispute", "not_recorded", "no_charge"]
    assert [r.total_charge for r in rows] == [61.25, 11.25, 3.5]
    assert [r.passenger_count for r in rows] == [5, 0, 0]
    assert [r.is_airport_trip for r in rows] == [True, False, True]
    assert staging_columns(staged).columns == list(STAGING_COLUMNS)


def test_speed_is_null_without_duration(make_trips):
    still = make_trips({"dropoff_datetime": datetime(2025, 1, 1, 8)})
    assert normalize(still).first().average_speed is None


def test_charge_adds_present_money_columns_only(make_trips):
    row = normalize(
        make_trips({"tip_amount": None})
        .withColumn("cbd_congestion_fee", F.lit(0.75))
        .withColumn("total_amount", F.lit(99.0))
    ).first()
    assert row.total_charge == 12.75
    without = make_trips({}).drop("fare_amount", "tip_amount")
    assert "total_charge" not in normalize(without).columns


def test_labels(spark):
    codes = spark.createDataFrame([(c,) for c in (0, 1, 6, 9, None)], "code bigint")
    found = [r[0] for r in codes.select(payment_label(F.col("code"))).collect()]
    assert found == ["not_recorded", "credit_card", "voided_trip", "unknown", "unknown"]
    codes = spark.createDataFrame([(c,) for c in (0, 61, 2, 63, 999, None)], "code bigint")
    found = [r[0] for r in codes.select(weather_label(F.col("code"))).collect()]
    assert found == ["clear", "light_rain", "partly_cloudy", "rain", "unknown", "unknown"]
    assert (len(PAYMENT_LABELS), len(WEATHER_LABELS)) == (7, 28)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_stay_naive_around_clock_changes(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql(
            "select timestamp_ntz'2024-03-10 01:30:00' a, timestamp_ntz'2024-03-10 02:45:10.9' b"
        ).select(
            hour_start(F.col("b")).alias("hour"),
            whole_seconds(F.col("a"), F.col("b")).alias("up"),
            whole_seconds(F.col("b"), F.col("a")).alias("down"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.hour == datetime(2024, 3, 10, 2)
    assert (row.up, row.down) == (4510, -4510)


def test_sums_do_not_depend_on_order(spark):
    rows = spark.range(10_000).selectExpr("cast(id % 97 as double) / 100 as v", "rand(3) as r")
    totals = {
        rows.orderBy(*order).coalesce(n).agg(stable_sum(F.col("v"))).first()[0]
        for order, n in ((["r"], 1), (["v"], 3), ([F.desc("v")], 7))
    }
    assert len(totals) == 1
    assert totals.pop() == pytest.approx(sum((i % 97) / 100 for i in range(10_000)))


def test_sums_of_unusual_values(spark):
    def both(*values):
        rows = spark.createDataFrame([(v,) for v in values], "v double")
        return tuple(rows.agg(stable_sum(F.col("v")), stable_avg(F.col("v"))).first())

    assert both(1.5, None) == (1.5, 1.5)
    assert both(None) == (None, None)
    assert both(1e300, 1.0)[0] == pytest.approx(1e300)
    assert str(both(float("nan"), 1.0)[0]) == "nan"
    assert both(float("inf"), 1.0)[0] == float("inf")
    assert both(-0.25, -7.125, 7.0) == (-0.375, -0.125)


def test_small_large_and_many_values(spark):
    def total(value, rows):
        return spark.range(rows).select(F.lit(value).alias("v")).agg(stable_sum(F.col("v"))).first()[0]

    assert total(4e-6, 1_000_000) == pytest.approx(4.0)
    assert total(8e10, 2_000) == 1.6e14
    assert total(9.9e9, 2_000) == 1.98e13
    # On both sides of a round amount, of either sign.
    for edge in (999.99, 1000.0, 1000.01, -999.99, -1000.0, -1000.01):
        assert total(edge, 3_000) == edge * 3_000
    mixed = spark.range(4_000).selectExpr("case when id % 2 = 0 then 0.01 else -123456.78 end as v")
    assert mixed.agg(stable_sum(F.col("v").cast("double"))).first()[0] == pytest.approx(-246913540.0, abs=1e-6)
    # Parts of 10**11 rows of about 10**5 each.
    units, rows = 10**10 + 3, 10**11
    high, low = units // LIMB * rows, units % LIMB * rows
    parts = spark.createDataFrame([(high, low, 0.0, rows)], "v_high long, v_low long, v_rest double, v_n long")
    sums = merged_parts("v")
    got = parts.unionByName(parts).agg(sum_of(sums), mean_of(sums)).first()
    assert tuple(got) == (pytest.approx(2 * units * rows / 1e5), pytest.approx(units / 1e5))


DOCUMENT = """{"timezone": "America/New_York", "hourly": {
 "time": ["2024-09-01T22:00", "2024-09-01T23:00", "2024-09-05T12:00", "2024-09-05T13:00"],
 "temperature_2m": [17.25, 16.5, 24.75, 25.5], "precipitation": [1.1, 0.6, 0.0, 0.0],
 "wind_speed_10m": [14.0, 12.5, 3.0, 2.5], "weather_code": [63, 80, 1, 45]}}"""


@pytest.fixture
def weather(spark):
    texts = spark.createDataFrame([(DOCUMENT,)], "text string")
    return parse_weather(texts.select(weather_document(F.col("text")).alias("d")).select("d.*"))


def test_weather_document(weather):
    rows = weather.orderBy("weather_hour").collect()
    labels = [WEATHER_LABELS[code] for code in (63, 80, 1, 45)]
    assert [r.weather_condition for r in rows] == labels
    assert [(r.weather_hour.day, r.weather_hour.hour) for r in rows] == [(1, 22), (1, 23), (5, 12), (5, 13)]
    names = ("weather_hour", "temperature", "precipitation", "wind_speed", "weather_condition")
    assert weather.columns == list(names)


@pytest.fixture
def hourly_trips(own_trips):
    return own_trips


def test_hour_join_and_coverage(hourly_trips, weather):
    enriched = enrich_hourly(hourly_trips, weather)
    rows = enriched.orderBy("pickup_datetime").collect()
    assert [r.temperature for r in rows] == [16.5, 24.75, None]
    assert [r.weather_joined for r in rows] == [True, True, False]
    coverage = weather_coverage(enriched).first()
    assert (coverage.total_rows, coverage.unmatched_rows) == (3, 1)
    assert coverage.coverage == pytest.approx(2 / 3)
    assert weather_coverage(enriched.where("false")).first().coverage == 0.0


def test_matched_hour_without_temperature_is_unmatched(hourly_trips, weather):
    unknown = weather.withColumn("temperature", F.lit(None).cast("double"))
    assert weather_coverage(enrich_hourly(hourly_trips, unknown)).first().unmatched_rows == 3


def test_two_readings_double_the_trips_unless_deduped(hourly_trips, weather):
    twice = weather.unionByName(weather)
    assert enrich_hourly(hourly_trips, twice).count() == 5
    assert enrich_hourly(hourly_trips, twice, dedupe=True).count() == 3


def test_small_weather_is_broadcast_and_trips_are_not_shuffled(hourly_trips, weather):
    plan = plan_of(enrich_hourly(hourly_trips, weather))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("how", ["left", "inner"])
def test_only_hot_keys_of_a_large_dimension_are_salted(spark, how):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(60_000).selectExpr("if(id % 3 = 0, 7, id % 5000) as k", "id % 11 as v")
        dim = spark.range(4000).selectExpr("id as k", "concat('n', id) as name")
        assert [r.k for r in joins.hot_keys(fact, ["k"], 100).collect()] == [7]
        salted = dimension_join(fact, dim, ["k"], how, fits=False, salts=8)
        plain = fact.join(dim, "k", how)
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
        assert "SortMergeJoin" in plan_of(salted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_broadcast_needs_a_measured_size(spark):
    dim = spark.range(100).selectExpr("id", "repeat('x', 10) as t")
    assert fits_broadcast(dim)
    assert not fits_broadcast(dim, max_rows=99)
    assert not fits_broadcast(dim, max_text_bytes=999)
    assert joins.MAX_BROADCAST_ROWS < 1_000_000
