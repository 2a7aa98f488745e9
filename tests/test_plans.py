"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tripmill.operators.joins import orphans
from tripmill.operators.normalize import normalize
from tripmill.plans import marts as mart_plans, serving
from tripmill.plans.marts import Marts
from tripmill.sinks.files import read_marts, write_marts


@pytest.fixture
def stored_marts(spark, make_trips, tmp_path):
    days = [datetime(2025, 1, d, 8) for d in range(1, 11)]
    trips = make_trips(
        *(
            {"pickup_datetime": d, "pickup_location_id": 100 + d.day % 3, "fare_amount": 10.0 * d.day}
            for d in days
        ),
        {"pickup_datetime": days[0], "pickup_location_id": 250, "dropoff_location_id": 250},
    )
    fact = normalize(trips).withColumns(
        {
            "weather_condition": F.when(F.dayofmonth("pickup_date") < 4, F.lit("rain")),
            "precipitation": F.lit(0.5),
        }
    )
    zones = spark.createDataFrame(
        [(i, "b", f"z{i}", "s") for i in (100, 101, 102, 200)],
        "location_id int, borough string, zone string, service_zone string",
    )
    write_marts(mart_plans.build_marts(fact, zones), str(tmp_path))
    return read_marts(spark, str(tmp_path))


def test_given_filters_are_pushed_and_absent_ones_leave_no_trace(stored_marts):
    filtered = plan_of(serving.demand(stored_marts, date(2025, 1, 3), date(2025, 1, 5), 100))
    assert "GreaterThanOrEqual(date,2025-01-03)" in filtered
    assert "EqualTo(pickup_location_id,100)" in filtered
    assert "PushedFilters: []" in plan_of(serving.demand(stored_marts))


def test_only_needed_columns_are_read(stored_marts):
    plan = plan_of(serving.trips_by_day(stored_marts, date(2025, 1, 1), date(2025, 1, 9)))
    assert "ReadSchema: struct<date:date,trip_count:bigint>" in plan


def test_rankings_keep_the_top_rows_per_task(stored_marts):
    for ranked in (
        serving.routes(stored_marts),
        serving.top_zone_ids(stored_marts),
        serving.top_zones(stored_marts, date(2025, 1, 1), date(2025, 2, 1)),
        serving.top_routes_named(stored_marts),
    ):
        assert "TakeOrderedAndProject" in plan_of(ranked)


def test_marts_aggregate_before_their_only_exchange(make_trips):
    plan = plan_of(mart_plans.daily_demand(normalize(make_trips({}))))
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_orphans_shuffle_counted_keys_not_rows(make_trips, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(orphans(make_trips({}), "pickup_location_id", spark.range(1), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.index("LeftAnti") < plan.index("partial_count")


def test_serving_results(stored_marts):
    assert serving.demand(stored_marts).count() == 11
    assert serving.demand(stored_marts, start=date(2025, 1, 9)).count() == 2
    assert serving.demand(stored_marts, location_id=250).first().trip_count == 1
    revenue = serving.revenue(stored_marts, end=date(2025, 1, 1)).collect()
    assert [(r.trip_count, r.total_revenue) for r in revenue] == [(2, 26.0)]
    span = (date(2025, 1, 1), date(2025, 1, 31))
    assert serving.kpi(stored_marts, *span).first().trips == 11
    assert serving.kpi(stored_marts, date(2030, 1, 1), date(2030, 1, 2)).first().trips is None
    assert [r.hour for r in serving.trips_by_hour(stored_marts).collect()] == [8]
    zones = serving.top_zones(stored_marts, *span).collect()
    assert [(r.zone, r.trips) for r in zones] == [("z101", 4), ("z100", 3), ("z102", 3)]
    assert serving.top_zone_ids(stored_marts, 1).first().pickup_location_id == 101
    named = serving.top_routes_named(stored_marts).collect()
    assert len(named) == 3 and named[0].dropoff == "z200"
    assert serving.routes(stored_marts, 1000).count() == 4
    assert serving.weather_impact(stored_marts, weather_condition="rain").count() == 3
    conditions = serving.weather_summary(stored_marts).collect()
    assert [(r.weather_condition, r.trips) for r in conditions] == [(None, 7), ("rain", 4)]
    trend = serving.revenue_trend(stored_marts, *span).collect()
    assert [r.date.day for r in trend] == list(range(1, 11))


@pytest.mark.parametrize("limit", [0, -1, 1001])
def test_limits_are_checked(stored_marts, limit):
    with pytest.raises(ValueError):
        serving.routes(stored_marts, limit)


def test_null_revenue_ranks_first(spark):
    routes = spark.createDataFrame(
        [(1, 1, 5.0), (2, 2, None)],
        "pickup_location_id int, dropoff_location_id int, total_revenue double",
    )
    marts = Marts(None, None, None, routes, None)
    assert serving.routes(marts, 1).first().pickup_location_id == 2
