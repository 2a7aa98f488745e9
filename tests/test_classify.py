from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tripmill.errors import QualityError
from tripmill.operators.canonical import canonical_trips, cast_types, check_structure, rename_canonical
from tripmill.operators.classify import Classification
from tripmill.operators.copies import fold_copies, unfold_copies
from tripmill.operators.rules import RULES_BY_NAME, TRIP_RULES


def at(hour, minute=0, day=1):
    return datetime(2025, 1, day, hour, minute)


# Changes to a sound trip, the rules it breaks, and why it is held back.
CASES = (
    ({"tip_amount": -0.01, "pickup_location_id": 11}, "negative_tip", None),
    ({"fare_amount": -7.5, "payment_type": 42}, "negative_fare, invalid_payment_type", None),
    ({"dropoff_location_id": 0}, "invalid_dropoff_location", None),
    ({"passenger_count": -2, "trip_distance": 250.5}, "invalid_passenger_count", None),
    ({"dropoff_datetime": at(7, 59), "pickup_location_id": 266}, "dropoff_before_pickup, invalid_pickup_location", None),
    ({"payment_type": None}, None, "null"),
    ({"dropoff_location_id": None, "tip_amount": -1.0}, "negative_tip", "null"),
    ({"trip_distance": 200.5}, None, "outlier"),
    ({"dropoff_datetime": at(8, 1, day=2)}, None, "outlier"),
    ({"trip_distance": 200.0}, None, None),
    ({"dropoff_datetime": at(8, day=2)}, None, None),
    ({"passenger_count": None}, None, None),
    ({"pickup_location_id": 17}, None, None),
    ({"pickup_location_id": 17}, None, "duplicate"),
    ({"pickup_location_id": 17}, None, "duplicate"),
)


@pytest.fixture
def defects(make_trips):
    return make_trips(*(changes for changes, _, _ in CASES))


def test_each_case_gets_its_classes(defects):
    quality = Classification(defects)
    assert quality.valid().count() == sum(not broken and not held for _, broken, held in CASES)
    invalid = quality.invalid().select("violation_reasons").collect()
    assert Counter(r[0] for r in invalid) == Counter(broken for _, broken, _ in CASES if broken)
    held = quality.quarantined().select("quarantine_reason").collect()
    assert Counter(r[0] for r in held) == Counter(held for _, _, held in CASES if held)


def test_report_numbers(defects):
    report = Classification(defects).report().first()
    assert (report.total_rows, report.valid_rows, report.invalid_rows) == (15, 4, 6)
    assert (report.quarantined_rows, report.duplicate_count) == (6, 2)
    assert report.null_counts.payment_type == 1 and report.null_counts.passenger_count == 1
    errors = report.error_categories.asDict()
    assert (errors["negative_tip"], errors["invalid_payment_type"], errors["negative_distance"]) == (2, 1, 0)
    assert report.quarantine_categories.asDict() == {"null": 2, "duplicate": 2, "outlier": 2}
    assert report.numeric_minmax.fare_amount.asDict() == {"min": -7.5, "max": 12.0}
    assert report.numeric_minmax.passenger_count.asDict() == {"min": -2.0, "max": 1.0}


def test_row_profile_agrees_with_report(defects):
    quality = Classification(defects)
    profile, report = quality.row_profile().first(), quality.report().first()
    assert profile.total_rows == report.total_rows
    assert profile.invalid_rows == report.invalid_rows
    assert profile["null"] == report.quarantine_categories["null"]
    for rule in TRIP_RULES:
        assert profile[rule.name] == report.error_categories[rule.name]


def test_outcomes_equal_the_three_sets(defects):
    rows = Counter(
        (r["class"], r.violation_reasons, r.quarantine_reason)
        for r in Classification(defects).outcomes().collect()
    )
    expected = Counter()
    for _, broken, held in CASES:
        if broken:
            expected["invalid", broken, None] += 1
        if held:
            expected["quarantined", None, held] += 1
        if not broken and not held:
            expected["valid", None, None] += 1
    assert rows == expected


def test_null_and_broken_rule_is_in_both_sets(make_trips):
    quality = Classification(make_trips({"trip_distance": None, "fare_amount": -3.0}))
    assert quality.invalid().count() == 1
    assert quality.quarantined().first().quarantine_reason == "null"
    assert quality.valid().count() == 0
    assert sorted(r["class"] for r in quality.outcomes().collect()) == ["invalid", "quarantined"]
    counts = quality.counts().first()
    assert (counts.total_rows, counts.null_and_invalid_rows) == (1, 1)


def test_copies_with_any_null_are_not_duplicates(make_trips):
    quality = Classification(make_trips(*[{"passenger_count": None}] * 3, {}, {}))
    assert quality.valid().count() == 4
    assert quality.duplicates().count() == 1
    counts = quality.counts().first()
    assert (counts.valid_rows, counts.duplicate_rows) == (4, 1)


def test_copies_of_an_outlier_are_duplicates_after_the_first(make_trips):
    quality = Classification(make_trips(*[{"trip_distance": 500.0}] * 3))
    reasons = Counter(r.quarantine_reason for r in quality.quarantined().collect())
    assert reasons == {"outlier": 1, "duplicate": 2}


def test_copies_of_an_invalid_row_are_all_invalid(make_trips):
    quality = Classification(make_trips(*[{"tip_amount": -1.0}] * 3))
    assert quality.invalid().count() == 3
    assert quality.quarantined().count() == 0
    assert quality.counts().first().invalid_rows == 3


def test_soft_null_stays_valid(make_trips):
    assert Classification(make_trips({"passenger_count": None})).valid().count() == 1


@pytest.mark.parametrize(
    "change, expected",
    [
        ({"trip_distance": 200.0}, False),
        ({"trip_distance": 200.1}, True),
        ({"dropoff_datetime": datetime(2025, 1, 2, 8)}, False),
        ({"dropoff_datetime": datetime(2025, 1, 2, 8, 0, 1)}, True),
        ({"trip_distance": None, "dropoff_datetime": datetime(2025, 1, 3)}, True),
        ({"trip_distance": None}, False),
        ({"trip_distance": float("nan")}, True),
    ],
)
def test_outlier_bounds(make_trips, change, expected):
    assert Classification(make_trips(change)).flags().first().is_outlier is expected


def test_all_broken_rules_are_listed_in_rule_order(make_trips):
    row = Classification(make_trips({"fare_amount": -1.0, "payment_type": 9, "trip_distance": -1.0}))
    assert row.invalid().first().violation_reasons == (
        "negative_distance, negative_fare, invalid_payment_type"
    )


def test_rules_by_name():
    assert len(TRIP_RULES) == 8
    assert "tip_amount" in RULES_BY_NAME["negative_tip"].predicate


def test_gate_limits_are_exclusive(make_trips):
    four_valid_one_invalid = make_trips(
        *[{"pickup_datetime": at(h), "dropoff_datetime": at(h, 5)} for h in range(4)],
        {"fare_amount": -1.0},
    )
    quality = Classification(four_valid_one_invalid)
    assert quality.gate(0.20, 0.10).first().passed
    assert not quality.gate(0.19, 0.10).first().passed
    empty = Classification(four_valid_one_invalid.where("false"))
    row = empty.gate(0.2, 0.1).first()
    assert (row.total_rows, row.invalid_ratio, row.passed) == (0, 0.0, True)


def test_empty_table_counts_zero(make_trips):
    counts = Classification(make_trips({}).where("false")).counts().first().asDict()
    assert set(counts.values()) == {0}


def test_missing_column_is_named(make_trips):
    with pytest.raises(QualityError, match="fare_amount"):
        canonical_trips(make_trips({}).drop("fare_amount"))


def test_rename_touches_only_present_columns(spark):
    raw = spark.createDataFrame([(1, 2, 3)], "PULocationID int, Airport_fee int, cbd_congestion_fee int")
    renamed = rename_canonical(raw)
    assert renamed.columns == ["pickup_location_id", "airport_fee", "cbd_congestion_fee"]


def test_casts_are_strict(spark, make_trips):
    text = make_trips({}).withColumn("trip_distance", F.lit("2.5"))
    assert cast_types(text).first().trip_distance == 2.5
    bad = make_trips({}).withColumn("trip_distance", F.lit("far"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_types(bad).collect()


def test_structure_check_needs_no_job(make_trips):
    wrong = make_trips({}).withColumn("payment_type", F.lit("1"))
    with pytest.raises(QualityError, match="payment_type"):
        check_structure(wrong)


def test_hot_copies_fold_and_unfold(spark):
    rows = spark.range(2000).selectExpr("if(id < 1500, 0, id) as k", "1.5 as v")
    folded = fold_copies(rows)
    assert folded.count() == 501
    back = unfold_copies(folded, light=10, block=100)
    expected = Counter((r.k, r.v) for r in rows.collect())
    assert Counter((r.k, r.v) for r in back.collect()) == expected


def test_hot_copies_are_spread_over_tasks(spark):
    hot = spark.range(1).selectExpr("7 as k", "10000L as copies")
    sizes = unfold_copies(hot, light=10, block=100).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 10000
    assert len(sizes) > 1


def test_a_third_of_the_table_is_one_row(make_trips, spark):
    varied = spark.range(600).selectExpr("cast(id as double) / 10 as d")
    base = make_trips({})
    rows = (
        base.drop("trip_distance")
        .join(varied.selectExpr("d as trip_distance").unionByName(
            spark.range(300).selectExpr("cast(99.5 as double) as trip_distance")), how="cross")
        .select(*base.columns)
    )
    quality = Classification(rows)
    counts = quality.counts().first()
    assert (counts.total_rows, counts.valid_rows, counts.duplicate_rows) == (900, 601, 299)
    assert quality.valid().count() == 601
    assert quality.duplicates().count() == 299


def test_invalid_rows_need_no_exchange(make_trips):
    assert "Exchange" not in plan_of(Classification(make_trips({}, {})).invalid())


def test_copies_fold_before_the_exchange(make_trips):
    quality = Classification(make_trips({}, {}))
    plan = plan_of(quality.valid())
    aggregates, exchange = plan.split("Exchange hashpartitioning")
    assert aggregates.count("HashAggregate") == exchange.count("HashAggregate") == 1
    assert "Window" not in plan and "Python" not in plan


def test_few_and_many_copies_share_one_exchange(make_trips):
    outcomes = Classification(make_trips(*[{}] * 300, {"fare_amount": -1.0})).outcomes()
    assert len(outcomes.collect()) == 301
    final = plan_of(outcomes).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 1


def test_branch_for_many_copies_vanishes_when_there_are_none(make_trips):
    outcomes = Classification(make_trips({}, {}, {"fare_amount": -1.0})).outcomes()
    outcomes.collect()
    final = plan_of(outcomes).split("== Initial Plan ==")[0]
    assert "_block" not in final


# Two phases: digests first


@pytest.fixture
def mixed(make_trips):
    """Copies by the hundred, pairs, nulls, zeros of both signs, NaN, outliers and broken rules."""
    rows = [{"pickup_location_id": 1 + i % 200, "fare_amount": float(i)} for i in range(60)]
    rows += [{"pickup_location_id": 33}] * 700
    rows += [{"fare_amount": float(i)} for i in range(0, 60, 7)] + [{"fare_amount": float(i)} for i in range(0, 60, 7)]
    rows += [{"tip_amount": 0.0}, {"tip_amount": -0.0}, {"trip_distance": float("nan")}, {"trip_distance": float("nan")}]
    rows += [{"trip_distance": 300.0}] * 3 + [{"passenger_count": None}] * 4 + [{"payment_type": None}] * 2
    return make_trips(*rows, *(changes for changes, _, _ in CASES)).repartition(4)


def bag(rows):
    return Counter(map(str, rows.collect()))


@pytest.mark.parametrize("most", [0, 3, 200_000])
def test_measured_classes_are_the_same(mixed, most):
    plain, measured = Classification(mixed), Classification(mixed).measured(most)
    assert (measured.repeated is None) == (most < 200_000)
    for name in ("valid", "invalid", "quarantined", "duplicates", "outliers", "nulls", "counts", "report", "outcomes"):
        rows = getattr(plain, name)()
        assert getattr(measured, name)().columns == rows.columns
        assert bag(getattr(measured, name)()) == bag(rows), name


def test_measured_empty_table(make_trips):
    quality = Classification(make_trips({}).limit(0)).measured()
    assert quality.outcomes().isEmpty() and quality.counts().first().total_rows == 0


def test_measured_rows_without_copies_are_not_exchanged(make_trips):
    once = Classification(make_trips({}, {"fare_amount": 3.0})).measured()
    assert "Exchange" not in plan_of(once.valid())
    some = Classification(make_trips({}, {}, {"fare_amount": 3.0})).measured()
    plan = plan_of(some.valid())
    # One exchange for the whole rows of candidates, which are joined to the repeated digests before it.
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
