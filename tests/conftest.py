from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tripmill.session import build_session  # noqa: E402

CANONICAL = (
    "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count bigint, "
    "trip_distance double, pickup_location_id bigint, dropoff_location_id bigint, "
    "payment_type bigint, fare_amount double, tip_amount double"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "4000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_trips(spark):
    def make(*rows: dict):
        base = {
            "pickup_datetime": datetime(2025, 1, 1, 8),
            "dropoff_datetime": datetime(2025, 1, 1, 8, 30),
            "passenger_count": 1,
            "trip_distance": 2.5,
            "pickup_location_id": 132,
            "dropoff_location_id": 200,
            "payment_type": 1,
            "fare_amount": 12.0,
            "tip_amount": 2.0,
        }
        return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], CANONICAL)

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
