"""Time the headline stages; prints one JSON line.

The raw trips of the fixture view are first written as Parquet (not timed), so that a stage
starts from files as it does in production. Every stage runs once to warm up, then
``REPEATS`` times, and the median counts. Row-level stages go to a no-op sink, which
computes all columns of all rows without writing.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmill.operators.canonical import canonical_trips
from tripmill.operators.classify import Classification
from tripmill.operators.joins import enrich_hourly
from tripmill.operators.normalize import normalize
from tripmill.plans import marts as mart_plans, serving
from tripmill.plans.marts import Marts
from tripmill.session import build_session
from tripmill.sources.trips import union_relaxed
from verification.fixtures import view
from verification.queries import weather, zones

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
MONTH_ROWS = 3_480_000
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def noop(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def stored(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    rows.repartition(CPUS).write.parquet(path)
    return spark.read.parquet(path)


def timed(stage: Callable[[], object]) -> float:
    stage()
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        stage()
        times.append(time.perf_counter() - start)
    return statistics.median(times)


def main() -> None:
    conf = {
        "spark.sql.shuffle.partitions": str(CPUS),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    }
    spark = build_session("bench", f"local[{CPUS}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    # Local scratch of a single-machine run.
    scratch = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")

    raw = stored(spark, view(spark, SF_DIR, "raw_trips"), f"{scratch}/raw")
    rides = stored(spark, view(spark, SF_DIR, "rides"), f"{scratch}/rides")
    hours = stored(spark, weather(spark, SF_DIR), f"{scratch}/weather")
    names = stored(spark, zones(spark, SF_DIR), f"{scratch}/zones")
    trips = canonical_trips(raw)
    quality = Classification(trips)
    valid = stored(spark, quality.valid(), f"{scratch}/valid")
    staged = stored(spark, normalize(valid), f"{scratch}/staged")
    ride_stage = stored(spark, normalize(canonical_trips(rides)), f"{scratch}/ride_stage")
    curated = stored(spark, enrich_hourly(staged, hours), f"{scratch}/curated")
    facts = stored(spark, mart_plans.fct_trips(mart_plans.stg_trips(curated), names), f"{scratch}/fact")
    marts = Marts(
        **{
            name: stored(spark, mart, f"{scratch}/{name}")
            for name, mart in mart_plans.build_marts(facts, names).items().items()
        }
    )
    span = (date(1990, 1, 1), date(2030, 1, 1))

    stages: dict[str, tuple[DataFrame, Callable[[], object]]] = {
        "read_raw": (raw, lambda: noop(raw)),
        "classify_counts": (raw, lambda: quality.counts().collect()),
        "quality_report": (raw, lambda: quality.report().collect()),
        "threshold_gate": (raw, lambda: quality.gate(0.2, 0.1).collect()),
        "valid_rows": (raw, lambda: noop(quality.valid())),
        "outcomes": (raw, lambda: noop(quality.outcomes())),
        "normalize": (valid, lambda: noop(normalize(valid))),
        "enrich_hourly": (staged, lambda: noop(enrich_hourly(staged, hours))),
        "enrich_rides": (ride_stage, lambda: noop(enrich_hourly(ride_stage, hours))),
        "fct_trips": (
            curated,
            lambda: noop(mart_plans.fct_trips(mart_plans.stg_trips(curated), names)),
        ),
        "daily_demand": (facts, lambda: noop(mart_plans.daily_demand(facts))),
        "hourly_demand": (facts, lambda: noop(mart_plans.hourly_demand(facts))),
        "route_performance": (facts, lambda: noop(mart_plans.route_performance(facts))),
        "weather_impact": (facts, lambda: noop(mart_plans.weather_impact(facts))),
        "top_zone_ids": (marts.daily_demand, lambda: serving.top_zone_ids(marts).collect()),
        "top_zones": (marts.daily_demand, lambda: serving.top_zones(marts, *span).collect()),
        "top_routes": (marts.route_performance, lambda: serving.routes(marts).collect()),
    }
    # The size of a real month: the raw rows several times over, under new keys.
    times = range(1, 1 + round(MONTH_ROWS / raw.count()))
    month = stored(
        spark,
        union_relaxed([raw.withColumn("trip_key", F.col("trip_key") + t * 10**10) for t in times]),
        f"{scratch}/month",
    )
    month_quality = Classification(canonical_trips(month))
    month_valid = stored(spark, month_quality.valid(), f"{scratch}/month_valid")
    month_staged = stored(spark, normalize(month_valid), f"{scratch}/month_staged")
    month_stages: dict[str, tuple[DataFrame, Callable[[], object]]] = {
        "read_raw": (month, lambda: noop(month)),
        "validate": (month, lambda: month_quality.counts().collect()),
        "split_outcomes": (month, lambda: noop(month_quality.outcomes())),
        "scan_valid": (month_valid, lambda: noop(month_valid)),
        "normalize": (month_valid, lambda: noop(normalize(month_valid))),
        "scan_staged": (month_staged, lambda: noop(month_staged)),
        "enrich_hourly": (month_staged, lambda: noop(enrich_hourly(month_staged, hours))),
        "daily_demand": (month_staged, lambda: noop(mart_plans.daily_demand(month_staged))),
    }
    month_scale = {
        name: {"rows": source.count(), "sec": (took := round(timed(stage), 4))}
        | {"rows_per_second": round(source.count() / took)}
        for name, (source, stage) in month_stages.items()
    }

    # What a stage takes beyond reading its input and handing the rows on.
    beyond = {"split_outcomes": "read_raw", "normalize": "scan_valid", "enrich_hourly": "scan_staged"}
    net = {
        name: round(max(0.0, month_scale[name]["sec"] - month_scale[scan]["sec"]), 4)
        for name, scan in beyond.items()
    }

    seconds = {name: round(timed(stage), 4) for name, (_, stage) in stages.items()}
    rows = {name: source.count() for name, (source, _) in stages.items()}
    rates = {name: round(rows[name] / seconds[name]) for name in stages}
    print(
        json.dumps(
            {
                "metric": "headline_stages_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "input_rows": rows,
                "rows_per_second": rates,
                "month_scale": month_scale,
                "month_net_of_scan": net,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
