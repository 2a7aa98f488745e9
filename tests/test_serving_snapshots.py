"""Publications of the marts: all tables of one set or none."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tripmill.errors import MissingPartitionError
from tripmill.plans.marts import Marts
from tripmill.sinks.serving import load_marts, publications, retire, serving_marts


@pytest.fixture
def database(spark, tmp_path):
    return f"serving_{tmp_path.name.replace('-', '_')}"


def marts_of(spark, number):
    """Five small marts that hold the number of their publication, ``number`` rows each."""
    rows = spark.range(number).select(F.lit(number).alias("publication"), F.col("id").alias("n"))
    return Marts(**{name: rows for name in Marts.__dataclass_fields__})


def numbers(marts):
    return {name: {row.publication for row in mart.collect()} for name, mart in marts.items().items()}


def tables(spark, database):
    rows = spark.sql(f"SHOW TABLES IN {database} LIKE '*__*'").collect()
    return {row.tableName for row in rows}


def test_readers_see_one_publication(spark, database, tmp_path):
    counts = load_marts(marts_of(spark, 1), database, str(tmp_path / "db"))
    assert counts == dict.fromkeys(Marts.__dataclass_fields__, 1)
    held = serving_marts(spark, database)
    load_marts(marts_of(spark, 2), database)
    assert numbers(serving_marts(spark, database)) == dict.fromkeys(counts, {2})
    assert numbers(held) == dict.fromkeys(counts, {1})
    first = publications(spark, database).collect()[-1]
    assert first.row_counts == counts
    assert numbers(serving_marts(spark, database, first.version)) == dict.fromkeys(counts, {1})
    assert {row.publication for row in spark.table(f"{database}.daily_demand").collect()} == {2}


def test_a_failure_between_tables_leaves_the_former_set(spark, database, tmp_path):
    load_marts(marts_of(spark, 1), database, str(tmp_path / "db"))
    broken = marts_of(spark, 2)
    fails = broken.route_performance.select(F.raise_error(F.lit("lost")).cast("int").alias("publication"))
    with pytest.raises(Exception, match="lost"):
        load_marts(replace(broken, route_performance=fails), database)
    assert set(map(tuple, numbers(serving_marts(spark, database)).values())) == {(1,)}
    assert spark.table(f"{database}.hourly_demand").first().publication == 1
    assert publications(spark, database).count() == 1
    load_marts(marts_of(spark, 3), database)
    assert set(map(tuple, numbers(serving_marts(spark, database)).values())) == {(3,)}


def test_old_publications_and_remains_of_failed_ones_are_dropped(spark, database, tmp_path):
    load_marts(marts_of(spark, 1), database, str(tmp_path / "db"), keep=2)
    broken = marts_of(spark, 2)
    fails = broken.weather_impact.select(F.raise_error(F.lit("lost")).cast("int").alias("publication"))
    with pytest.raises(Exception, match="lost"):
        load_marts(replace(broken, weather_impact=fails), database, keep=2)
    load_marts(marts_of(spark, 3), database, keep=2)
    assert len(tables(spark, database)) >= 14  # two whole sets and what the failure left
    load_marts(marts_of(spark, 4), database, keep=2)
    assert len(tables(spark, database)) == 10
    assert retire(spark, database, 2) == []
    assert set(map(tuple, numbers(serving_marts(spark, database)).values())) == {(4,)}


def test_nothing_published_and_former_tables(spark, database, tmp_path):
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path / 'db'}'")
    with pytest.raises(MissingPartitionError):
        serving_marts(spark, database)
    marts_of(spark, 1).daily_demand.write.saveAsTable(f"{database}.daily_demand")
    load_marts(marts_of(spark, 2), database)
    assert spark.table(f"{database}.daily_demand").first().publication == 2
    empty = marts_of(spark, 0)
    assert set(load_marts(empty, database).values()) == {0}
    assert serving_marts(spark, database).daily_demand.isEmpty()
    with pytest.raises(ValueError):
        load_marts(empty, database, keep=0)
