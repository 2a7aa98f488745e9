from __future__ import annotations

import hashlib
import json
from datetime import date, datetime

import landing
import pyarrow as pa
import pytest
from conftest import plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripmill.errors import MissingPartitionError
from tripmill.plans import monthly
from tripmill.settings import Settings
from tripmill.sinks import files as sinks
from tripmill.sources import blocks, landed, trips as trip_sources
from tripmill.sources.weather import read_weather_months
from tripmill.sources.zones import read_zones


@pytest.fixture
def settings(tmp_path):
    return Settings(root=str(tmp_path))


def staged(spark, *days: str):
    rows = [(datetime.fromisoformat(d), i) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, n int").withColumn(
        "pickup_date", F.to_date("pickup_datetime")
    )


def test_write_once_refuses_a_second_write(spark, tmp_path):
    path = str(tmp_path / "once")
    sinks.write_once(spark.range(1), path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.write_once(spark.range(2), path)
    sinks.write_once(spark.range(3), path, overwrite=True)
    assert spark.read.parquet(path).count() == 3


def test_scan_reads_one_month(spark, settings, tmp_path):
    landing.land_all(tmp_path)
    month = trip_sources.scan_month(spark, settings.raw_trips, "2025-01")
    assert month.count() == 7
    assert "year" not in month.columns
    assert month.schema["tpep_pickup_datetime"].dataType.simpleString() == "timestamp_ntz"


def test_scan_without_files_fails(spark, settings, tmp_path):
    with pytest.raises(MissingPartitionError, match="2025-01"):
        trip_sources.scan_month(spark, settings.raw_trips, "2025-01")
    (tmp_path / "raw/taxi_trips/year=2025/month=01").mkdir(parents=True)
    with pytest.raises(MissingPartitionError):
        trip_sources.scan_month(spark, settings.raw_trips, "2025-01")


def test_files_of_a_month_with_other_types_are_widened(spark, settings, tmp_path):
    rows = landing.january()
    landing.write_trips(tmp_path, "2025-01", rows[:2])
    landing.write_trips(tmp_path, "2025-01", rows[2:], "-b", passenger_count=pa.float64())
    landing.write_trips(tmp_path, "2025-01", rows[:1], "-c", PULocationID=pa.int32())
    month = trip_sources.scan_month(spark, settings.raw_trips, "2025-01")
    assert month.count() == 8
    assert month.schema["passenger_count"].dataType.simpleString() == "double"
    assert month.schema["PULocationID"].dataType.simpleString() == "bigint"


def test_union_by_name_fills_absent_columns(spark):
    both = trip_sources.union_by_name(
        [spark.sql("select 1 a, 2 b"), spark.sql("select 3 c, 4 a")]
    ).collect()
    assert {tuple(r) for r in both} == {(1, 2, None), (4, None, 3)}


def test_dated_write_replaces_its_dates_only(spark, tmp_path):
    root = str(tmp_path / "dated")
    sinks.write_dates(staged(spark, "2025-01-01T08:00", "2025-01-01T07:00", "2025-01-02T09:00"), root)
    sinks.write_dates(staged(spark, "2025-01-02T10:00"), root)
    rows = spark.read.parquet(root)
    assert rows.groupBy("pickup_date").count().count() == 2
    assert rows.where("pickup_date = '2025-01-02'").first().pickup_datetime.hour == 10
    assert [r.pickup_date for r in sinks.dates_written(rows).collect()] == ["2025-01-01", "2025-01-02"]
    first_day = list((tmp_path / "dated" / "pickup_date=2025-01-01").glob("*.parquet"))
    assert len(first_day) == 1
    times = [r.pickup_datetime for r in spark.read.parquet(str(first_day[0])).collect()]
    assert times == sorted(times)


def test_hot_date_is_split_over_files(spark, tmp_path):
    keys = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {k: spark.conf.get(k) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            F.lit(datetime(2025, 1, 1)).cast("timestamp_ntz").alias("pickup_datetime"),
            F.lit(date(2025, 1, 1)).alias("pickup_date"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        sinks.write_dates(rows, str(tmp_path / "hot"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(list((tmp_path / "hot" / "pickup_date=2025-01-01").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 200_000


def test_clustered_write_does_not_shuffle(spark, tmp_path, monkeypatch):
    seen = []
    original = sinks._sorted
    monkeypatch.setattr(sinks, "_sorted", lambda rows: seen.append(original(rows)) or seen[-1])
    sinks.write_dates(staged(spark, "2025-01-01T08:00"), str(tmp_path / "d"), clustered=True)
    assert "Exchange" not in plan_of(seen[0])


def test_date_range_read_lists_only_its_dates(spark, tmp_path):
    root = str(tmp_path / "staging")
    sinks.write_staging(staged(spark, "2025-01-01T08:00", "2025-01-02T08:00"), root, "2025-01")
    sinks.write_staging(staged(spark, "2025-01-02T09:00", "2025-02-01T09:00"), root, "2025-02")
    january = trip_sources.read_dates(spark, root, date(2025, 1, 1), date(2025, 1, 31))
    assert january.count() == 3
    assert january.schema["pickup_date"].dataType.simpleString() == "date"
    assert "source_month" not in january.columns
    assert all("2025-02-01" not in f for f in january.inputFiles())
    with pytest.raises(MissingPartitionError):
        trip_sources.read_dates(spark, root, date(2024, 1, 1), date(2024, 1, 31))


def test_restaging_a_month_drops_its_stale_dates(spark, tmp_path):
    root = str(tmp_path / "staging")
    sinks.write_staging(staged(spark, "2025-01-01T08:00", "2025-01-02T08:00"), root, "2025-01")
    sinks.write_staging(staged(spark, "2025-01-01T08:00"), root, "2025-01")
    assert spark.read.parquet(root).count() == 1


def test_zones_and_weather_files(spark, settings, tmp_path):
    landing.land_all(tmp_path)
    zones = read_zones(spark, settings.raw_zones)
    assert zones.columns == ["location_id", "borough", "zone", "service_zone"]
    assert zones.count() == 4
    hours = read_weather_months(spark, settings.raw_weather, ["2024-11", "2025-01", "2025-01"])
    assert hours.count() == 744
    with pytest.raises(MissingPartitionError):
        read_weather_months(spark, settings.raw_weather, ["2023-01"])


def test_listing_and_checksums(spark, tmp_path):
    (tmp_path / "raw/b").mkdir(parents=True)
    (tmp_path / "raw/a.txt").write_bytes(b"abc")
    (tmp_path / "raw/b/c.txt").write_bytes(b"22")
    listing = landed.list_files(spark, str(tmp_path / "raw"))
    keys = listing.select(landed.relative_to(F.col("path"), str(tmp_path)).alias("k"))
    assert {r.k for r in keys.collect()} == {"raw/a.txt", "raw/b/c.txt"}
    assert landed.stored_bytes(listing).first().bytes == 5
    assert landed.list_files(spark, str(tmp_path / "nothing")).count() == 0
    row = landed.file_checksums(spark, str(tmp_path / "raw/a.txt")).first()
    assert row.checksum == hashlib.sha256(b"abc").hexdigest()
    assert row.checksum == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_checksums_of_files_beyond_one_cell_and_of_any_name(spark, tmp_path):
    large = tmp_path / "large.bin"
    with large.open("wb") as out:  # a hole of 2 GB and a few bytes around it
        out.write(b"start")
        out.seek(2**31 + 11)
        out.write(b"end")
    odd = tmp_path / "a b%20c+d#e.bin"
    odd.write_bytes(b"odd")
    (tmp_path / "empty.bin").write_bytes(b"")
    found = {r.path.rsplit("/", 1)[1]: r for r in landed.file_checksums(spark, str(tmp_path)).collect()}
    expected = hashlib.sha256()
    with large.open("rb") as source:
        while block := source.read(1 << 24):
            expected.update(block)
    assert found["large.bin"].checksum == expected.hexdigest()
    assert found["large.bin"].file_size == 2**31 + 14
    assert found[odd.name].checksum == hashlib.sha256(b"odd").hexdigest()
    assert len(found) == 2  # Spark lists no empty file


def test_checksums_hold_one_block_at_a_time(tmp_path, monkeypatch):
    path = tmp_path / "blocks.bin"
    path.write_bytes(b"0123456789")
    asked = []

    class Source:
        def __init__(self, inner):
            self.inner = inner

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.inner.close()

        def read(self, n):
            asked.append(n)
            return self.inner.read(n)

    monkeypatch.setattr(blocks, "BLOCK_BYTES", 4)
    monkeypatch.setattr(blocks, "opened", lambda name: Source(open(name, "rb")))
    assert blocks.sha256_of(str(path)) == (hashlib.sha256(b"0123456789").hexdigest(), 10)
    assert asked == [4, 4, 4, 4]


def test_many_files_with_few_schemas_take_few_jobs(spark, tmp_path):
    import pyarrow.parquet as pq

    folder = tmp_path / "many"
    folder.mkdir()
    kinds = [{"n": pa.int64()}, {"n": pa.float64()}, {"n": pa.int32(), "more": pa.string()}]
    for i in range(240):
        types = kinds[i % 3]
        columns = {c: pa.array([i if c == "n" else str(i)], kind) for c, kind in types.items()}
        pq.write_table(pa.table(columns), folder / f"part-{i:03}.parquet")
    spark.sparkContext.setJobGroup("grouping", "files by schema")
    try:
        rows = trip_sources.read_parquet_relaxed(spark, str(folder), "nothing")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("grouping")) < 20
    assert plan_of(rows).count("FileScan parquet") == 3
    assert dict(rows.dtypes) == {"n": "double", "more": "string"}
    assert {tuple(r) for r in rows.select("n", "more").collect()} == {
        (float(i), str(i) if i % 3 == 2 else None) for i in range(240)
    }


def test_paths_of_schemes_that_tasks_cannot_open_are_told_apart(spark):
    paths = spark.createDataFrame([("s3a://b/x",), ("file:/x",), ("odd://x",)], "path string")
    assert {r.path for r in paths.where(blocks.in_tasks(F.col("path"))).collect()} == {"s3a://b/x", "file:/x"}


def test_rows_per_file(spark, tmp_path):
    def rows(kind, path):
        return landed.file_rows(spark, kind, str(path)).first().row_count

    landing.land_all(tmp_path)
    raw = tmp_path / "raw"
    trips = raw / "taxi_trips/year=2025/month=01/yellow_tripdata_2025-01.parquet"
    assert rows("parquet", trips) == 7
    assert rows("csv", raw / "taxi_zones/taxi_zone_lookup.csv") == 4
    assert rows("json", raw / "weather/year=2025/month=01/weather_2025-01.json") == 744
    for text, expected in ((json.dumps([1, 2, 3]), 3), ('{"a": 1}', 1), ('{"hourly": 5}', 1)):
        path = tmp_path / f"{expected}-{len(text)}.json"
        path.write_text(text)
        assert rows("json", path) == expected
    empty = landing.write_trips(tmp_path, "2025-03", [])
    assert rows("parquet", empty) == 0
    with pytest.raises(ValueError):
        landed.file_rows(spark, "xml", "x")


def test_planned_sources(spark, settings):
    plan = landed.plan(spark, date(2025, 1, 15), date(2025, 2, 1), settings).collect()
    assert sorted((r.source_name, r.partition_date) for r in plan) == [
        ("taxi_trips", "2025-01"),
        ("taxi_trips", "2025-02"),
        ("taxi_zones", ""),
        ("weather", "2025-01"),
        ("weather", "2025-02"),
    ]
    by_key = {(r.source_name, r.partition_date): r for r in plan}
    assert by_key["taxi_trips", "2025-02"].source_url.endswith("yellow_tripdata_2025-02.parquet")
    url = by_key["weather", "2025-02"].source_url
    assert "start_date=2025-02-01&end_date=2025-02-28" in url
    with pytest.raises(ValueError):
        landed.plan(spark, date(2025, 2, 1), date(2025, 1, 1), settings)


def test_registering_landed_files_is_idempotent(spark, settings, tmp_path):
    landing.land_all(tmp_path)
    span = (date(2025, 1, 1), date(2025, 3, 31))
    first = monthly.register_landed(spark, settings, *span)
    states = {(r.source_name, r.partition_date): r for r in first.collect()}
    assert states["taxi_trips", "2025-01"].row_count == 7
    assert states["taxi_zones", ""].status == "success"
    assert states["weather", "2025-02"].row_count == 672
    assert states["taxi_trips", "2025-03"].status == "failed"
    path = tmp_path / "raw/taxi_zones/taxi_zone_lookup.csv"
    assert states["taxi_zones", ""].file_size == path.stat().st_size
    with pytest.raises(monthly.IngestError, match="2 ingestion"):
        monthly.require_landed(first)
    landing.write_trips(tmp_path, "2025-03", landing.january())
    again = monthly.register_landed(spark, settings, *span)
    assert sorted(r.source_name for r in again.collect()) == ["taxi_trips", "weather"]


def test_parts_under_any_name_and_late_parts_are_registered(spark, settings, tmp_path):
    landing.land_all(tmp_path)
    day = date(2025, 1, 1)
    folder = tmp_path / "raw/taxi_trips/year=2025/month=01"
    for path in folder.iterdir():
        path.rename(folder / "part-0000.parquet")

    def trips():
        found = monthly.register_landed(spark, settings, day, day).where("source_name = 'taxi_trips'").collect()
        return [(r.row_count, r.status, r.checksum) for r in found]

    [(rows, status, whole)] = trips()
    assert (rows, status) == (7, "success")
    assert trips() == []
    landing.write_trips(tmp_path, "2025-01", landing.january()[:2], "-late")
    [(rows, status, more)] = trips()
    assert (rows, status) == (9, "success") and more != whole
    assert trips() == []


def test_checksums_do_not_depend_on_how_rows_are_cut(spark, settings, tmp_path):
    rows = landing.january()
    landing.write_trips(tmp_path, "2025-01", rows)
    landing.write_trips(tmp_path, "2025-02", rows[4:], "-a")
    landing.write_trips(tmp_path, "2025-02", rows[:4][::-1], "-b")
    landing.write_trips(tmp_path, "2025-03", rows[1:])
    records = monthly.register_landed(spark, settings, date(2025, 1, 1), date(2025, 3, 1))
    sums = {r.partition_date: r.checksum for r in records.where("source_name = 'taxi_trips'").collect()}
    assert sums["2025-01"] == sums["2025-02"] != sums["2025-03"]


def test_columns_that_some_files_lack_are_null(spark, settings, tmp_path):
    import pyarrow.parquet as pq

    for types in ({}, {"passenger_count": pa.float64()}):
        landing.write_trips(tmp_path, "2025-05", landing.january()[:2])
        more = landing.write_trips(tmp_path, "2025-05", landing.january(), "-b", **types)
        pq.write_table(pq.read_table(more).drop_columns(["tip_amount"]), more)
        month = trip_sources.scan_month(spark, settings.raw_trips, "2025-05")
        assert (month.count(), month.where("tip_amount is null").count()) == (9, 7)
