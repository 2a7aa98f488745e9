"""Paths, limits and defaults of a job; plain arguments, nothing read from the environment."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    root: str
    # Default dates, quality limits and alert limits.
    default_start: str = "2025-01-01"
    default_end: str = "2025-01-31"
    pipeline_name: str = "trips"
    max_invalid_ratio: float = 0.20
    max_null_ratio: float = 0.10
    fail_on_checks: bool = True
    alert_row_ratio: float = 2.0
    alert_max_seconds: float = 3600.0
    serving_database: str = "marts"
    digest_duplicates: bool = False  # a scan more, and whole rows of repeated digests only are exchanged
    # Public feeds the landed files come from.
    trips_url: str = "https://d37ci6vzurychx.cloudfront.net/trip-data/yellow_tripdata_%s.parquet"
    zones_url: str = "https://d37ci6vzurychx.cloudfront.net/misc/taxi+_zone_lookup.csv"
    weather_url: str = "https://archive-api.open-meteo.com/v1/archive"
    weather_latitude: float = 40.7143
    weather_longitude: float = -74.006

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw_trips(self) -> str:
        return self.path("raw", "taxi_trips")

    @property
    def raw_weather(self) -> str:
        return self.path("raw", "weather")

    @property
    def raw_zones(self) -> str:
        return self.path("raw", "taxi_zones", "taxi_zone_lookup.csv")

    @property
    def validated(self) -> str:
        return self.path("validated", "trips")

    @property
    def reports(self) -> str:
        return self.path("validated", "reports")

    @property
    def staging(self) -> str:
        return self.path("staging", "trips")

    @property
    def curated(self) -> str:
        return self.path("curated", "trips")

    @property
    def marts(self) -> str:
        return self.path("marts")

    @property
    def fact(self) -> str:
        return self.path("marts", "fct_trips")

    def parts(self, name: str) -> str:
        """What each source month adds to a mart or to the profile of the fact."""
        return self.path("marts", "parts", name)

    @property
    def publish_log(self) -> str:
        return self.path("meta", "published")

    @property
    def commit_log(self) -> str:
        return self.path("meta", "commits")

    @property
    def run_log(self) -> str:
        return self.path("meta", "runs")

    @property
    def manifest_log(self) -> str:
        return self.path("meta", "manifest")
