"""Source specifications: which path holds the trips or the zones, and in which format."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from assayer.sources.storage import has_data

# ---- Fixed values: public download locations, file names and the supported year. ----
TRIP_DATA_URL = "https://d37ci6vzurychx.cloudfront.net/trip-data"
ZONE_LOOKUP_URL = "https://d37ci6vzurychx.cloudfront.net/misc/taxi_zone_lookup.csv"
SAMPLE_TRIPS_FILE = "yellow_tripdata_sample.csv"
MONTHLY_TRIPS_FILE = "yellow_tripdata_{year}-{month:02d}.parquet"
ZONE_LOOKUP_FILE = "taxi_zone_lookup.csv"
SUPPORTED_YEAR = 2024
# ---- End of fixed values. ----

Fetch = Callable[[str, str], None]


@dataclass(frozen=True)
class SourceSpec:
    """Where one input lies. ``path`` may be anything Spark can read: file, directory or glob."""

    path: str
    file_format: str
    source: str
    period: tuple[int, int] | None = None
    url: str | None = None

    @property
    def unit(self) -> str:
        """What one load replaces as a whole: a month of a monthly source, else all of the source."""
        return self.source if self.period is None else "{}-{}-{:02d}".format(self.source, *self.period)


def _sample_trips(root: str, period: tuple[int, int]) -> SourceSpec:
    return SourceSpec(f"{root}/{SAMPLE_TRIPS_FILE}", "csv", "sample")


def _monthly_trips(root: str, period: tuple[int, int]) -> SourceSpec:
    year, month = period
    if year != SUPPORTED_YEAR or not 1 <= month <= 12:
        raise ValueError(f"Only {SUPPORTED_YEAR} monthly files are supported, and a month has to be between 1 and 12: {year}, {month}")
    name = MONTHLY_TRIPS_FILE.format(year=year, month=month)
    return SourceSpec(f"{root}/{name}", "parquet", "tlc", period, f"{TRIP_DATA_URL}/{name}")


TRIP_SOURCES: dict[str, Callable[[str, tuple[int, int]], SourceSpec]] = {"sample": _sample_trips, "tlc": _monthly_trips}


def trip_source(root: str, *, source: str = "sample", year: int = SUPPORTED_YEAR, month: int = 1) -> SourceSpec:
    """Spec of the sample CSV (``sample``) or of one monthly parquet file (``tlc``) below ``root``."""
    if source not in TRIP_SOURCES:
        raise ValueError(f"unknown trip source {source!r}; use one of {sorted(TRIP_SOURCES)}")
    return TRIP_SOURCES[source](root, (year, month))


def zone_source(root: str) -> SourceSpec:
    """Spec of the zone lookup CSV below ``root``."""
    return SourceSpec(f"{root}/{ZONE_LOOKUP_FILE}", "csv", "lookup", url=ZONE_LOOKUP_URL)


def ensure_available(spark: SparkSession, spec: SourceSpec, *, fetch: Fetch | None = None) -> SourceSpec:
    """Return ``spec`` if its path holds data; else let ``fetch(url, path)`` put it there; else raise."""
    if has_data(spark, spec.path):
        return spec
    if fetch is None or spec.url is None:
        raise FileNotFoundError(f"{spec.source} input is absent or empty: {spec.path}")
    fetch(spec.url, spec.path)
    if not has_data(spark, spec.path):
        raise RuntimeError(f"fetching {spec.url} left no usable data at {spec.path}")
    return spec
