"""What stage jobs tell about a run."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import date, datetime
from typing import Any

from pyspark.sql import SparkSession

from assayer.contracts import MONTH_PARTITIONS
from assayer.operators.metrics import rate
from assayer.operators.pending import Month
from assayer.operators.publish import PublishSummary, Window, merged_windows
from assayer.sources import SourceSpec

_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "Zulu", "Etc/Zulu", "Universal", "Etc/Universal", "UCT", "Etc/UCT", "+00:00"}


@dataclass(frozen=True)
class Written:
    """A dataset a stage wrote."""

    path: str
    rows: int


@dataclass(frozen=True)
class Loaded:
    """A raw input and the dataset it became."""

    spec: SourceSpec
    input_bytes: int
    output: Written

    def metrics(self) -> dict[str, Any]:
        year, month = self.spec.period or (None, None)
        return {
            "source": self.spec.source,
            "source_unit": self.spec.unit,
            "source_year": year,
            "source_month": month,
            "source_url": self.spec.url,
            "source_bytes": self.input_bytes,
            "file_format": self.spec.file_format,
            "input_path": self.spec.path,
            "output_path": self.output.path,
            "row_count": self.output.rows,
        }


@dataclass(frozen=True)
class BronzeSummary(Loaded):
    batch_id: str
    ingested_at: datetime

    def metrics(self) -> dict[str, Any]:
        return {**super().metrics(), "batch_id": self.batch_id, "ingested_at": self.ingested_at}


@dataclass(frozen=True)
class SilverSummary:
    bronze_path: str
    silver_path: str
    valid_row_count: int
    invalid_row_count: int
    #: Months whose valid rows this run wrote or took away.
    months: tuple[Month, ...]

    @property
    def total_row_count(self) -> int:
        return self.valid_row_count + self.invalid_row_count

    @property
    def invalid_row_rate(self) -> float:
        return rate(self.invalid_row_count, self.total_row_count)

    def metrics(self) -> dict[str, Any]:
        counted = {"total_row_count": self.total_row_count, "invalid_row_rate": self.invalid_row_rate}
        return {**asdict(self), "months": ",".join(f"{y}-{m:02d}" for y, m in self.months), **counted}


@dataclass(frozen=True)
class GoldSummary:
    inputs: dict[str, str]
    daily: Written
    hourly: Written
    trips: int
    unmatched_trips: int
    window: tuple[date | None, date | None]

    @property
    def zone_match_rate(self) -> float:
        return rate(self.trips - self.unmatched_trips, self.trips)

    def metrics(self) -> dict[str, Any]:
        return {
            **{f"{name}_path": path for name, path in self.inputs.items()},
            "daily_path": self.daily.path,
            "hourly_path": self.hourly.path,
            "partition_columns": ",".join(MONTH_PARTITIONS),
            "daily_zone_row_count": self.daily.rows,
            "hourly_demand_row_count": self.hourly.rows,
            "valid_trip_count": self.trips,
            "unmatched_zone_count": self.unmatched_trips,
            "zone_match_rate": self.zone_match_rate,
            "date_from": self.window[0],
            "date_to": self.window[1],
        }


def require_utc(spark: SparkSession) -> None:
    """Timestamps are parsed and split in the session zone, which has to be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone has to be UTC, not {zone}")


@dataclass(frozen=True)
class RunSummary:
    zones: Loaded
    bronze: BronzeSummary
    silver: SilverSummary
    gold: GoldSummary
    #: None where no month changed.
    publish: PublishSummary | None


def month_windows(months: Sequence[Month]) -> tuple[Window, ...]:
    """The days of the given months, as few windows: months that follow each other make one, gaps are left out."""
    return merged_windows([(date(*month, 1), date(*month, monthrange(*month)[1])) for month in months])
