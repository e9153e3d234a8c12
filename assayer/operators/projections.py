"""Row-level projections of the bronze, silver and zone layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.contracts import (
    LINEAGE_COLUMNS,
    SILVER_CASTS,
    SOURCE_PATH,
    TRIP_COLUMNS,
    ZONE_COLUMNS,
    MartTable,
    require_columns,
)
from assayer.functions import cast_text, minutes_between, per_unit, to_int
from assayer.operators.rules import TRIP_RULES, tag_rows


def with_lineage(raw: DataFrame, *, batch_id: str, ingested_at: datetime) -> DataFrame:
    """Stamp raw rows with the batch they arrived in and the (zone-aware) time of arrival."""
    if not batch_id.strip():
        raise ValueError("a batch_id is required")
    if ingested_at.utcoffset() is None:
        raise ValueError("ingested_at needs a time zone")
    require_columns(raw, [SOURCE_PATH], "raw trips")
    return raw.withColumns({"_batch_id": F.lit(batch_id), "_ingested_at": F.lit(ingested_at).cast("timestamp")})


def cast_trips(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed projection of exactly the contract's columns, and those to ``keep``; text that does not parse becomes NULL."""
    require_columns(bronze, TRIP_COLUMNS + LINEAGE_COLUMNS, "bronze trips")
    typed = [cast_text(raw, kind).alias(name) for raw, (name, kind) in SILVER_CASTS.items()]
    return bronze.select(*typed, *LINEAGE_COLUMNS, *keep)


def derive_trip_columns(typed: DataFrame) -> DataFrame:
    """Add the calendar parts of the pickup, the duration in minutes and the fare per mile."""
    pickup = F.col("pickup_timestamp")
    return typed.withColumns(
        {
            "pickup_date": F.to_date(pickup),
            "pickup_hour": F.hour(pickup),
            "pickup_year": F.year(pickup),
            "pickup_month": F.month(pickup),
            "trip_duration_minutes": minutes_between(pickup, F.col("dropoff_timestamp")),
            "fare_per_mile": per_unit(F.col("fare_amount"), F.col("trip_distance")),
        }
    )


def build_silver(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Bronze text rows to typed, derived and rule-checked rows. One narrow stage, no shuffle."""
    return tag_rows(derive_trip_columns(cast_trips(bronze, keep)), TRIP_RULES)


def zone_dimension(raw_zones: DataFrame) -> DataFrame:
    """Typed zone id with trimmed attributes."""
    require_columns(raw_zones, ZONE_COLUMNS, "raw zones")
    return raw_zones.select(
        to_int("LocationID").alias("location_id"),
        *[F.trim(F.col(name)).alias(name.lower()) for name in ZONE_COLUMNS[1:]],
        SOURCE_PATH,
    )


def project_for_mart(gold: DataFrame, table: MartTable) -> DataFrame:
    """The published columns in table order."""
    return require_columns(gold, table.columns, table.name).select(*table.columns)


def stamp_publish(df: DataFrame, *, run_id: str, published_at: datetime) -> DataFrame:
    """Mark rows with their publish run. Both marts of a run are given the same ``published_at``."""
    return df.withColumns({"publish_run_id": F.lit(run_id), "published_at": F.lit(published_at).cast("timestamp")})
