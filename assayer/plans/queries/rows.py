"""Row-level queries: projections, casts, rules, filters and joins."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.contracts import DAILY_MART, HOURLY_MART, TRIP_COLUMNS, VALID_TRIP_COLUMNS, require_columns
from assayer.functions import cut_error
from assayer.operators.projections import (
    cast_trips,
    derive_trip_columns,
    project_for_mart,
    stamp_publish,
    with_lineage,
)
from assayer.operators.rules import TRIP_RULES, broken_reasons, invalid_rows, reason_counts, split_rows, valid_rows
from assayer.operators.zones import attach_zone, enrich_trips, unmatched_trips
from assayer.plans.queries.registry import Tables, comparable, query, reasons_as_text
from assayer.sources import all_to_text

_ARRIVAL = datetime(2024, 2, 1, 6, 30, tzinfo=UTC)
_PUBLISHED = datetime(2024, 2, 2, tzinfo=UTC)


# ---- projections ----


@query(
    "bronze_lineage",
    "SELECT *, 'events' AS _source_file_path, 'batch-7' AS _batch_id,"
    " TIMESTAMP '2024-02-01 06:30:00' AS _ingested_at FROM raw",
)
def _(t: Tables) -> DataFrame:
    raw = t.raw.select(*TRIP_COLUMNS, F.lit("events").alias("_source_file_path"))
    return with_lineage(raw, batch_id="batch-7", ingested_at=_ARRIVAL)


@query("silver_cast", "SELECT * FROM typed")
def _(t: Tables) -> DataFrame:
    return cast_trips(t.bronze)


@query("silver_derive", "SELECT * FROM derived")
def _(t: Tables) -> DataFrame:
    return derive_trip_columns(cast_trips(t.bronze))


@query("zone_dim", "SELECT * FROM zone_dim")
def _(t: Tables) -> DataFrame:
    return t.zones


@query(
    "enrich_projection",
    "SELECT pickup_location_id, pickup_borough, pickup_zone, pickup_service_zone, _zone_lookup_matched,"
    " count(*) AS trip_count FROM enriched GROUP BY ALL",
)
def _(t: Tables) -> DataFrame:
    attributes = ("pickup_borough", "pickup_zone", "pickup_service_zone", "_zone_lookup_matched")
    return t.enriched.groupBy("pickup_location_id", *attributes).agg(F.count("*").alias("trip_count"))


@query(
    "cast_all_to_string",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,"
    " CAST(value AS VARCHAR) AS value, CAST(ts AS VARCHAR) AS ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events",
    chain=False,
)
def _(t: Tables) -> DataFrame:
    events = t.spark.read.parquet(f"{t.sf_dir}/events.parquet")
    return all_to_text(events.select("event_id", "user_id", "event_type", "value", "ts", F.to_date("ts").alias("day")))


@query("publish_projection", "SELECT * EXCLUDE (pickup_year, pickup_month) FROM daily")
def _(t: Tables) -> DataFrame:
    return comparable(project_for_mart(t.daily, DAILY_MART))


@query("publish_projection_hourly", "SELECT * EXCLUDE (pickup_year, pickup_month) FROM hourly")
def _(t: Tables) -> DataFrame:
    return comparable(project_for_mart(t.hourly, HOURLY_MART))


@query(
    "publish_stamp",
    "SELECT * EXCLUDE (pickup_year, pickup_month), 'run-1' AS publish_run_id,"
    " TIMESTAMP '2024-02-02 00:00:00' AS published_at FROM hourly",
)
def _(t: Tables) -> DataFrame:
    mart = project_for_mart(t.hourly, HOURLY_MART)
    return comparable(stamp_publish(mart, run_id="run-1", published_at=_PUBLISHED))


@query("require_columns", "SELECT is_valid, count(*) AS row_count FROM valid GROUP BY is_valid")
def _(t: Tables) -> DataFrame:
    checked = require_columns(t.valid, VALID_TRIP_COLUMNS, "valid trips")
    return checked.groupBy("is_valid").agg(F.count("*").alias("row_count"))


# ---- scalar functions ----


def _silver_columns(name: str, *columns: str) -> None:
    """The typed columns of the silver layer, one query per kind of scalar function."""
    listed = ", ".join(columns)
    sql = f"SELECT {listed}, count(*) AS row_count FROM derived GROUP BY {listed}"

    @query(name, sql)
    def _(t: Tables) -> DataFrame:
        derived = derive_trip_columns(cast_trips(t.bronze))
        return derived.groupBy(*columns).agg(F.count("*").alias("row_count"))


_silver_columns("string_to_int", "vendor_id", "passenger_count", "rate_code_id", "dropoff_location_id", "payment_type")
_silver_columns("string_to_double", "trip_distance")
_silver_columns("string_to_decimal", "fare_amount", "tip_amount", "total_amount")
_silver_columns("string_to_timestamp", "pickup_timestamp", "dropoff_timestamp")
_silver_columns("date_parts", "pickup_date", "pickup_hour", "pickup_year", "pickup_month")
_silver_columns("duration_minutes", "trip_duration_minutes")
_silver_columns("guarded_ratio", "fare_per_mile")


@query(
    "trim_text",
    "SELECT trim('  ' || n_name || ' ') AS trimmed, length('  ' || n_name || ' ')::INTEGER AS raw_length FROM nation",
    chain=False,
)
def _(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  "), "n_name", F.lit(" "))
    nation = t.spark.read.parquet(f"{t.sf_dir}/nation.parquet")
    return nation.select(F.trim(padded).alias("trimmed"), F.length(padded).alias("raw_length"))


@query(
    "error_text_cut",
    "SELECT doc_id, substring(text, 1, 2000) AS error_message FROM documents",
    chain=False,
)
def _(t: Tables) -> DataFrame:
    documents = t.spark.read.parquet(f"{t.sf_dir}/documents.parquet")
    return documents.select("doc_id", cut_error(F.col("text")).alias("error_message"))


# ---- rules and splits ----


def _rule(reason: str) -> None:
    sql = (
        "SELECT pickup_timestamp, dropoff_timestamp, trip_distance, fare_amount, total_amount, pickup_location_id,"
        f" dropoff_location_id FROM silver WHERE list_contains(string_split(_invalid_reasons, ','), '{reason}')"
    )

    @query(reason, sql)
    def _(t: Tables) -> DataFrame:
        rule = next(rule for rule in TRIP_RULES if rule.reason == reason)
        return cast_trips(t.bronze).filter(rule.broken()).select(
            "pickup_timestamp",
            "dropoff_timestamp",
            "trip_distance",
            "fare_amount",
            "total_amount",
            "pickup_location_id",
            "dropoff_location_id",
        )


for _each in TRIP_RULES:
    _rule(_each.reason)


@query("validation_reasons", "SELECT _invalid_reasons, count(*) AS row_count FROM silver GROUP BY _invalid_reasons")
def _(t: Tables) -> DataFrame:
    reasons = F.array_join(broken_reasons(TRIP_RULES), ",").alias("_invalid_reasons")
    return cast_trips(t.bronze).groupBy(reasons).agg(F.count("*").alias("row_count"))


@query("filter_valid", "SELECT * FROM silver WHERE is_valid")
def _(t: Tables) -> DataFrame:
    return reasons_as_text(valid_rows(t.silver))


@query("filter_invalid", "SELECT * FROM silver WHERE NOT is_valid")
def _(t: Tables) -> DataFrame:
    return reasons_as_text(invalid_rows(t.silver))


@query("split_valid_invalid", "SELECT is_valid, _invalid_reasons, count(*) AS row_count FROM silver GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    valid, invalid = split_rows(t.silver)
    both = reasons_as_text(valid.unionByName(invalid))
    return both.groupBy("is_valid", "_invalid_reasons").agg(F.count("*").alias("row_count"))


@query(
    "invalid_reason_values",
    "SELECT reason, count(*) AS row_count FROM ("
    " SELECT unnest(string_split(_invalid_reasons, ',')) AS reason FROM silver WHERE NOT is_valid) GROUP BY reason",
)
def _(t: Tables) -> DataFrame:
    return reason_counts(t.silver)


# ---- joins ----


@query(
    "enrich_left_join",
    "SELECT * FROM enriched",
)
def _(t: Tables) -> DataFrame:
    return reasons_as_text(enrich_trips(t.valid, t.zones))


@query(
    "unmatched_zone_trips",
    "SELECT pickup_timestamp, pickup_location_id, pickup_zone, total_amount FROM enriched WHERE NOT _zone_lookup_matched",
)
def _(t: Tables) -> DataFrame:
    return unmatched_trips(t.enriched).select("pickup_timestamp", "pickup_location_id", "pickup_zone", "total_amount")


@query(
    "enrich_without_broadcast",
    "SELECT pickup_borough, pickup_zone, count(*) AS trip_count FROM enriched GROUP BY ALL",
)
def _(t: Tables) -> DataFrame:
    """The way taken when the zone table is too large to broadcast."""
    enriched = attach_zone(t.valid, t.zones, broadcast=False)
    return enriched.groupBy("pickup_borough", "pickup_zone").agg(F.count("*").alias("trip_count"))
