"""Gold metrics.

Both gold tables are merges of one mergeable rollup. Trips are first reduced to one row per
(date, hour, location, batch) with sums and counts, which Spark combines on the map side, so a location or
an hour holding a third of all trips still sends at most one row per task into the shuffle. The zone join
and both gold tables then work on the rollup, and the trips are scanned and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.contracts import CARD_PAYMENT, CASH_PAYMENT, DAILY_KEYS, DAILY_SCHEMA, HOURLY_KEYS, HOURLY_SCHEMA
from assayer.operators.zones import attach_zone

ROLLUP_KEYS: tuple[str, ...] = (*HOURLY_KEYS, "pickup_location_id", "_batch_id")

_SUMMED = {
    "gross_revenue_amount": "total_amount",
    "fare_revenue_amount": "fare_amount",
    "total_tip_amount": "tip_amount",
}
_AVERAGED = {
    "avg_trip_distance": "trip_distance",
    "avg_trip_duration_minutes": "trip_duration_minutes",
    "avg_fare_per_mile": "fare_per_mile",
}
_SHARES = {"card_payment_share": CARD_PAYMENT, "cash_payment_share": CASH_PAYMENT}


def trip_rollup(trips: DataFrame, keys: Sequence[str] = ROLLUP_KEYS) -> DataFrame:
    """Partial sums and counts per key; merging them in any order gives the exact totals."""
    partials: list[Column] = [F.count("*").alias("trip_count")]
    partials += [F.sum(column).alias(name) for name, column in _SUMMED.items()]
    for name, column in _AVERAGED.items():
        partials += [F.sum(column).alias(f"{name}__sum"), F.count(column).alias(f"{name}__n")]
    partials += [F.count_if(F.col("payment_type") == code).alias(f"{name}__n") for name, code in _SHARES.items()]
    partials.append(F.max("_ingested_at").alias("latest_source_ingested_at"))
    return trips.groupBy(*keys).agg(*partials)


def _merged_measures() -> dict[str, Column]:
    trips = F.sum("trip_count")
    measures = {"trip_count": trips}
    measures |= {name: F.sum(name).cast("decimal(22,2)") for name in _SUMMED}
    measures |= {name: F.try_divide(F.sum(f"{name}__sum"), F.sum(f"{name}__n")) for name in _AVERAGED}
    measures |= {name: F.sum(f"{name}__n") / trips for name in _SHARES}
    # Sets, bounded by the zones and batches of one key: counting distinct values would copy every row per column.
    measures["distinct_pickup_zones"] = F.size(F.collect_set("pickup_location_id")).cast("bigint")
    measures["source_batch_count"] = F.size(F.collect_set("_batch_id")).cast("bigint")
    measures["latest_source_ingested_at"] = F.max("latest_source_ingested_at")
    return measures


def _merge(rollup: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    measures = _merged_measures()
    return rollup.groupBy(*keys).agg(*[measures[c].alias(c) for c in columns if c not in keys])


def merge_daily(enriched_rollup: DataFrame, *, keep_match: bool = False) -> DataFrame:
    """Daily-by-zone table from a rollup that carries the zone attributes; with ``keep_match`` the match flag as well."""
    keys = (*DAILY_KEYS, "_zone_lookup_matched") if keep_match else DAILY_KEYS
    return _merge(enriched_rollup, keys, DAILY_SCHEMA.names)


def merge_hourly(rollup: DataFrame) -> DataFrame:
    """Daily-by-hour table from a rollup."""
    return _merge(rollup, HOURLY_KEYS, HOURLY_SCHEMA.names)


def daily_zone_metrics(enriched: DataFrame) -> DataFrame:
    """Daily-by-zone table straight from enriched trips."""
    return merge_daily(trip_rollup(enriched, (*DAILY_KEYS, "_batch_id")))


def hourly_demand_metrics(enriched: DataFrame) -> DataFrame:
    """Daily-by-hour table straight from enriched trips."""
    return merge_hourly(trip_rollup(enriched))


def daily_zone_from_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Daily-by-zone table with the zone join moved behind the rollup, where few rows are left to join."""
    by_location = [key for key in ROLLUP_KEYS if key != "pickup_hour"]
    return merge_daily(attach_zone(trip_rollup(trips, by_location), zones))


def gold_input_summary(enriched_rollup: DataFrame) -> DataFrame:
    """One row: trips, trips without a zone, first and last pickup date."""
    unmatched = F.when(F.col("_zone_lookup_matched"), 0).otherwise(F.col("trip_count"))
    totals = {"valid_trip_count": F.sum("trip_count"), "unmatched_zone_count": F.sum(unmatched)}
    window = {"date_from": F.min("pickup_date"), "date_to": F.max("pickup_date")}
    counted = {name: F.coalesce(total, F.lit(0)) for name, total in totals.items()}
    return enriched_rollup.agg(*[column.alias(name) for name, column in {**counted, **window}.items()])


def order_daily(daily: DataFrame) -> DataFrame:
    """Presentation order: by date, busiest zone first."""
    return daily.orderBy(F.asc("pickup_date"), F.desc("trip_count"), F.asc("pickup_location_id"))


def order_hourly(hourly: DataFrame) -> DataFrame:
    return hourly.orderBy(F.asc("pickup_date"), F.asc("pickup_hour"))


def _top(metrics: DataFrame, keys: Sequence[str], k: int, by: str) -> DataFrame:
    if by not in ("trip_count", "gross_revenue_amount"):
        raise ValueError(f"cannot rank by {by!r}")
    totals = metrics.groupBy(*keys).agg(
        F.sum("trip_count").alias("trip_count"),
        F.sum("gross_revenue_amount").cast("decimal(22,2)").alias("gross_revenue_amount"),
    )
    return totals.orderBy(F.desc(by), *[F.asc(key) for key in keys]).limit(k)


def top_zones(daily: DataFrame, k: int = 10, *, by: str = "trip_count") -> DataFrame:
    """The ``k`` pickup zones with most trips, or with ``by='gross_revenue_amount'`` most revenue."""
    return _top(daily, ("pickup_location_id", "pickup_borough", "pickup_zone"), k, by)


def top_hours(hourly: DataFrame, k: int = 10, *, by: str = "trip_count") -> DataFrame:
    """The ``k`` hours of the day with most trips or most revenue."""
    return _top(hourly, ("pickup_hour",), k, by)


def top_zones_per_day(daily: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` busiest zones of each day; Spark trims to ``k`` per task before the shuffle."""
    best_first = Window.partitionBy("pickup_date").orderBy(F.desc("trip_count"), F.asc("pickup_location_id"))
    return daily.withColumn("rank_in_day", F.row_number().over(best_first)).filter(F.col("rank_in_day") <= k)


def rate(part: int, whole: int) -> float:
    """Share of ``part`` in ``whole``, 0.0 when there is nothing."""
    return part / whole if whole else 0.0


def rate_column(part: Column, whole: Column) -> Column:
    """Column form of :func:`rate`."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))
