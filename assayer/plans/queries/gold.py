"""Aggregations, orders, top-k and set operations over the gold tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.contracts import DAILY_SCHEMA, HOURLY_SCHEMA
from assayer.operators.metrics import (
    daily_zone_from_trips,
    daily_zone_metrics,
    gold_input_summary,
    hourly_demand_metrics,
    order_daily,
    order_hourly,
    rate_column,
    top_hours,
    top_zones,
    top_zones_per_day,
    trip_rollup,
)
from assayer.operators.publish import in_window, publish_date_window, publish_dates
from assayer.operators.quality import duplicate_keys, key_counts, null_keys
from assayer.operators.zones import attach_zone
from assayer.plans.queries.registry import Tables, comparable, query


def _enriched_rollup(t: Tables) -> DataFrame:
    return attach_zone(trip_rollup(t.valid), t.zones)


@query("gold_daily_zone", "SELECT * FROM daily")
def _(t: Tables) -> DataFrame:
    return comparable(daily_zone_from_trips(t.valid, t.zones))


@query("gold_hourly_demand", "SELECT * FROM hourly")
def _(t: Tables) -> DataFrame:
    return comparable(hourly_demand_metrics(t.valid))


@query("gold_daily_zone_from_enriched", "SELECT * FROM daily")
def _(t: Tables) -> DataFrame:
    return comparable(daily_zone_metrics(t.enriched))


def _daily_measure(measure: str) -> None:
    @query(f"daily_{measure}", f"SELECT pickup_date, pickup_location_id, {measure} FROM daily")
    def _(t: Tables) -> DataFrame:
        return comparable(t.daily.select("pickup_date", "pickup_location_id", measure))


def _hourly_measure(measure: str) -> None:
    @query(f"hourly_{measure}", f"SELECT pickup_date, pickup_hour, {measure} FROM hourly")
    def _(t: Tables) -> DataFrame:
        return comparable(t.hourly.select("pickup_date", "pickup_hour", measure))


_FIRST_MEASURE = "trip_count"
for _name in DAILY_SCHEMA.names[DAILY_SCHEMA.names.index(_FIRST_MEASURE) :]:
    _daily_measure(_name)
for _name in HOURLY_SCHEMA.names[HOURLY_SCHEMA.names.index(_FIRST_MEASURE) :]:
    _hourly_measure(_name)


@query(
    "trip_rollup",
    "SELECT pickup_date, pickup_hour, pickup_location_id, _batch_id, count(*) AS trip_count,"
    " CAST(sum(total_amount) AS DECIMAL(22,2)) AS gross_revenue_amount, CAST(sum(fare_amount) AS DECIMAL(22,2)) AS fare_revenue_amount,"
    " CAST(sum(tip_amount) AS DECIMAL(22,2)) AS total_tip_amount, "
    + ", ".join(f"round(sum({c}), 9) AS avg_{c}__sum, count({c}) AS avg_{c}__n" for c in ("trip_distance", "trip_duration_minutes", "fare_per_mile"))
    + ", count(*) FILTER (payment_type = 1) AS card_payment_share__n, count(*) FILTER (payment_type = 2) AS cash_payment_share__n,"
    " max(_ingested_at) AS latest_source_ingested_at FROM valid GROUP BY ALL",
)
def _(t: Tables) -> DataFrame:
    """Every partial sum and count that the gold tables are merged from."""
    rollup = trip_rollup(t.valid, ("pickup_date", "pickup_hour", "pickup_location_id", "_batch_id"))
    # Nine digits: a single trip's ratio may lie half way between two values of fewer.
    return rollup.withColumns({c: F.round(c, 9) for c in rollup.columns if c.endswith("__sum")})


@query(
    "gold_input_summary",
    "SELECT count(*) AS valid_trip_count, CAST(sum(CASE WHEN _zone_lookup_matched THEN 0 ELSE 1 END) AS BIGINT)"
    " AS unmatched_zone_count, min(pickup_date) AS date_from, max(pickup_date) AS date_to FROM enriched",
)
def _(t: Tables) -> DataFrame:
    return gold_input_summary(_enriched_rollup(t))


@query(
    "zone_match_rate",
    "SELECT round(avg(CASE WHEN _zone_lookup_matched THEN 1e0 ELSE 0e0 END), 6) AS zone_match_rate FROM enriched",
)
def _(t: Tables) -> DataFrame:
    valid = F.col("valid_trip_count")
    summary = gold_input_summary(_enriched_rollup(t))
    return comparable(summary.select(rate_column(valid - F.col("unmatched_zone_count"), valid).alias("zone_match_rate")))


@query(
    "invalid_row_rate",
    "SELECT round(avg(CASE WHEN is_valid THEN 0e0 ELSE 1e0 END), 6) AS invalid_row_rate FROM silver",
)
def _(t: Tables) -> DataFrame:
    counted = t.silver.agg(F.count_if(~F.col("is_valid")).alias("invalid"), F.count("*").alias("total"))
    return comparable(counted.select(rate_column(F.col("invalid"), F.col("total")).alias("invalid_row_rate")))


@query(
    "row_counts",
    "SELECT 'bronze' AS dataset, count(*) AS row_count FROM bronze UNION ALL SELECT 'zones', count(*) FROM zone_dim"
    " UNION ALL SELECT 'valid', count(*) FROM valid UNION ALL SELECT 'invalid', count(*) FROM silver WHERE NOT is_valid"
    " UNION ALL SELECT 'daily', count(*) FROM daily UNION ALL SELECT 'hourly', count(*) FROM hourly",
)
def _(t: Tables) -> DataFrame:
    split = t.silver.agg(
        F.count("*").alias("bronze"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
    )
    rows = split.unpivot([], ["bronze", "valid", "invalid"], "dataset", "row_count")
    for name, df in (("zones", t.zones), ("daily", t.daily), ("hourly", t.hourly)):
        rows = rows.unionByName(df.agg(F.count("*").alias("row_count")).withColumn("dataset", F.lit(name)))
    return rows


@query("key_counts", "SELECT pickup_location_id, count(*) AS row_count FROM typed GROUP BY pickup_location_id")
def _(t: Tables) -> DataFrame:
    return key_counts(t.silver, "pickup_location_id")


@query(
    "filter_null_key",
    "SELECT pickup_location_id, count(*) AS row_count FROM typed WHERE pickup_location_id IS NULL GROUP BY ALL",
)
def _(t: Tables) -> DataFrame:
    return null_keys(t.silver, "pickup_location_id")


@query(
    "filter_having",
    "SELECT pickup_timestamp, count(*) AS row_count FROM typed GROUP BY pickup_timestamp HAVING count(*) > 1",
)
def _(t: Tables) -> DataFrame:
    return duplicate_keys(t.silver, ["pickup_timestamp"])


@query(
    "filter_date_window",
    "SELECT pickup_date, pickup_hour, trip_count FROM hourly"
    " WHERE pickup_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
)
def _(t: Tables) -> DataFrame:
    return in_window(t.hourly, date(2024, 1, 5), date(2024, 1, 20)).select("pickup_date", "pickup_hour", "trip_count")


@query("distinct_batches", "SELECT DISTINCT _batch_id FROM bronze")
def _(t: Tables) -> DataFrame:
    return t.bronze.select("_batch_id").distinct()


@query("distinct_paths", "SELECT DISTINCT _source_file_path FROM bronze")
def _(t: Tables) -> DataFrame:
    return t.bronze.select("_source_file_path").distinct()


@query("distinct_location_ids", "SELECT DISTINCT location_id FROM zone_dim")
def _(t: Tables) -> DataFrame:
    return t.zones.select("location_id").distinct()


# ---- orders, limits, top-k ----


@query(
    "order_daily",
    "SELECT pickup_date, pickup_location_id, trip_count, row_number() OVER (PARTITION BY pickup_date"
    " ORDER BY trip_count DESC, pickup_location_id)::INTEGER AS place FROM daily",
)
def _(t: Tables) -> DataFrame:
    """The place within the day makes the order part of the compared values."""
    day = Window.partitionBy("pickup_date").orderBy(F.desc("trip_count"), "pickup_location_id")
    placed = t.daily.withColumn("place", F.row_number().over(day))
    return order_daily(placed).select("pickup_date", "pickup_location_id", "trip_count", "place")


@query(
    "order_hourly",
    "SELECT pickup_date, pickup_hour, trip_count, row_number() OVER (PARTITION BY pickup_date"
    " ORDER BY pickup_hour)::INTEGER AS place FROM hourly",
)
def _(t: Tables) -> DataFrame:
    placed = t.hourly.withColumn("place", F.row_number().over(Window.partitionBy("pickup_date").orderBy("pickup_hour")))
    return order_hourly(placed).select("pickup_date", "pickup_hour", "trip_count", "place")


@query(
    "exists_limit_1",
    "SELECT EXISTS (SELECT 1 FROM typed WHERE pickup_location_id IS NULL) AS has_null_key,"
    " EXISTS (SELECT 1 FROM zone_dim WHERE location_id IS NULL) AS has_null_zone",
)
def _(t: Tables) -> DataFrame:
    trips = t.silver.agg(F.bool_or(F.isnull("pickup_location_id")).alias("has_null_key"))
    return trips.withColumn("has_null_zone", F.lit(not null_keys(t.zones, "location_id").isEmpty()))


_TOP = (
    "SELECT {keys}, CAST(sum(trip_count) AS BIGINT) AS trip_count, CAST(sum(gross_revenue_amount) AS DECIMAL(22,2))"
    " AS gross_revenue_amount FROM {table} GROUP BY {keys} ORDER BY {by} DESC, {keys} LIMIT 10"
)
_ZONE_KEYS = "pickup_location_id, pickup_borough, pickup_zone"


@query("top_zones", _TOP.format(keys=_ZONE_KEYS, table="daily", by="trip_count"))
def _(t: Tables) -> DataFrame:
    return top_zones(t.daily)


@query("top_zones_by_revenue", _TOP.format(keys=_ZONE_KEYS, table="daily", by="sum(gross_revenue_amount)"))
def _(t: Tables) -> DataFrame:
    return top_zones(t.daily, by="gross_revenue_amount")


@query("top_hours", _TOP.format(keys="pickup_hour", table="hourly", by="sum(trip_count)"))
def _(t: Tables) -> DataFrame:
    return top_hours(t.hourly)


@query("top_hours_by_revenue", _TOP.format(keys="pickup_hour", table="hourly", by="sum(gross_revenue_amount)"))
def _(t: Tables) -> DataFrame:
    return top_hours(t.hourly, by="gross_revenue_amount")


@query(
    "top_zones_per_day",
    "SELECT pickup_date, pickup_location_id, trip_count, place AS rank_in_day FROM (SELECT *, row_number() OVER"
    " (PARTITION BY pickup_date ORDER BY trip_count DESC, pickup_location_id)::INTEGER AS place FROM daily) WHERE place <= 3",
)
def _(t: Tables) -> DataFrame:
    return top_zones_per_day(t.daily).select("pickup_date", "pickup_location_id", "trip_count", "rank_in_day")


# ---- sets and subqueries ----

_ALL_DATES = "SELECT pickup_date FROM daily UNION ALL SELECT pickup_date FROM hourly"


@query("union_all_dates", _ALL_DATES)
def _(t: Tables) -> DataFrame:
    return publish_dates(t.daily, t.hourly)


@query("publish_date_window", f"SELECT min(pickup_date) AS date_from, max(pickup_date) AS date_to FROM ({_ALL_DATES})")
def _(t: Tables) -> DataFrame:
    return publish_date_window(t.daily, t.hourly)


@query(
    "exists_subquery",
    "SELECT EXISTS (SELECT 1 FROM daily GROUP BY pickup_date, pickup_location_id HAVING count(*) > 1) AS repeated_keys,"
    " EXISTS (SELECT 1 FROM daily GROUP BY pickup_location_id HAVING count(*) > 1) AS repeated_zones",
)
def _(t: Tables) -> DataFrame:
    return t.spark.sql(
        "SELECT EXISTS (SELECT 1 FROM {gold} GROUP BY pickup_date, pickup_location_id HAVING count(*) > 1)"
        " AS repeated_keys, EXISTS (SELECT 1 FROM {gold} GROUP BY pickup_location_id HAVING count(*) > 1)"
        " AS repeated_zones",
        gold=t.daily,
    )


@query(
    "derived_table",
    f"SELECT pickup_date, count(*) AS row_count FROM ({_ALL_DATES}) GROUP BY pickup_date",
)
def _(t: Tables) -> DataFrame:
    return publish_dates(t.daily, t.hourly).groupBy("pickup_date").agg(F.count("*").alias("row_count"))
