"""Registry of queries and the frames and SQL they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.operators.metrics import daily_zone_from_trips, hourly_demand_metrics
from assayer.operators.projections import build_silver, zone_dimension
from assayer.operators.rules import valid_rows
from assayer.operators.zones import enrich_trips
from assayer.plans import adapter
from assayer.session import tune_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """The layers of one scale factor, as lazy frames."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def raw(self) -> DataFrame:
        return adapter.raw_trips(self.spark, self.sf_dir)

    @cached_property
    def bronze(self) -> DataFrame:
        return adapter.bronze_trips(self.spark, self.sf_dir)

    @cached_property
    def raw_zones(self) -> DataFrame:
        return adapter.raw_zones(self.spark, self.sf_dir)

    @cached_property
    def silver(self) -> DataFrame:
        return build_silver(self.bronze)

    @cached_property
    def valid(self) -> DataFrame:
        return valid_rows(self.silver)

    @cached_property
    def zones(self) -> DataFrame:
        return zone_dimension(self.raw_zones)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich_trips(self.valid, self.zones)

    @cached_property
    def daily(self) -> DataFrame:
        return daily_zone_from_trips(self.valid, self.zones)

    @cached_property
    def hourly(self) -> DataFrame:
        return hourly_demand_metrics(self.valid)


def query(name: str, sql: str | None = None, *, chain: bool = True) -> Callable:
    """Register ``function(tables)`` under ``name``; ``sql`` may use the relations of ``CHAIN``."""

    def register(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: function(Tables(tune_session(spark), sf_dir))
        if sql is not None:
            TWINS[name] = (CHAIN if chain else "") + sql
        return function

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Averages and shares to six digits, so that the order of summation does not show. Row values need no rounding."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(name, 6) for name in doubles})


def reasons_as_text(tagged: DataFrame) -> DataFrame:
    return tagged.withColumn("_invalid_reasons", F.array_join("_invalid_reasons", ","))


# The layers in plain SQL, written independently of the Spark code.
CHAIN = """
WITH raw_trips AS (
  SELECT
    event_id,
    CAST(1 + event_id % 2 AS VARCHAR) AS "VendorID",
    CASE WHEN event_id % 211 = 0 THEN 'bad-ts'
         WHEN event_id % 257 = 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.5')
         WHEN event_id % 263 = 0 THEN '2024-02-30 08:15:00'
         WHEN event_id % 269 = 0 THEN strftime(ts, '%Y-%m-%d')
         ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS tpep_pickup_datetime,
    CASE WHEN event_id % 223 = 0 THEN 'bad-ts'
         ELSE strftime(date_trunc('second', ts) + to_minutes(CAST((event_id * 7 % 61) - 2 AS INTEGER)),
                       '%Y-%m-%d %H:%M:%S') END AS tpep_dropoff_datetime,
    CAST(1 + event_id % 4 AS VARCHAR) AS passenger_count,
    CASE WHEN event_id % 227 = 0 THEN NULL WHEN event_id % 1009 = 0 THEN 'NaN'
         ELSE CAST(CAST(CAST(event_id * 13 % 240 AS DECIMAL(12,1)) / 10 AS DECIMAL(12,2)) AS VARCHAR) END AS trip_distance,
    CASE WHEN event_id % 7 = 0 THEN '1.0' ELSE '1' END AS "RatecodeID",
    'N' AS store_and_fwd_flag,
    CASE WHEN event_id % 229 = 0 THEN NULL ELSE CAST(user_id % 30 AS VARCHAR) END AS "PULocationID",
    CASE WHEN event_id % 233 = 0 THEN 'x' ELSE CAST(user_id * 7 % 25 AS VARCHAR) END AS "DOLocationID",
    CASE WHEN event_id % 251 = 0 THEN NULL WHEN event_id % 13 = 0 THEN ' ' || (1 + event_id % 4) || ' '
         ELSE CAST(1 + event_id % 4 AS VARCHAR) END AS payment_type,
    CASE WHEN event_id % 239 = 0 THEN '-1.00' WHEN event_id % 277 = 0 THEN '99999999999.99'
         WHEN event_id % 271 = 0 THEN CAST(value AS DECIMAL(12,2)) || '5'
         ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS fare_amount,
    '0.00' AS extra,
    '0.00' AS mta_tax,
    CAST(CAST(event_id % 500 AS DECIMAL(12,2)) / 100 AS DECIMAL(12,2)) AS tip,
    CASE WHEN event_id % 281 = 0 THEN NULL ELSE CAST(tip AS VARCHAR) END AS tip_amount,
    '0.00' AS tolls_amount,
    '0.00' AS improvement_surcharge,
    CASE WHEN event_id % 241 = 0 THEN ''
         WHEN event_id % 283 = 0 THEN CAST(CAST(value AS DECIMAL(12,2)) + tip AS DECIMAL(12,2)) || '5'
         ELSE CAST(CAST(CAST(value AS DECIMAL(12,2)) + tip AS DECIMAL(12,2)) AS VARCHAR) END AS total_amount,
    '0.00' AS congestion_surcharge,
    '0.00' AS airport_fee
  FROM events
), raw AS (
  SELECT * EXCLUDE (event_id, tip) FROM raw_trips
), bronze AS (
  SELECT * EXCLUDE (event_id, tip),
    'events' AS _source_file_path,
    'batch-' || (event_id % 3) AS _batch_id,
    TIMESTAMP '2024-02-01 00:00:00' + to_hours(CAST(event_id % 3 AS INTEGER)) AS _ingested_at
  FROM raw_trips
), typed AS (
  SELECT
    TRY_CAST(trunc(TRY_CAST("VendorID" AS DOUBLE)) AS INTEGER) AS vendor_id,
    try_strptime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_timestamp,
    try_strptime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_timestamp,
    TRY_CAST(trunc(TRY_CAST(passenger_count AS DOUBLE)) AS INTEGER) AS passenger_count,
    TRY_CAST(trip_distance AS DOUBLE) AS trip_distance,
    TRY_CAST(trunc(TRY_CAST("RatecodeID" AS DOUBLE)) AS INTEGER) AS rate_code_id,
    store_and_fwd_flag,
    TRY_CAST(trunc(TRY_CAST("PULocationID" AS DOUBLE)) AS INTEGER) AS pickup_location_id,
    TRY_CAST(trunc(TRY_CAST("DOLocationID" AS DOUBLE)) AS INTEGER) AS dropoff_location_id,
    TRY_CAST(trunc(TRY_CAST(payment_type AS DOUBLE)) AS INTEGER) AS payment_type,
    TRY_CAST(fare_amount AS DECIMAL(12,2)) AS fare_amount,
    TRY_CAST(extra AS DECIMAL(12,2)) AS extra,
    TRY_CAST(mta_tax AS DECIMAL(12,2)) AS mta_tax,
    TRY_CAST(tip_amount AS DECIMAL(12,2)) AS tip_amount,
    TRY_CAST(tolls_amount AS DECIMAL(12,2)) AS tolls_amount,
    TRY_CAST(improvement_surcharge AS DECIMAL(12,2)) AS improvement_surcharge,
    TRY_CAST(total_amount AS DECIMAL(12,2)) AS total_amount,
    TRY_CAST(congestion_surcharge AS DECIMAL(12,2)) AS congestion_surcharge,
    TRY_CAST(airport_fee AS DECIMAL(12,2)) AS airport_fee,
    _source_file_path, _batch_id, _ingested_at
  FROM bronze
), derived AS (
  SELECT *,
    CAST(pickup_timestamp AS DATE) AS pickup_date,
    CAST(hour(pickup_timestamp) AS INTEGER) AS pickup_hour,
    CAST(year(pickup_timestamp) AS INTEGER) AS pickup_year,
    CAST(month(pickup_timestamp) AS INTEGER) AS pickup_month,
    date_diff('second', pickup_timestamp, dropoff_timestamp) / 60e0 AS trip_duration_minutes,
    CASE WHEN trip_distance > 0 THEN CAST(fare_amount AS DOUBLE) / trip_distance END AS fare_per_mile
  FROM typed
), silver AS (
  SELECT *,
    concat_ws(',',
      CASE WHEN pickup_timestamp IS NULL THEN 'invalid_pickup_timestamp' END,
      CASE WHEN dropoff_timestamp IS NULL THEN 'invalid_dropoff_timestamp' END,
      CASE WHEN pickup_timestamp IS NOT NULL AND dropoff_timestamp IS NOT NULL
                AND dropoff_timestamp <= pickup_timestamp THEN 'dropoff_not_after_pickup' END,
      CASE WHEN trip_distance IS NULL OR trip_distance <= 0 THEN 'non_positive_trip_distance' END,
      CASE WHEN fare_amount IS NULL OR fare_amount < 0 THEN 'invalid_fare_amount' END,
      CASE WHEN total_amount IS NULL OR total_amount < 0 THEN 'invalid_total_amount' END,
      CASE WHEN pickup_location_id IS NULL THEN 'missing_pickup_location' END,
      CASE WHEN dropoff_location_id IS NULL THEN 'missing_dropoff_location' END
    ) AS _invalid_reasons,
    _invalid_reasons = '' AS is_valid
  FROM derived
), valid AS (
  SELECT * FROM silver WHERE is_valid
), zone_dim AS (
  SELECT
    CAST(n_nationkey AS INTEGER) AS location_id,
    CASE WHEN n_nationkey = 7 THEN NULL ELSE r_name END AS borough,
    n_name AS zone,
    CASE WHEN n_nationkey = 9 THEN NULL ELSE 'service-' || n_regionkey END AS service_zone,
    'nation' AS _source_file_path
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
), enriched AS (
  SELECT v.*,
    coalesce(z.borough, 'Unknown') AS pickup_borough,
    coalesce(z.zone, 'Unknown') AS pickup_zone,
    coalesce(z.service_zone, 'Unknown') AS pickup_service_zone,
    z.location_id IS NOT NULL AS _zone_lookup_matched
  FROM valid v LEFT JOIN zone_dim z ON v.pickup_location_id = z.location_id
), daily AS (
  SELECT pickup_date, pickup_year, pickup_month, pickup_location_id, pickup_borough, pickup_zone, pickup_service_zone,
    count(*) AS trip_count,
    CAST(sum(total_amount) AS DECIMAL(22,2)) AS gross_revenue_amount,
    CAST(sum(fare_amount) AS DECIMAL(22,2)) AS fare_revenue_amount,
    CAST(sum(tip_amount) AS DECIMAL(22,2)) AS total_tip_amount,
    round(avg(trip_distance), 6) AS avg_trip_distance,
    round(avg(date_diff('second', pickup_timestamp, dropoff_timestamp) / 60e0), 6) AS avg_trip_duration_minutes,
    round(avg(fare_per_mile), 6) AS avg_fare_per_mile,
    round(avg(CASE WHEN payment_type = 1 THEN 1e0 ELSE 0e0 END), 6) AS card_payment_share,
    round(avg(CASE WHEN payment_type = 2 THEN 1e0 ELSE 0e0 END), 6) AS cash_payment_share,
    count(DISTINCT _batch_id) AS source_batch_count,
    max(_ingested_at) AS latest_source_ingested_at
  FROM enriched
  GROUP BY pickup_date, pickup_year, pickup_month, pickup_location_id, pickup_borough, pickup_zone, pickup_service_zone
), hourly AS (
  SELECT pickup_date, pickup_year, pickup_month, pickup_hour,
    count(*) AS trip_count,
    count(DISTINCT pickup_location_id) AS distinct_pickup_zones,
    CAST(sum(total_amount) AS DECIMAL(22,2)) AS gross_revenue_amount,
    CAST(sum(fare_amount) AS DECIMAL(22,2)) AS fare_revenue_amount,
    CAST(sum(tip_amount) AS DECIMAL(22,2)) AS total_tip_amount,
    round(avg(trip_distance), 6) AS avg_trip_distance,
    round(avg(date_diff('second', pickup_timestamp, dropoff_timestamp) / 60e0), 6) AS avg_trip_duration_minutes,
    round(avg(CASE WHEN payment_type = 1 THEN 1e0 ELSE 0e0 END), 6) AS card_payment_share,
    round(avg(CASE WHEN payment_type = 2 THEN 1e0 ELSE 0e0 END), 6) AS cash_payment_share,
    count(DISTINCT _batch_id) AS source_batch_count,
    max(_ingested_at) AS latest_source_ingested_at
  FROM enriched
  GROUP BY pickup_date, pickup_year, pickup_month, pickup_hour
)
"""
