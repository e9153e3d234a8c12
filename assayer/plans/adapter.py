"""Trips and zones derived from the ``events``, ``nation`` and ``region`` tables.

Every event becomes one raw all-string trip and every nation one zone, so the work grows with the tables. Some
rows are spoilt on purpose, by a rule on the event id, so that every validation rule has rows to catch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.contracts import SOURCE_PATH, TRIP_COLUMNS, ZONE_COLUMNS

_MONEY = "decimal(12,2)"
_FARE = f"cast(value as {_MONEY})"
_TIP = "concat(event_id % 500 div 100, '.', lpad(event_id % 100, 2, '0'))"
_ZERO = "'0.00'"
_TIME = "substring(cast({} as string), 1, 19)"
_DROPOFF = _TIME.format("ts + make_dt_interval(0, 0, cast((event_id * 7 % 61) - 2 as int))")
_TOTAL = f"cast({_FARE} + cast({_TIP} as {_MONEY}) as string)"

# Raw trip column -> SQL over one event.
_TRIP_SQL: dict[str, str] = {
    "VendorID": "1 + event_id % 2",
    # Text that is no time, a fraction of a second, a day that does not exist, a day alone.
    "tpep_pickup_datetime": (
        f"case when event_id % 211 = 0 then 'bad-ts' when event_id % 257 = 0 then concat({_TIME.format('ts')}, '.5')"
        f" when event_id % 263 = 0 then '2024-02-30 08:15:00' when event_id % 269 = 0 then substring({_TIME.format('ts')}, 1, 10)"
        f" else {_TIME.format('ts')} end"
    ),
    "tpep_dropoff_datetime": f"if(event_id % 223 = 0, 'bad-ts', {_DROPOFF})",
    "passenger_count": "1 + event_id % 4",
    "trip_distance": (
        "case when event_id % 227 = 0 then null when event_id % 1009 = 0 then 'NaN'"
        " else concat(event_id * 13 % 240 div 10, '.', event_id * 13 % 10, '0') end"
    ),
    "RatecodeID": "if(event_id % 7 = 0, '1.0', '1')",
    "store_and_fwd_flag": "'N'",
    "PULocationID": "if(event_id % 229 = 0, null, user_id % 30)",
    "DOLocationID": "if(event_id % 233 = 0, 'x', cast(user_id * 7 % 25 as string))",
    "payment_type": (
        "case when event_id % 251 = 0 then null when event_id % 13 = 0 then concat(' ', 1 + event_id % 4, ' ')"
        " else cast(1 + event_id % 4 as string) end"
    ),
    # Half a cent, and more than the type holds.
    "fare_amount": (
        f"case when event_id % 239 = 0 then '-1.00' when event_id % 277 = 0 then '99999999999.99'"
        f" when event_id % 271 = 0 then concat(cast({_FARE} as string), '5') else cast({_FARE} as string) end"
    ),
    "extra": _ZERO,
    "mta_tax": _ZERO,
    "tip_amount": f"if(event_id % 281 = 0, null, {_TIP})",
    "tolls_amount": _ZERO,
    "improvement_surcharge": _ZERO,
    "total_amount": f"case when event_id % 241 = 0 then '' when event_id % 283 = 0 then concat({_TOTAL}, '5') else {_TOTAL} end",
    "congestion_surcharge": _ZERO,
    "airport_fee": _ZERO,
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 raw columns, all strings, in contract order, with the event id kept beside them."""
    columns = [f"cast({_TRIP_SQL[name]} AS string) AS {name}" for name in TRIP_COLUMNS]
    return read_table(spark, sf_dir, "events").selectExpr(*columns, "event_id")


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips as three batches that arrived one hour apart."""
    return raw_trips(spark, sf_dir).select(
        *TRIP_COLUMNS,
        F.lit("events").alias(SOURCE_PATH),
        F.expr("concat('batch-', event_id % 3)").alias("_batch_id"),
        F.expr("timestamp'2024-02-01 00:00:00' + make_dt_interval(0, cast(event_id % 3 as int))").alias("_ingested_at"),
    )


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones and regions as boroughs, padded with blanks for trimming, all strings. Two lack an attribute."""
    nation, region = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    zones = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left").select(
        F.col("n_nationkey").cast("string").alias("LocationID"),
        F.when(F.col("n_nationkey") != 7, F.concat(F.lit(" "), "r_name", F.lit("  "))).alias("Borough"),
        F.concat("n_name", F.lit(" ")).alias("Zone"),
        F.when(F.col("n_nationkey") != 9, F.concat(F.lit("  service-"), F.col("n_regionkey").cast("string"))).alias("service_zone"),
    )
    return zones.select(*ZONE_COLUMNS, F.lit("nation").alias(SOURCE_PATH))
