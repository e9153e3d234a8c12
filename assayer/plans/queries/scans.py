"""Scans: the derived trips and zones are written as source files and read back through each reader."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.contracts import MONTH_PARTITIONS, SOURCE_PATH, TRIP_COLUMNS, ZONE_COLUMNS
from assayer.operators.sinks import overwrite
from assayer.plans.queries.registry import Tables, query
from assayer.plans.scratch import scratch_dir
from assayer.sources import (
    SourceSpec,
    ensure_available,
    has_data,
    rename_drifted,
    scan_dataset,
    scan_trips,
    scan_trips_csv,
    scan_trips_parquet,
    scan_zones_csv,
    trip_source,
    zone_source,
)

_ZONES_AS_READ = (
    "SELECT location_id::VARCHAR AS \"LocationID\", borough AS \"Borough\", zone AS \"Zone\", service_zone,"
    " true AS has_source_path FROM zone_dim"
)
# The CSV reader takes an empty field for NULL.
_RAW_FROM_CSV = (
    "SELECT * REPLACE (nullif(total_amount, '') AS total_amount), true AS has_source_path FROM raw"
)


def _with_path_flag(df: DataFrame) -> DataFrame:
    """The path differs from run to run, so only its presence is compared."""
    return df.withColumn("has_source_path", F.col(SOURCE_PATH).isNotNull()).drop(SOURCE_PATH)


def _csv_at(df: DataFrame, path: str) -> str:
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, **blanks).mode("overwrite").csv(path)
    return path


def _trips_csv(t: Tables) -> str:
    return _csv_at(t.raw.select(*TRIP_COLUMNS), scratch_dir(t.spark, "trips-csv"))


def _trimmed_zones(t: Tables) -> DataFrame:
    return t.raw_zones.select("LocationID", *[F.trim(c).alias(c) for c in ZONE_COLUMNS[1:]])


def _trips_parquet(t: Tables, path: str | None = None) -> str:
    """Trips with the types and the drifted column name that monthly files come with."""
    path = path or scratch_dir(t.spark, "trips-parquet")
    times = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    drifted = t.raw.select(*TRIP_COLUMNS).withColumns(
        {
            "VendorID": F.col("VendorID").cast("bigint"),
            **{c: F.col(c).cast("double") for c in ("passenger_count", "tip_amount")},
            **{c: F.expr(f"cast(try_to_timestamp({c}, 'yyyy-MM-dd HH:mm:ss') as timestamp_ntz)") for c in times},
        }
    )
    drifted.withColumnRenamed("airport_fee", "Airport_fee").write.mode("overwrite").parquet(path)
    return path


_PASSENGERS = "passenger_count || '.0' AS passenger_count"
_SEVERAL = f"SELECT * REPLACE ({_PASSENGERS}), true AS has_source_path FROM raw"
_TIME_SQL = "strftime(try_strptime({0}, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS {0}"
_FROM_PARQUET = (
    f"SELECT * REPLACE ({_PASSENGERS}, CAST(CAST(tip_amount AS DOUBLE) AS VARCHAR) AS tip_amount,"
    f" {_TIME_SQL.format('tpep_pickup_datetime')}, {_TIME_SQL.format('tpep_dropoff_datetime')}), true AS has_source_path FROM raw"
)


@query("scan_trips_csv", _RAW_FROM_CSV)
def _(t: Tables) -> DataFrame:
    return _with_path_flag(scan_trips_csv(t.spark, _trips_csv(t)))


@query("scan_zones_csv", _ZONES_AS_READ)
def _(t: Tables) -> DataFrame:
    path = _csv_at(_trimmed_zones(t), scratch_dir(t.spark, "zones-csv"))
    return _with_path_flag(scan_zones_csv(t.spark, path, enforce_schema=False))


@query("scan_trips_parquet_as_string", _FROM_PARQUET)
def _(t: Tables) -> DataFrame:
    return _with_path_flag(scan_trips_parquet(t.spark, _trips_parquet(t)))


@query("scan_dispatch", f"SELECT 'csv' AS file_format, * FROM ({_RAW_FROM_CSV}) UNION ALL SELECT 'parquet', * FROM ({_FROM_PARQUET})")
def _(t: Tables) -> DataFrame:
    specs = [SourceSpec(_trips_csv(t), "csv", "sample"), SourceSpec(_trips_parquet(t), "parquet", "tlc")]
    read = [_with_path_flag(scan_trips(t.spark, spec)).withColumn("file_format", F.lit(spec.file_format)) for spec in specs]
    return read[0].unionByName(read[1])


@query("scan_several_parquet", _SEVERAL)
def _(t: Tables) -> DataFrame:
    """Two files whose physical types differ, united by name."""
    paths = [scratch_dir(t.spark, "trips-parquet") for _ in range(2)]
    halves = [t.raw.filter(F.col("event_id") % 2 == half).select(*TRIP_COLUMNS) for half in (0, 1)]
    halves[0].withColumn("passenger_count", F.col("passenger_count").cast("double")).write.parquet(paths[0])
    typed = {"VendorID": F.col("VendorID").cast("int"), "passenger_count": F.col("passenger_count").cast("double")}
    halves[1].withColumns(typed).withColumnRenamed("airport_fee", "Airport_fee").write.parquet(paths[1])
    return _with_path_flag(scan_trips_parquet(t.spark, *paths))


_TYPED = "VendorID = '1'"
_MIXED = f"""SELECT * REPLACE (
  CASE WHEN {_TYPED} THEN passenger_count || '.0' ELSE passenger_count END AS passenger_count,
  CASE WHEN {_TYPED} THEN {_TIME_SQL.format('tpep_pickup_datetime').removesuffix(' AS tpep_pickup_datetime')} ELSE tpep_pickup_datetime END AS tpep_pickup_datetime),
  true AS has_source_path FROM raw"""


@query("scan_mixed_folder", _MIXED)
def _(t: Tables) -> DataFrame:
    """One folder whose files differ in physical types and in the spelling of a column."""
    path = scratch_dir(t.spark, "mixed-folder")
    trips = t.raw.select(*TRIP_COLUMNS)
    typed = F.coalesce(F.expr(_TYPED), F.lit(False))
    pickup = F.expr("cast(try_to_timestamp(tpep_pickup_datetime, 'yyyy-MM-dd HH:mm:ss') as timestamp_ntz)")
    doubles = trips.filter(typed).withColumns({"passenger_count": F.col("passenger_count").cast("double"), "tpep_pickup_datetime": pickup})
    doubles.withColumnRenamed("airport_fee", "Airport_fee").write.parquet(path)
    trips.filter(~typed).withColumn("passenger_count", F.col("passenger_count").cast("int")).write.mode("append").parquet(path)
    return _with_path_flag(scan_trips_parquet(t.spark, path))


@query("scan_dataset", "SELECT event_id, value, CAST(year(ts) AS INTEGER) AS pickup_year, CAST(month(ts) AS INTEGER) AS pickup_month FROM events", chain=False)
def _(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "dataset")
    events = t.spark.read.parquet(f"{t.sf_dir}/events.parquet")
    dated = events.select(
        "event_id", "value", F.year("ts").alias("pickup_year"), F.month("ts").alias("pickup_month")
    )
    overwrite(dated, path, partition_by=MONTH_PARTITIONS)
    return scan_dataset(t.spark, path)


@query("resolve_monthly_source", _FROM_PARQUET)
def _(t: Tables) -> DataFrame:
    """The monthly file is looked up by source, year and month and read through its spec."""
    spec = trip_source(scratch_dir(t.spark, "monthly"), source="tlc", year=2024, month=1)
    _trips_parquet(t, spec.path)
    return _with_path_flag(scan_trips(t.spark, ensure_available(t.spark, spec)))


@query("resolve_zone_source", _ZONES_AS_READ)
def _(t: Tables) -> DataFrame:
    spec = zone_source(scratch_dir(t.spark, "lookup"))
    _csv_at(_trimmed_zones(t), spec.path)
    return _with_path_flag(scan_zones_csv(t.spark, ensure_available(t.spark, spec).path))


@query(
    "source_available",
    "SELECT 'filled' AS source, true AS available, count(*) AS row_count FROM raw UNION ALL SELECT 'absent', false, 0",
)
def _(t: Tables) -> DataFrame:
    path = _trips_parquet(t)

    def told(source: str, available: bool, rows: DataFrame) -> DataFrame:
        return rows.agg(F.lit(source).alias("source"), F.lit(available).alias("available"), F.count("*").alias("row_count"))

    filled = told("filled", has_data(t.spark, path), scan_trips_parquet(t.spark, path))
    return filled.unionByName(told("absent", has_data(t.spark, f"{path}-absent"), t.raw.limit(0)))


@query("column_drift_rename", "SELECT total_amount AS airport_fee, count(*) AS row_count FROM raw GROUP BY total_amount")
def _(t: Tables) -> DataFrame:
    """The totals stand in for the drifted column, so that its values tell it from others."""
    drifted = t.raw.withColumn("airport_fee", F.col("total_amount")).withColumnRenamed("airport_fee", "Airport_fee")
    return rename_drifted(drifted).groupBy("airport_fee").agg(F.count("*").alias("row_count"))
