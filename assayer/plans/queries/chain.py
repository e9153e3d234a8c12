"""Sinks and stage jobs: each writes to scratch storage, and what was written is read back."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.contracts import DAILY_MART, DAILY_SCHEMA, HOURLY_MART, HOURLY_SCHEMA, MONTH_PARTITIONS, SOURCE_PATH, SOURCE_UNIT, TRIP_COLUMNS, ZONE_COLUMNS
from assayer.operators.publish import read_mart
from assayer.operators.sinks import overwrite, overwrite_gold_pair, overwrite_silver, overwrite_silver_pair
from assayer.operators.snapshots import Change, Part, SnapshotStore
from assayer.plans import lake, stages
from assayer.plans.queries.registry import Tables, comparable, query, reasons_as_text
from assayer.plans.scratch import scratch_dir
from assayer.sources import SourceSpec, scan_dataset

_ARRIVAL = datetime(2024, 2, 1, 6, 30, tzinfo=UTC)
_SILVER = "SELECT * FROM silver"
_ONE_BATCH = (
    "SELECT * EXCLUDE (pickup_year, pickup_month) REPLACE (1 AS source_batch_count,"
    " TIMESTAMP '2024-02-01 06:30:00' AS latest_source_ingested_at), 'run-1' AS publish_run_id FROM {}"
)


def _trip_spec(t: Tables) -> SourceSpec:
    path = scratch_dir(t.spark, "trips")
    t.raw.select(*TRIP_COLUMNS).write.parquet(path)
    return SourceSpec(path, "parquet", "tlc", (2024, 1))


def _zone_spec(t: Tables) -> SourceSpec:
    path = scratch_dir(t.spark, "zones-csv")
    t.raw_zones.select(*ZONE_COLUMNS).write.option("header", True).csv(path)
    return SourceSpec(path, "csv", "lookup")


def _written(t: Tables, df: DataFrame, purpose: str) -> str:
    path = scratch_dir(t.spark, purpose)
    overwrite(df, path)
    return path


def _both_sides(t: Tables, path: str) -> DataFrame:
    return stages.read_silver(t.spark, path).unionByName(stages.read_silver(t.spark, path, valid=False))


# ---- sinks ----


@query("sink_overwrite", "SELECT pickup_date, pickup_hour, trip_count FROM hourly")
def _(t: Tables) -> DataFrame:
    """The second write replaces the first."""
    path = _written(t, t.hourly.select("pickup_date", "pickup_hour"), "sink")
    overwrite(t.hourly.select("pickup_date", "pickup_hour", "trip_count"), path)
    return scan_dataset(t.spark, path)


@query("sink_overwrite_partitioned", "SELECT * FROM hourly")
def _(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "sink")
    overwrite(t.hourly, path, partition_by=MONTH_PARTITIONS)
    return comparable(scan_dataset(t.spark, path))


@query(
    "sink_replace_partitions",
    "SELECT pickup_date, pickup_hour, CASE WHEN pickup_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
    " THEN -trip_count ELSE trip_count END AS trip_count FROM hourly",
)
def _(t: Tables) -> DataFrame:
    """Partitions by date: the second write touches only the dates it has rows for."""
    path = scratch_dir(t.spark, "sink")
    rows = t.hourly.select("pickup_date", "pickup_hour", "trip_count")
    overwrite(rows, path, partition_by=["pickup_date"])
    some = rows.filter("pickup_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
    negated = some.withColumn("trip_count", -F.col("trip_count"))
    overwrite(negated, path, partition_by=["pickup_date"], replace="partitions")
    return scan_dataset(t.spark, path)


@query("sink_silver_pair", _SILVER)
def _(t: Tables) -> DataFrame:
    valid, invalid = scratch_dir(t.spark, "valid"), scratch_dir(t.spark, "invalid")
    overwrite_silver_pair(t.silver, valid, invalid)
    both = scan_dataset(t.spark, valid).unionByName(scan_dataset(t.spark, invalid))
    return reasons_as_text(both)


@query("sink_silver_one_pass", _SILVER)
def _(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "silver")
    overwrite_silver(t.silver, path)
    return reasons_as_text(_both_sides(t, path))


@query(
    "sink_gold_pair",
    "SELECT 'zone' AS grain, * FROM daily UNION ALL BY NAME SELECT 'hour' AS grain, * FROM hourly",
)
def _(t: Tables) -> DataFrame:
    daily_path, hourly_path = scratch_dir(t.spark, "daily"), scratch_dir(t.spark, "hourly")
    overwrite_gold_pair(t.daily, t.hourly, daily_path, hourly_path)
    parts = [scan_dataset(t.spark, path).withColumn("grain", F.lit(grain)) for path, grain in ((daily_path, "zone"), (hourly_path, "hour"))]
    return comparable(parts[0].unionByName(parts[1], allowMissingColumns=True))


@query("sink_snapshot_after_failure", "SELECT 'zone' AS grain, * FROM daily UNION ALL BY NAME SELECT 'hour' AS grain, * FROM hourly")
def _(t: Tables) -> DataFrame:
    """A write that dies half way and one whose commit never comes leave both tables as they were."""
    store = SnapshotStore(t.spark, scratch_dir(t.spark, "store"))
    # Each table is computed from the trips once; the writes that fail are of the same rows.
    daily, hourly = (scan_dataset(t.spark, _written(t, rows, name), schema) for name, rows, schema in (("daily", t.daily, DAILY_SCHEMA), ("hourly", t.hourly, HOURLY_SCHEMA)))

    def part(dataset: str, rows: DataFrame) -> Part:
        path = store.fresh(dataset, "all")
        return Part(path, overwrite(rows, store.full(path), partition_by=MONTH_PARTITIONS)["rows"])

    tables = {"daily": (daily, DAILY_SCHEMA), "hourly": (hourly, HOURLY_SCHEMA)}
    first = store.commit(store.current(), Change({(name, "all"): part(name, rows) for name, (rows, _) in tables.items()}))
    part("daily", daily.withColumn("trip_count", -F.col("trip_count")))
    dying = F.when(F.col("pickup_hour") == 23, F.raise_error(F.lit("died while writing"))).otherwise(F.col("trip_count"))
    try:
        part("hourly", hourly.withColumn("trip_count", dying.cast("bigint")))
    except Exception as error:
        if "died while writing" not in str(error):
            raise
    else:
        raise AssertionError("the write went through")
    now = store.current()
    if now != first:
        raise AssertionError("a failed write changed the snapshot")
    read = [store.read(now, name, schema).withColumn("grain", F.lit(grain)) for (name, (_, schema)), grain in zip(tables.items(), ("zone", "hour"), strict=True)]
    return comparable(read[0].unionByName(read[1], allowMissingColumns=True))


# ---- stages ----


@query(
    "run_bronze",
    "SELECT *, 'run-1' AS _batch_id, TIMESTAMP '2024-02-01 06:30:00' AS _ingested_at FROM raw",
)
def _(t: Tables) -> DataFrame:
    out = scratch_dir(t.spark, "bronze")
    stages.run_bronze(t.spark, spec=_trip_spec(t), output_path=out, batch_id="run-1", ingested_at=_ARRIVAL)
    return scan_dataset(t.spark, out).drop(SOURCE_PATH, SOURCE_UNIT)


@query("run_zones", "SELECT * EXCLUDE (_source_file_path) FROM zone_dim")
def _(t: Tables) -> DataFrame:
    out = scratch_dir(t.spark, "zones")
    stages.run_zones(t.spark, spec=_zone_spec(t), output_path=out)
    return scan_dataset(t.spark, out).drop(SOURCE_PATH)


def _silver_at(t: Tables) -> str:
    path = scratch_dir(t.spark, "silver")
    stages.run_silver(t.spark, bronze_path=_written(t, t.bronze, "bronze"), silver_path=path)
    return path


@query("run_silver", _SILVER)
def _(t: Tables) -> DataFrame:
    path = _silver_at(t)
    return reasons_as_text(_both_sides(t, path))


def _gold_at(t: Tables) -> tuple[str, str]:
    daily_path, hourly_path = scratch_dir(t.spark, "daily"), scratch_dir(t.spark, "hourly")
    stages.run_gold(
        t.spark,
        silver_path=_silver_at(t),
        zones_path=_written(t, t.zones, "zones"),
        daily_path=daily_path,
        hourly_path=hourly_path,
    )
    return daily_path, hourly_path


@query("run_gold", "SELECT * FROM daily")
def _(t: Tables) -> DataFrame:
    return comparable(scan_dataset(t.spark, _gold_at(t)[0], DAILY_SCHEMA))


@query("run_gold_hourly", "SELECT * FROM hourly")
def _(t: Tables) -> DataFrame:
    return comparable(scan_dataset(t.spark, _gold_at(t)[1], HOURLY_SCHEMA))


# ---- loads by source unit: two units share every day, one is loaded spoilt first and then again ----


def _unit_spec(t: Tables, month: int, rows: DataFrame) -> SourceSpec:
    path = scratch_dir(t.spark, "trips")
    rows.select(*TRIP_COLUMNS).write.parquet(path)
    return SourceSpec(path, "parquet", "tlc", (2024, month))


def _unit_loads(t: Tables) -> list[SourceSpec]:
    """Even events as one unit. Odd ones as another: first with pickups a month late and some fares spoilt, then as they are."""
    even, odd = (t.raw.filter(F.col("event_id") % 2 == half) for half in (0, 1))
    late = {c: F.regexp_replace(c, "^2024-01", "2024-02") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    spoilt = odd.withColumns({**late, "fare_amount": F.when(F.col("event_id") % 5 == 0, "none").otherwise(F.col("fare_amount"))})
    return [_unit_spec(t, 1, even), _unit_spec(t, 2, spoilt), _unit_spec(t, 2, odd)]


def _loaded_by_unit(t: Tables) -> tuple[str, list[stages.SilverSummary]]:
    bronze, silver = scratch_dir(t.spark, "bronze"), scratch_dir(t.spark, "silver")
    runs = []
    for number, spec in enumerate(_unit_loads(t)):
        stages.run_bronze(t.spark, spec=spec, output_path=bronze, batch_id=f"run-{number}", ingested_at=_ARRIVAL, replace="unit")
        runs.append(stages.run_silver(t.spark, bronze_path=bronze, silver_path=silver, unit=spec.unit))
    return silver, runs


_BATCHLESS = "SELECT * EXCLUDE ({}) FROM {}"


@query("run_silver_monthly", _BATCHLESS.format("_batch_id, _ingested_at, _source_file_path", "silver"))
def _(t: Tables) -> DataFrame:
    """Nothing of a unit's spoilt load stays, valid or invalid, and nothing of the other unit is lost."""
    path, _ = _loaded_by_unit(t)
    return reasons_as_text(_both_sides(t, path)).drop("_batch_id", "_ingested_at", SOURCE_PATH)


@query("run_gold_monthly", _BATCHLESS.format("source_batch_count, latest_source_ingested_at", "daily"))
def _(t: Tables) -> DataFrame:
    """After the spoilt load and after the right one only the months touched are computed; February is emptied."""
    silver, daily, hourly = (scratch_dir(t.spark, name) for name in ("silver", "daily", "hourly"))
    bronze, zones = scratch_dir(t.spark, "bronze"), _written(t, t.zones, "zones")
    for number, spec in enumerate(_unit_loads(t)):
        stages.run_bronze(t.spark, spec=spec, output_path=bronze, batch_id=f"run-{number}", ingested_at=_ARRIVAL, replace="unit")
        run = stages.run_silver(t.spark, bronze_path=bronze, silver_path=silver, unit=spec.unit)
        stages.run_gold(t.spark, silver_path=silver, zones_path=zones, daily_path=daily, hourly_path=hourly, months=run.months)
    return comparable(stages.read_gold(t.spark, daily, hourly)[0].drop("source_batch_count", "latest_source_ingested_at"))


@query(
    "run_all_two_months",
    "SELECT * EXCLUDE (pickup_year, pickup_month, source_batch_count, latest_source_ingested_at), 'run-2' AS publish_run_id FROM daily",
)
def _(t: Tables) -> DataFrame:
    """Units through the whole chain to the marts; the last publish covers both months, of which one is now empty."""
    root, zones = scratch_dir(t.spark, "all"), _zone_spec(t)
    for number, spec in enumerate(_unit_loads(t)):
        stages.run_all(t.spark, trips=spec, zones=zones, root=root, run_id=f"run-{number}", ingested_at=_ARRIVAL, replace="unit")
    mart = read_mart(t.spark, f"{root}/marts", DAILY_MART)
    return comparable(mart.drop("published_at", "source_batch_count", "latest_source_ingested_at"))


@query("run_gold_incremental", _BATCHLESS.format("source_batch_count, latest_source_ingested_at", "daily"))
def _(t: Tables) -> DataFrame:
    """Gold merged from the stored rollups of both units; a reload computes that of its unit only."""
    store, zones = lake.store_at(t.spark, scratch_dir(t.spark, "incremental")), _zone_spec(t)
    for number, spec in enumerate(_unit_loads(t)):
        lake.load(store, trips=spec, zones=zones, batch_id=f"run-{number}", ingested_at=_ARRIVAL)
        lake.refresh_gold(store)
    return comparable(lake.read_gold_tables(store)[0].drop("source_batch_count", "latest_source_ingested_at"))


@query("silver_compacted", _BATCHLESS.format("_batch_id, _ingested_at, _source_file_path", "silver"))
def _(t: Tables) -> DataFrame:
    """Both units' silver after compaction, and after a reload of one of them, compacted again."""
    store, zones = lake.store_at(t.spark, scratch_dir(t.spark, "compacted")), _zone_spec(t)
    even, spoilt, odd = _unit_loads(t)
    for number, specs in enumerate(((even, spoilt), (odd,))):
        for spec in specs:
            lake.load(store, trips=spec, zones=zones, batch_id=f"run-{number}", ingested_at=_ARRIVAL)
        lake.compact_silver(store)
    both = lake.read_units(store).unionByName(lake.read_units(store, valid=False))
    return reasons_as_text(both).drop("_batch_id", "_ingested_at", SOURCE_PATH)


@query(
    "run_all_after_failure",
    "SELECT * EXCLUDE (pickup_year, pickup_month, source_batch_count, latest_source_ingested_at), 'run-3' AS publish_run_id FROM daily",
)
def _(t: Tables) -> DataFrame:
    """The corrected load dies before gold, so that its unit holds nothing of February any more; the retry has to empty it."""
    root, zones = scratch_dir(t.spark, "all"), _zone_spec(t)
    even, spoilt, odd = _unit_loads(t)
    for number, spec in enumerate((even, spoilt)):
        stages.run_all(t.spark, trips=spec, zones=zones, root=root, run_id=f"run-{number}", ingested_at=_ARRIVAL, replace="unit")
    lake.load(lake.store_at(t.spark, root), trips=odd, zones=zones, batch_id="run-2", ingested_at=_ARRIVAL)
    stages.run_all(t.spark, trips=odd, zones=zones, root=root, run_id="run-3", ingested_at=_ARRIVAL, replace="unit")
    mart = read_mart(t.spark, f"{root}/marts", DAILY_MART)
    return comparable(mart.drop("published_at", "source_batch_count", "latest_source_ingested_at"))


def _run_all(t: Tables) -> tuple[str, stages.RunSummary]:
    root = scratch_dir(t.spark, "all")
    run = stages.run_all(
        t.spark, trips=_trip_spec(t), zones=_zone_spec(t), root=root, run_id="run-1", ingested_at=_ARRIVAL
    )
    return root, run


@query("run_all", _ONE_BATCH.format("daily"))
def _(t: Tables) -> DataFrame:
    root, _ = _run_all(t)
    return comparable(read_mart(t.spark, f"{root}/marts", DAILY_MART).drop("published_at"))


@query("run_all_hourly", _ONE_BATCH.format("hourly"))
def _(t: Tables) -> DataFrame:
    root, _ = _run_all(t)
    return comparable(read_mart(t.spark, f"{root}/marts", HOURLY_MART).drop("published_at"))


_COUNTS = {
    ("zones", "row_count"): "count(*) FROM zone_dim",
    ("bronze", "row_count"): "count(*) FROM bronze",
    ("silver", "total_row_count"): "count(*) FROM silver",
    ("silver", "valid_row_count"): "count(*) FROM valid",
    ("silver", "invalid_row_count"): "count(*) FROM silver WHERE NOT is_valid",
    ("silver", "months"): "max(strftime(pickup_date, '%Y-%m')) FROM valid",
    ("gold", "valid_trip_count"): "count(*) FROM valid",
    ("gold", "unmatched_zone_count"): "count(*) FROM enriched WHERE NOT _zone_lookup_matched",
    **{(stage, "daily_zone_row_count"): "count(*) FROM daily" for stage in ("gold", "publish")},
    **{(stage, "hourly_demand_row_count"): "count(*) FROM hourly" for stage in ("gold", "publish")},
    **{(stage, "date_from"): "min(pickup_date) FROM valid" for stage in ("gold", "publish")},
    **{(stage, "date_to"): "max(pickup_date) FROM valid" for stage in ("gold", "publish")},
    ("silver", "invalid_row_rate"): "printf('%.6f', avg(CASE WHEN is_valid THEN 0e0 ELSE 1e0 END)) FROM silver",
    ("gold", "zone_match_rate"): "printf('%.6f', avg(CASE WHEN _zone_lookup_matched THEN 1e0 ELSE 0e0 END)) FROM enriched",
}
_NAMES = {
    ("zones", "source"): "lookup",
    ("zones", "source_unit"): "lookup",
    ("zones", "file_format"): "csv",
    ("zones", "source_year"): None,
    ("zones", "source_month"): None,
    ("bronze", "source"): "tlc",
    ("bronze", "source_unit"): "tlc-2024-01",
    ("bronze", "file_format"): "parquet",
    ("bronze", "source_year"): "2024",
    ("bronze", "source_month"): "1",
    ("bronze", "batch_id"): "run-1",
    ("gold", "partition_columns"): "pickup_year,pickup_month",
    ("publish", "run_id"): "run-1",
    ("publish", "mart_version"): "1",
    ("publish", "daily_table"): DAILY_MART.name,
    ("publish", "hourly_table"): HOURLY_MART.name,
    ("publish", "log_table"): "run_log",
}


def _metrics_sql() -> str:
    told = {key: f"SELECT {sql}" for key, sql in _COUNTS.items()}
    told |= {key: "SELECT NULL" if name is None else f"SELECT '{name}'" for key, name in _NAMES.items()}
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{metric}' AS metric, CAST(({sql}) AS VARCHAR) AS value" for (stage, metric), sql in told.items()
    )


@query("run_metrics", _metrics_sql())
def _(t: Tables) -> DataFrame:
    """Counts, rates, windows, formats, units and names of every stage; only sizes, times and paths are not compared."""
    _, run = _run_all(t)
    rounded = F.format_string("%.6f", F.expr("try_cast(value AS double)"))
    value = F.when(F.col("metric").rlike("_rate$"), rounded).otherwise(F.col("value"))
    told = ~F.col("metric").rlike("(_path|_bytes|_url|ingested_at)$")
    return stages.run_metrics(t.spark, run).filter(told).withColumn("value", value)
