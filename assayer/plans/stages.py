"""Stage jobs: read a dataset, apply operators, write the next dataset, return a summary.

Each works on directories of its own choosing; ``run_all`` chains them over a snapshot store instead, see ``lake``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.contracts import DAILY_SCHEMA, HOURLY_SCHEMA, SILVER_SCHEMA, SOURCE_UNIT, VALID_TRIP_COLUMNS, require_columns
from assayer.operators.metrics import merge_daily, merge_hourly, trip_rollup
from assayer.operators.pending import Month, clear, mark, marked, month_name, month_of
from assayer.operators.projections import build_silver, with_lineage, zone_dimension
from assayer.operators.publish import PublishSummary, Window, publish_marts
from assayer.operators.quality import assert_non_empty, assert_unique_non_null_key, checked_key
from assayer.operators.sinks import overwrite, overwrite_by_month, overwrite_silver, unit_path
from assayer.operators.zones import BROADCAST_LIMIT_BYTES, attach_zone, text_bytes
from assayer.plans.lake import load, publish_changes, refresh_gold, store_at
from assayer.plans.scratch import scratch_dir
from assayer.plans.summaries import (
    BronzeSummary,
    GoldSummary,
    Loaded,
    RunSummary,
    SilverSummary,
    Written,
    month_windows,
    require_utc,
)
from assayer.sources import SourceSpec, ensure_available, listed_bytes, path_exists, scan_dataset, scan_trips, scan_zones_csv
from assayer.sources.specs import Fetch
from assayer.sources.storage import remove


def run_bronze(
    spark: SparkSession,
    *,
    spec: SourceSpec,
    output_path: str,
    batch_id: str,
    ingested_at: datetime,
    fetch: Fetch | None = None,
    replace: str = "all",
) -> BronzeSummary:
    """Raw trips to the all-string bronze dataset with lineage. One pass, no shuffle.

    Rows lie below a directory for each source unit. ``replace='all'`` replaces the dataset, ``replace='unit'`` only
    what the same unit (a month, or a source without months) wrote before.
    """
    require_utc(spark)
    ensure_available(spark, spec, fetch=fetch)
    raw = scan_trips(spark, spec)
    bronze = with_lineage(raw, batch_id=batch_id, ingested_at=ingested_at)
    if _by_unit(replace):
        written = overwrite(bronze, unit_path(output_path, spec.unit))
    else:
        unit_path(output_path, spec.unit)
        written = overwrite(bronze.withColumn(SOURCE_UNIT, F.lit(spec.unit)), output_path, partition_by=[SOURCE_UNIT])
    return BronzeSummary(spec, listed_bytes(raw), Written(output_path, written["rows"]), batch_id, ingested_at)


def _by_unit(replace: str) -> bool:
    if replace not in ("all", "unit"):
        raise ValueError(f"replace has to be 'all' or 'unit', not {replace!r}")
    return replace == "unit"


def run_zones(spark: SparkSession, *, spec: SourceSpec, output_path: str, fetch: Fetch | None = None) -> Loaded:
    """Zone lookup to the zone dimension, checked to be non-empty with a unique, non-null id before it is written."""
    ensure_available(spark, spec, fetch=fetch)
    raw = scan_zones_csv(spark, spec.path)
    zones = zone_dimension(raw)
    row_count = assert_unique_non_null_key(zones, key="location_id", dataset="zone dimension")
    assert_non_empty({"zone dimension": row_count})
    overwrite(zones, output_path)
    return Loaded(spec, listed_bytes(raw), Written(output_path, row_count))


def run_silver(spark: SparkSession, *, bronze_path: str, silver_path: str, unit: str | None = None) -> SilverSummary:
    """Bronze to typed, rule-checked rows, valid and invalid ones side by side. One scan, no shuffle, no cache.

    With ``unit`` only that source unit's bronze is read and only its silver rows, of both sides, are replaced. The
    summary names every month whose valid rows changed, those that lost their last row included, and every month that
    an earlier load changed and ``run_gold`` has not taken over since. The months are noted before anything is replaced,
    so a load that fails, here or later, leaves them to the next.
    """
    require_utc(spark)
    before = silver_months(spark, silver_path, unit)
    if unit is not None:
        waiting = set(marked(spark, silver_path))
        mark(spark, silver_path, sorted(before - waiting))
        before |= waiting
    if unit is None:
        bronze = scan_dataset(spark, bronze_path)
        units = F.col(SOURCE_UNIT).cast("string") if SOURCE_UNIT in bronze.columns else F.lit("all")
        # The unit travels beside the contract's columns.
        tagged = build_silver(bronze.withColumn(SOURCE_UNIT, units), keep=(SOURCE_UNIT,))
    else:
        tagged = build_silver(scan_dataset(spark, unit_path(bronze_path, unit)))
    written = overwrite_silver(tagged, silver_path, unit=unit)
    after = silver_months(spark, silver_path, unit)
    if unit is not None:
        mark(spark, silver_path, sorted(after - before))
    months = sorted(before | after)
    return SilverSummary(bronze_path, silver_path, written["valid_rows"], written["invalid_rows"], tuple(months))


def _silver_rows(spark: SparkSession, silver_path: str, below: str) -> DataFrame | None:
    """Silver below the given directories, a glob. Only these are listed; None where there are none."""
    where = f"{silver_path}/{below}"
    if not path_exists(spark, where):
        return None
    layout = [T.StructField(name, T.StringType()) for name in (SOURCE_UNIT, "row_set", "row_month")]
    return spark.read.schema(T.StructType([*SILVER_SCHEMA.fields, *layout])).option("basePath", silver_path).parquet(where)


def silver_months(spark: SparkSession, silver_path: str, unit: str | None = None) -> set[Month]:
    """The months with valid rows, of one source unit or of all; directory names are all that is read."""
    rows = _silver_rows(spark, silver_path, f"{SOURCE_UNIT}={unit or '*'}/row_set=valid/row_month=*")
    names = [] if rows is None else [r["row_month"] for r in rows.select("row_month").distinct().collect()]
    return {month_of(name) for name in names}


def read_silver(
    spark: SparkSession, silver_path: str, *, valid: bool = True, months: Sequence[Month] | None = None
) -> DataFrame:
    """The valid or the invalid rows of a silver dataset; no other directories are listed. ``months`` are for valid rows."""
    side = f"{SOURCE_UNIT}=*/row_set={'valid' if valid else 'invalid'}/row_month="
    wanted = "*" if months is None else "{" + ",".join(month_name(month) for month in months) + "}"
    rows = _silver_rows(spark, silver_path, side + wanted) if months is None or months else None
    return spark.createDataFrame([], SILVER_SCHEMA) if rows is None else rows.select(*SILVER_SCHEMA.names)


def run_gold(
    spark: SparkSession,
    *,
    silver_path: str,
    zones_path: str,
    daily_path: str,
    hourly_path: str,
    rollup_path: str | None = None,
    months: Sequence[Month] | None = None,
) -> GoldSummary:
    """Valid trips and zones to both gold tables.

    The trips are scanned once, into a rollup table that the summary and both gold tables are read from. The
    table is a plain dataset in shared storage, so lost executors cost no second scan of the trips. The summary is
    observed in the writes.

    Without ``months`` both gold tables are replaced. With ``months``, given as (year, month) pairs, only the silver
    directories of those months are read, of all source units, and exactly their gold partitions are replaced: a month
    without trips left has none afterwards. Give it the ``months`` of the silver run. The months are noted at the gold
    tables for ``run_publish`` before they change, and their notes at silver go when both tables are written.
    """
    require_utc(spark)
    taken = marked(spark, silver_path)
    if months is not None:
        mark(spark, daily_path, months)
    trips = require_columns(read_silver(spark, silver_path, months=months), VALID_TRIP_COLUMNS, "valid trips")
    zones = scan_dataset(spark, zones_path)
    sizes = checked_key(zones, key="location_id", dataset="zone dimension", bytes=text_bytes(zones))
    own_rollup = rollup_path is None
    rollup_path = rollup_path or scratch_dir(spark, "trip-rollup")
    reduced = trip_rollup(trips)
    overwrite(reduced, rollup_path)
    rollup = scan_dataset(spark, rollup_path, reduced.schema)
    daily = merge_daily(attach_zone(rollup, zones, broadcast=sizes["bytes"] <= BROADCAST_LIMIT_BYTES), keep_match=True)
    summed = {
        "trips": F.coalesce(F.sum("trip_count"), F.lit(0)),
        "unmatched": F.coalesce(F.sum(F.when(F.col("_zone_lookup_matched"), 0).otherwise(F.col("trip_count"))), F.lit(0)),
        "first": F.min("pickup_date"),
        "last": F.max("pickup_date"),
    }
    seen = overwrite_by_month(daily, daily_path, months=months, measures=summed, drop=["_zone_lookup_matched"])
    hourly_rows = overwrite_by_month(merge_hourly(rollup), hourly_path, months=months)["rows"]
    clear(spark, taken, taken if months is None else months)
    if own_rollup:
        remove(spark, rollup_path)
    return GoldSummary(
        inputs={"silver": silver_path, "zones": zones_path},
        daily=Written(daily_path, seen["rows"]),
        hourly=Written(hourly_path, hourly_rows),
        trips=seen["trips"],
        unmatched_trips=seen["unmatched"],
        window=(seen["first"], seen["last"]),
    )


def read_gold(spark: SparkSession, daily_path: str, hourly_path: str) -> tuple[DataFrame, DataFrame]:
    """Both gold tables, in their column order whatever the partition layout."""
    daily = scan_dataset(spark, daily_path, DAILY_SCHEMA).select(*DAILY_SCHEMA.names)
    hourly = scan_dataset(spark, hourly_path, HOURLY_SCHEMA).select(*HOURLY_SCHEMA.names)
    return daily, hourly


def run_publish(
    spark: SparkSession,
    *,
    daily_path: str,
    hourly_path: str,
    mart_root: str,
    run_id: str,
    window: Window | None = None,
    months: Sequence[Month] | None = None,
) -> PublishSummary:
    """Both gold tables to the marts, together or not at all.

    With ``months`` only their days are read, staged and replaced, and those of months that ``run_gold`` changed and no
    publish has taken over since. Days between months that do not follow each other are left alone.
    """
    if not run_id.strip():
        raise ValueError("a run_id is required")
    if months is not None and (window is not None or not months):
        raise ValueError("give a window, or at least one month")
    daily, hourly = read_gold(spark, daily_path, hourly_path)
    waiting = marked(spark, daily_path)
    if months is None:
        summary = publish_marts(spark, daily, hourly, root=mart_root, run_id=run_id, window=window)
        # A window may leave out some of what has changed.
        clear(spark, waiting, waiting if window is None else ())
        return summary
    wanted = sorted({*months, *waiting})
    # On the partition columns, so that other months are not read.
    within = (F.col("pickup_year") * 12 + F.col("pickup_month")).isin([year * 12 + month for year, month in wanted])
    summary = publish_marts(
        spark, daily.filter(within), hourly.filter(within), root=mart_root, run_id=run_id, windows=month_windows(wanted)
    )
    clear(spark, waiting, wanted)
    return summary


def run_all(
    spark: SparkSession,
    *,
    trips: SourceSpec,
    zones: SourceSpec,
    root: str,
    run_id: str,
    ingested_at: datetime,
    fetch: Fetch | None = None,
    replace: str = "all",
) -> RunSummary:
    """The whole chain below ``root``: zones and bronze, silver, gold, marts. ``run_id`` names batch and publish.

    With ``replace='unit'`` a run loads its source unit beside those of earlier runs: it replaces the unit's bronze and
    silver rows, recomputes every month the unit had or has valid rows in, and publishes these months. With 'all' the
    unit becomes the only one.

    All datasets lie in one snapshot store, so each step is there as a whole or not at all, and readers are never in
    between. A run that fails leaves its unfinished months to the next one, whatever that loads; give it a new run id.
    """
    store = store_at(spark, root)
    loaded = load(store, trips=trips, zones=zones, batch_id=run_id, ingested_at=ingested_at, fetch=fetch, by_unit=_by_unit(replace))
    gold = refresh_gold(store)
    publish = publish_changes(store, f"{root}/marts", run_id=run_id, everything=replace == "all")
    return RunSummary(*loaded, gold, publish)


def run_metrics(spark: SparkSession, run: RunSummary) -> DataFrame:
    """(stage, metric, value) rows of a run, values as text: counts, rates, window, paths, names and ids."""
    stages = {"zones": run.zones, "bronze": run.bronze, "silver": run.silver, "gold": run.gold}
    values = {name: stage.metrics() for name, stage in stages.items()}
    if run.publish is not None:
        inputs = {"daily_path": run.gold.daily.path, "hourly_path": run.gold.hourly.path}
        values["publish"] = {**inputs, **run.publish.metrics()}
    rows = [(stage, metric, None if v is None else str(v)) for stage, of in values.items() for metric, v in of.items()]
    return spark.createDataFrame(rows, "stage string, metric string, value string")
