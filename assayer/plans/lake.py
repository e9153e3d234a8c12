"""The chain over a snapshot store: loads by source unit, gold from stored rollups, publishes of what has changed.

Datasets of the store, with what is one part of each::

    zones      all                the zone dimension
    bronze     source unit        raw rows with lineage
    silver     source unit        typed rows, below row_set=valid|invalid / row_month=...
    rollup     source unit        its valid trips as mergeable partial sums, by month
    daily      month              gold by zone
    hourly     month              gold by hour

A load replaces a unit's zones, bronze, silver and rollup in one commit and notes the months to be recomputed in it. Gold
merges the rollups of all units for those months and swaps both tables' months in one commit, which passes the months on
to the publish. Trips are thus scanned once, when their unit is loaded, however many units share a month.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import reduce
from heapq import heappop, heappush

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.contracts import DAILY_SCHEMA, HOURLY_SCHEMA, LINEAGE_COLUMNS, MONTH_PARTITIONS, SILVER_SCHEMA, SOURCE_UNIT, TRIP_COLUMNS, VALID_TRIP_COLUMNS
from assayer.operators.metrics import merge_daily, merge_hourly, trip_rollup
from assayer.operators.pending import Month, month_name, month_of
from assayer.operators.projections import build_silver, with_lineage, zone_dimension
from assayer.operators.publish import PublishSummary, publish_marts
from assayer.operators.quality import assert_non_empty, assert_reconciled, checked_key
from assayer.operators.sinks import gathered, overwrite, silver_layout
from assayer.operators.snapshots import PART_KEY, Change, Part, Snapshot, SnapshotConflict, SnapshotStore
from assayer.operators.zones import BROADCAST_LIMIT_BYTES, attach_zone, text_bytes
from assayer.plans.summaries import BronzeSummary, GoldSummary, Loaded, SilverSummary, Written, month_windows, require_utc
from assayer.sources import SourceSpec, ensure_available, listed_bytes, scan_trips, scan_zones_csv
from assayer.sources.specs import Fetch
from assayer.sources.storage import files_below, names_below

GOLD, MARTS = "gold", "marts"
BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, T.TimestampType() if c == "_ingested_at" else T.StringType()) for c in (*TRIP_COLUMNS, *LINEAGE_COLUMNS)]
)
#: The directory columns of silver, and the size its files are compacted to.
SILVER_FOLDERS = ("row_set", "row_month")
SILVER_FILE_BYTES = 128 * 1024 * 1024
#: Files that one write of a compaction makes: each is a scan of its own, and a plan is to stay small.
FILES_AT_ONCE = 64
_ZONES: tuple[str, str] = ("zones", "all")
_VALID = "/row_set=valid"


def store_at(spark: SparkSession, root: str) -> SnapshotStore:
    """The store of a chain below ``root``."""
    return SnapshotStore(spark, f"{root}/lake")


# ---- loading ----


def _zones_part(store: SnapshotStore, spec: SourceSpec) -> tuple[Part, Loaded]:
    raw = scan_zones_csv(store.spark, spec.path)
    zones = zone_dimension(raw)
    told = F.xxhash64(*[c for c in zones.columns if not c.startswith("_")]).cast("decimal(20,0)")
    seen = checked_key(zones, key="location_id", dataset="zone dimension", bytes=text_bytes(zones), mark=F.sum(told))
    assert_non_empty({"zone dimension": seen["row_count"]})
    path = store.fresh(*_ZONES)
    overwrite(zones, store.full(path))
    # The mark tells whether the zones are others than before.
    part = Part(path, seen["row_count"], {"bytes": int(seen["bytes"]), "mark": str(seen["mark"])})
    return part, Loaded(spec, listed_bytes(raw), Written(store.full(path), part.rows))


def _months_of(part: Part | None) -> set[Month]:
    return {month_of(name) for name in part.notes["months"]} if part else set()


def _silver_part(store: SnapshotStore, bronze: DataFrame, unit: str) -> Part:
    path = store.fresh("silver", unit)
    seen = overwrite(
        silver_layout(build_silver(bronze)),
        store.full(path),
        partition_by=SILVER_FOLDERS,
        measures={"valid": F.count_if(F.col("is_valid"))},
    )
    names = names_below(store.spark, store.full(path) + _VALID)
    months = sorted(name.partition("=")[2] for name in names if name.startswith("row_month="))
    return Part(path, seen["rows"], {"valid": seen["valid"], "months": months})


def rollup_schema(spark: SparkSession) -> T.StructType:
    return trip_rollup(spark.createDataFrame([], SILVER_SCHEMA)).schema


def _rollup_part(store: SnapshotStore, silver: Part, unit: str) -> Part:
    """The rollup of one unit's valid trips, from that unit's files alone."""
    spark, path = store.spark, store.fresh("rollup", unit)
    trips = spark.createDataFrame([], SILVER_SCHEMA) if not silver.notes["valid"] else spark.read.schema(SILVER_SCHEMA).parquet(store.full(silver.path) + _VALID)
    reduced = trip_rollup(trips.select(*VALID_TRIP_COLUMNS))
    rows = overwrite(reduced, store.full(path), partition_by=MONTH_PARTITIONS)["rows"]
    months = {}
    if rows:
        written = spark.read.schema(reduced.schema).parquet(store.full(path))
        counted = written.groupBy(*MONTH_PARTITIONS).agg(F.sum("trip_count").alias("trips"))
        months = {month_name((r["pickup_year"], r["pickup_month"])): r["trips"] for r in counted.collect()}
    assert_reconciled(silver.notes["valid"], {f"rollup of {unit}": sum(months.values())})
    return Part(path, rows, {"months": months})


def load(
    store: SnapshotStore,
    *,
    trips: SourceSpec,
    zones: SourceSpec,
    batch_id: str,
    ingested_at: datetime,
    fetch: Fetch | None = None,
    by_unit: bool = True,
) -> tuple[Loaded, BronzeSummary, SilverSummary]:
    """One source unit's zones, bronze, silver and rollup in one commit; with ``by_unit`` beside the other units.

    The months it had or has valid rows in are noted for gold in the same commit; with other zones than before, so are
    all months.
    """
    spark, unit = store.spark, trips.unit
    require_utc(spark)
    for spec in (zones, trips):
        ensure_available(spark, spec, fetch=fetch)
    base = store.current()
    zone_part, zone_summary = _zones_part(store, zones)
    raw = scan_trips(spark, trips)
    path = store.fresh("bronze", unit)
    bronze = Part(path, overwrite(with_lineage(raw, batch_id=batch_id, ingested_at=ingested_at), store.full(path))["rows"])
    silver = _silver_part(store, spark.read.parquet(store.full(path)), unit)
    rollup = _rollup_part(store, silver, unit)
    others = set() if by_unit else {key for dataset in ("bronze", "silver", "rollup") for key in base.of(dataset)} - {unit}
    replaced = [base.of("silver").get(key) for key in (unit, *others)]
    months = _months_of(silver).union(*[_months_of(part) for part in replaced])
    before = base.of("zones").get("all")
    other_zones = before is not None and before.notes["mark"] != zone_part.notes["mark"]
    stale = {name for part in base.of("rollup").values() for name in part.notes["months"]} if other_zones else set()
    store.commit(
        base,
        Change(
            puts={_ZONES: zone_part, ("bronze", unit): bronze, ("silver", unit): silver, ("rollup", unit): rollup},
            drops=[(dataset, key) for dataset in ("bronze", "silver", "rollup") for key in sorted(others) if key in base.of(dataset)],
            mark={GOLD: stale.union(map(month_name, months))},
        ),
    )
    valid = silver.notes["valid"]
    return (
        zone_summary,
        BronzeSummary(trips, listed_bytes(raw), Written(store.full(bronze.path), bronze.rows), batch_id, ingested_at),
        SilverSummary(store.full(bronze.path), store.full(silver.path), valid, silver.rows - valid, tuple(sorted(months))),
    )


# ---- reading ----


def read_units(store: SnapshotStore, snapshot: Snapshot | None = None, *, valid: bool = True) -> DataFrame:
    """The valid or the invalid silver rows of all units."""
    snapshot = snapshot or store.current()
    has = (lambda part: part.notes["valid"] > 0) if valid else (lambda part: part.rows > part.notes["valid"])
    keys = [key for key, part in snapshot.of("silver").items() if has(part)]
    return store.read(snapshot, "silver", SILVER_SCHEMA, keys=keys, below=_VALID if valid else "/row_set=invalid")


def read_bronze(store: SnapshotStore, snapshot: Snapshot | None = None) -> DataFrame:
    """The raw rows of all units, in the contract's columns, with ``source_unit``."""
    schema = T.StructType([*BRONZE_SCHEMA.fields, T.StructField(PART_KEY, T.StringType())])
    return store.read(snapshot or store.current(), "bronze", schema).withColumnRenamed(PART_KEY, SOURCE_UNIT)


def read_gold_tables(store: SnapshotStore, snapshot: Snapshot | None = None, *, months: tuple[Month, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both gold tables, or their rows of some months; only those months' directories are listed."""
    snapshot = snapshot or store.current()
    keys = None if months is None else {month_name(month) for month in months}
    daily, hourly = (store.read(snapshot, dataset, schema, keys=keys) for dataset, schema in (("daily", DAILY_SCHEMA), ("hourly", HOURLY_SCHEMA)))
    return daily, hourly


# ---- compaction ----


def compact_silver(store: SnapshotStore, *, file_bytes: int = SILVER_FILE_BYTES) -> tuple[str, ...]:
    """Fewer, larger files for units with directories of many small ones; returns the units rewritten.

    A load writes a file for each task and month, so stray months and small inputs leave many. A directory is crowded
    where it has over twice the files that its bytes need at ``file_bytes``; afterwards it has no more than they need.
    Nothing is shuffled: files of a crowded directory are dealt by size, and a task reads those that become one file. Other
    directories are copied. Each unit is a commit that changes no row and so notes no month. One that is loaded anew
    meanwhile keeps its new files and is left to the next call.
    """
    if file_bytes < 1:
        raise ValueError("a file has at least a byte")
    base, done = store.current(), []
    for unit, part in sorted(base.of("silver").items()):
        files = files_below(store.spark, store.full(part.path))
        needed = {folder: -(-sum(found.values()) // file_bytes) for folder, found in files.items()}
        crowded = {folder: n for folder, n in needed.items() if len(files[folder]) > 2 * n}
        if not crowded:
            continue
        path = store.fresh("silver", unit)
        seen = {"rows": 0, "valid": 0}
        for rows in _regrouped(store, part, files, crowded):
            measures = {"valid": F.count_if(F.col("is_valid"))}
            # Nobody reads the directory before the commit, so several writes are as good as one.
            written = overwrite(rows, store.full(path), partition_by=SILVER_FOLDERS, replace="nothing", measures=measures)
            seen = {name: count + written[name] for name, count in seen.items()}
        assert_reconciled(part.rows, {f"compacted rows of {unit}": seen["rows"]})
        assert_reconciled(part.notes["valid"], {f"compacted valid rows of {unit}": seen["valid"]})
        try:
            store.commit(base, Change(puts={("silver", unit): Part(path, part.rows, part.notes)}))
        except SnapshotConflict:
            continue
        done.append(unit)
    return tuple(done)


def _dealt(sizes: dict[str, int], piles: int) -> list[list[str]]:
    """Files dealt to piles of about equal size: the largest first, each to the pile that is smallest by then."""
    smallest, dealt = [(0, 0, pile) for pile in range(piles)], [[] for _ in range(piles)]
    for name, size in sorted(sizes.items(), key=lambda found: (-found[1], found[0])):
        held, n, pile = heappop(smallest)
        dealt[pile].append(name)
        heappush(smallest, (held + size, n + 1, pile))
    return [names for names in dealt if names]


def _regrouped(store: SnapshotStore, part: Part, files: dict[str, dict[str, int]], crowded: dict[str, int]) -> Iterator[DataFrame]:
    """A unit's silver rows in frames to be written one after another, with one task for each file of crowded directories."""
    schema = T.StructType([*SILVER_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in SILVER_FOLDERS]])
    top = store.full(part.path)
    reader = store.spark.read.schema(schema).option("basePath", top)
    copied = [f"{top}/{folder}" for folder in files if folder not in crowded]
    if copied:
        yield reader.parquet(*copied)
    piles = [[f"{top}/{folder}/{name}" for name in names] for folder, n in crowded.items() for names in _dealt(files[folder], n)]
    for first in range(0, len(piles), FILES_AT_ONCE):
        yield reduce(DataFrame.unionAll, [reader.parquet(*pile).coalesce(1) for pile in piles[first : first + FILES_AT_ONCE]])


# ---- gold ----


def _by_month(store: SnapshotStore, dataset: str, path: str) -> dict[tuple[str, str], Part]:
    """The month directories of a table just written, as parts."""
    found = {}
    for year in names_below(store.spark, store.full(path)):
        for month in names_below(store.spark, f"{store.full(path)}/{year}") if year.startswith("pickup_year=") else ():
            if month.startswith("pickup_month="):
                key = month_name((int(year.partition("=")[2]), int(month.partition("=")[2])))
                found[dataset, key] = Part(f"{path}/{year}/{month}", -1)
    return found


def refresh_gold(store: SnapshotStore) -> GoldSummary:
    """Both gold tables for the months that loads have changed, swapped in one commit; other months keep their parts.

    Rollups of all units are merged; no trip is read. A month that no unit has trips in any more leaves both tables. Where
    nothing has changed nothing is written.
    """
    spark, base = store.spark, store.current()
    waiting = base.waiting(GOLD)
    zones_part = base.of("zones").get("all")
    inputs = {"silver": f"{store.root}/parts/silver", "zones": store.full(zones_part.path) if zones_part else ""}
    paths = {dataset: store.fresh(dataset, "changed") for dataset in ("daily", "hourly")}
    if not waiting:
        return GoldSummary(inputs, *[Written(store.full(p), 0) for p in paths.values()], 0, 0, (None, None))
    schema = rollup_schema(spark)
    units = [unit for unit, part in base.of("rollup").items() if set(waiting).intersection(part.notes["months"])]
    wanted = (F.col("pickup_year") * 12 + F.col("pickup_month")).isin([y * 12 + m for y, m in map(month_of, waiting)])
    rollup = store.read(base, "rollup", schema, keys=units).filter(wanted)
    zones = spark.read.parquet(store.full(zones_part.path))
    enriched = attach_zone(rollup, zones, broadcast=zones_part.notes["bytes"] <= BROADCAST_LIMIT_BYTES)
    summed = {
        "trips": F.coalesce(F.sum("trip_count"), F.lit(0)),
        "unmatched": F.coalesce(F.sum(F.when(F.col("_zone_lookup_matched"), 0).otherwise(F.col("trip_count"))), F.lit(0)),
        "first": F.min("pickup_date"),
        "last": F.max("pickup_date"),
    }
    daily = gathered(merge_daily(enriched, keep_match=True), MONTH_PARTITIONS)
    seen = overwrite(daily, store.full(paths["daily"]), partition_by=MONTH_PARTITIONS, measures=summed, drop=["_zone_lookup_matched"])
    hourly = gathered(merge_hourly(rollup), MONTH_PARTITIONS)
    hourly_seen = overwrite(hourly, store.full(paths["hourly"]), partition_by=MONTH_PARTITIONS, measures={"trips": summed["trips"]})
    assert_reconciled(_trips_in(base, waiting), {"daily gold": seen["trips"], "hourly gold": hourly_seen["trips"]})
    puts = {key: part for dataset, path in paths.items() for key, part in _by_month(store, dataset, path).items()}
    drops = [(dataset, month) for dataset in paths for month in waiting if month in base.of(dataset) and (dataset, month) not in puts]
    store.commit(base, Change(puts, drops, mark={MARTS: waiting}, clear={GOLD: waiting}), read=("rollup", "zones"))
    return GoldSummary(
        inputs,
        Written(store.full(paths["daily"]), seen["rows"]),
        Written(store.full(paths["hourly"]), hourly_seen["rows"]),
        seen["trips"],
        seen["unmatched"],
        (seen["first"], seen["last"]),
    )


def _trips_in(snapshot: Snapshot, months) -> int:
    """Valid trips of these months, as counted when each unit was loaded."""
    return sum(trips for part in snapshot.of("rollup").values() for name, trips in part.notes["months"].items() if name in months)


def publish_changes(store: SnapshotStore, mart_root: str, *, run_id: str, everything: bool = False) -> PublishSummary | None:
    """The months that gold has changed to both marts, in one version; None where there are none.

    Their staged trips have to be those counted when the units were loaded. With ``everything`` all of gold is
    published, and the dates from its first to its last replaced.
    """
    if not run_id.strip():
        raise ValueError("a run_id is required")
    base = store.current()
    waiting = base.waiting(MARTS)
    if everything:
        tables, trips, windows = read_gold_tables(store, base), _trips_in(base, base.of("daily")), None
    elif waiting:
        months = tuple(map(month_of, waiting))
        tables, trips, windows = read_gold_tables(store, base, months=months), _trips_in(base, waiting), month_windows(months)
    else:
        return None
    summary = publish_marts(store.spark, *tables, root=mart_root, run_id=run_id, windows=windows, trips=trips)
    store.commit(base, Change(clear={MARTS: waiting}), read=("daily", "hourly"))
    return summary
