"""Publish queries: marts are published to a scratch root and read back."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.contracts import DAILY_MART, HOURLY_MART
from assayer.operators.publish import (
    PublishSummary,
    publish_marts,
    read_mart,
    replace_window,
    stage_mart,
    staged_rows,
    publish_date_window,
)
from assayer.operators.quality import status_violations
from assayer.operators.run_log import compact_run_log, latest_runs, log_event, run_by_id, run_events
from assayer.operators.sinks import overwrite_gold_pair
from assayer.plans.queries.registry import Tables, comparable, query
from assayer.plans.scratch import scratch_dir
from assayer.plans.stages import run_publish

_PUBLISHED = datetime(2024, 2, 2, tzinfo=UTC)

# Second batch: the 5th to the 20th without the 10th, which therefore has to vanish from the mart.
_SECOND_BATCH = (
    "pickup_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND pickup_date <> DATE '2024-01-10'"
)
_REPEATED_DAY = date(2024, 1, 6)


def _replaced_sql(table: str, columns: str = "*") -> str:
    """Rows of the mart after the second batch, by rule of the window."""
    return (
        f"SELECT {columns}, 'run-1' AS publish_run_id FROM {table} WHERE NOT (pickup_date BETWEEN"
        f" (SELECT min(pickup_date) FROM {table} WHERE {_SECOND_BATCH}) AND"
        f" (SELECT max(pickup_date) FROM {table} WHERE {_SECOND_BATCH}))"
        f" UNION ALL SELECT {columns}, 'run-2' FROM {table} WHERE {_SECOND_BATCH}"
    )


def _gold_at(t: Tables) -> tuple[str, str]:
    paths = scratch_dir(t.spark, "gold-daily"), scratch_dir(t.spark, "gold-hourly")
    overwrite_gold_pair(t.daily, t.hourly, *paths)
    return paths


def _three_runs(t: Tables) -> tuple[str, list[PublishSummary]]:
    """Publish everything, then the second batch, then a batch with repeated keys, which has to fail."""
    root = scratch_dir(t.spark, "marts")
    daily, hourly = (t.spark.read.parquet(path) for path in _gold_at(t))
    done = [
        publish_marts(t.spark, daily, hourly, root=root, run_id="run-1"),
        publish_marts(t.spark, daily.filter(_SECOND_BATCH), hourly.filter(_SECOND_BATCH), root=root, run_id="run-2"),
    ]
    repeated = daily.unionByName(daily.filter(F.col("pickup_date") == F.lit(_REPEATED_DAY)))
    try:
        publish_marts(t.spark, repeated, hourly, root=root, run_id="run-3")
    except ValueError:
        return root, done
    raise AssertionError("a publish with repeated keys went through")


@query("stage_mart", "SELECT * EXCLUDE (pickup_year, pickup_month), 'run-1' AS publish_run_id FROM daily")
def _(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "staging")
    stage_mart(t.daily, DAILY_MART, root=root, run_id="run-1", published_at=_PUBLISHED)
    return comparable(staged_rows(t.spark, DAILY_MART, root=root, run_id="run-1").drop("published_at"))


@query("publish_window_replace", _replaced_sql("hourly", "pickup_date, pickup_hour, trip_count"))
def _(t: Tables) -> DataFrame:
    columns = ("pickup_date", "pickup_hour", "trip_count")
    current = t.hourly.select(*columns, F.lit("run-1").alias("publish_run_id"))
    staged = t.hourly.filter(_SECOND_BATCH).select(*columns, F.lit("run-2").alias("publish_run_id"))
    window = publish_date_window(t.daily.filter(_SECOND_BATCH), t.hourly.filter(_SECOND_BATCH)).first()
    return replace_window(current, staged, *window)


@query("publish_transaction", _replaced_sql("daily", "* EXCLUDE (pickup_year, pickup_month)"))
def _(t: Tables) -> DataFrame:
    root, _ = _three_runs(t)
    return comparable(read_mart(t.spark, root, DAILY_MART).drop("published_at"))


@query("publish_transaction_hourly", _replaced_sql("hourly", "* EXCLUDE (pickup_year, pickup_month)"))
def _(t: Tables) -> DataFrame:
    root, _ = _three_runs(t)
    return comparable(read_mart(t.spark, root, HOURLY_MART).drop("published_at"))


@query(
    "published_row_counts",
    "SELECT 'run-1' AS run_id, (SELECT count(*) FROM daily) AS daily_rows, (SELECT count(*) FROM hourly) AS hourly_rows"
    f" UNION ALL SELECT 'run-2', (SELECT count(*) FROM daily WHERE {_SECOND_BATCH}),"
    f" (SELECT count(*) FROM hourly WHERE {_SECOND_BATCH})",
)
def _(t: Tables) -> DataFrame:
    _, done = _three_runs(t)
    rows = [(s.run_id, s.daily_zone_row_count, s.hourly_demand_row_count) for s in done]
    return t.spark.createDataFrame(rows, "run_id string, daily_rows bigint, hourly_rows bigint")


@query(
    "audit_started",
    "SELECT unnest(['run-1', 'run-2', 'run-3']) AS run_id, 'running' AS status, false AS completed"
    " FROM (SELECT count(*) FROM daily)",
)
def _(t: Tables) -> DataFrame:
    root, _ = _three_runs(t)
    started = run_events(t.spark, root).filter("status = 'running'")
    return started.select("run_id", "status", F.col("completed_at").isNotNull().alias("completed"))


@query(
    "audit_failed",
    "SELECT 'run-3' AS run_id, 'failed' AS status, true AS completed, true AS has_message,"
    " NULL::DATE AS date_from FROM (SELECT count(*) FROM daily)",
)
def _(t: Tables) -> DataFrame:
    root, _ = _three_runs(t)
    return latest_runs(run_events(t.spark, root)).filter("status = 'failed'").select(
        "run_id",
        "status",
        F.col("completed_at").isNotNull().alias("completed"),
        F.col("error_message").contains("duplicate keys").alias("has_message"),
        "date_from",
    )


_RUN = (
    "SELECT '{run}' AS run_id, 'succeeded' AS status,"
    " (SELECT min(pickup_date) FROM daily{where}) AS date_from, (SELECT max(pickup_date) FROM daily{where}) AS date_to,"
    " (SELECT count(*) FROM daily{where}) AS daily_zone_row_count,"
    " (SELECT count(*) FROM hourly{where}) AS hourly_demand_row_count, {version}::BIGINT AS mart_version"
)
_RUN_1 = _RUN.format(run="run-1", where="", version=1)
_RUN_2 = _RUN.format(run="run-2", where=f" WHERE {_SECOND_BATCH}", version=2)
_CLOCKLESS = (
    "run_id",
    "status",
    "date_from",
    "date_to",
    "daily_zone_row_count",
    "hourly_demand_row_count",
    "mart_version",
)


@query("audit_succeeded", f"{_RUN_1} UNION ALL {_RUN_2}")
def _(t: Tables) -> DataFrame:
    root, _ = _three_runs(t)
    return latest_runs(run_events(t.spark, root)).filter("status = 'succeeded'").select(*_CLOCKLESS)


@query("filter_run", _RUN_2)
def _(t: Tables) -> DataFrame:
    root, _ = _three_runs(t)
    return run_by_id(run_events(t.spark, root), "run-2").select(*_CLOCKLESS)


@query(
    "audit_compacted",
    f"SELECT *, false AS has_message FROM ({_RUN_1} UNION ALL {_RUN_2})"
    " UNION ALL SELECT 'run-3', 'failed', NULL, NULL, NULL, NULL, NULL, true UNION ALL SELECT 'run-4', 'running', NULL, NULL, NULL, NULL, NULL, false",
)
def _(t: Tables) -> DataFrame:
    """A checkpoint of three closed runs, a run that began after it, and a checkpoint of them all."""
    root, _ = _three_runs(t)
    compact_run_log(t.spark, root)
    log_event(t.spark, root, run_id="run-4", status="running", started_at=_PUBLISHED)
    compact_run_log(t.spark, root)
    return run_events(t.spark, root).select(*_CLOCKLESS, F.col("error_message").isNotNull().alias("has_message"))


@query("publish_after_compaction", _replaced_sql("daily", "* EXCLUDE (pickup_year, pickup_month)"))
def _(t: Tables) -> DataFrame:
    """The mart, its windows told by a checkpoint alone."""
    root, _ = _three_runs(t)
    compact_run_log(t.spark, root)
    return comparable(read_mart(t.spark, root, DAILY_MART).drop("published_at"))


@query(
    "constraint_status_domain",
    "SELECT 'run_log' AS table_name, 'status_domain' AS constraint_name, count(*) AS violations FROM events"
    " WHERE event_type NOT IN ('running', 'succeeded', 'failed')",
    chain=False,
)
def _(t: Tables) -> DataFrame:
    """Event types taken as statuses: all of them lie outside of the domain."""
    events = t.spark.read.parquet(f"{t.sf_dir}/events.parquet")
    return status_violations(events.withColumnRenamed("event_type", "status"))


def _published_once(t: Tables) -> str:
    root = scratch_dir(t.spark, "marts")
    daily_path, hourly_path = _gold_at(t)
    run_publish(t.spark, daily_path=daily_path, hourly_path=hourly_path, mart_root=root, run_id="run-1")
    return root


@query("run_publish_gold", "SELECT * EXCLUDE (pickup_year, pickup_month), 'run-1' AS publish_run_id FROM daily")
def _(t: Tables) -> DataFrame:
    return comparable(read_mart(t.spark, _published_once(t), DAILY_MART).drop("published_at"))


@query("run_publish", "SELECT * EXCLUDE (pickup_year, pickup_month), 'run-1' AS publish_run_id FROM hourly")
def _(t: Tables) -> DataFrame:
    return comparable(read_mart(t.spark, _published_once(t), HOURLY_MART).drop("published_at"))


@query(
    "run_publish_months",
    "SELECT * EXCLUDE (pickup_year, pickup_month), 'run-2' AS publish_run_id FROM hourly",
)
def _(t: Tables) -> DataFrame:
    """Doubled marts first, then the month again with its true rows: every date comes from the second run."""
    root = scratch_dir(t.spark, "marts")
    daily_path, hourly_path = _gold_at(t)
    doubled = [df.withColumn("trip_count", F.col("trip_count") * 2) for df in (t.daily, t.hourly)]
    publish_marts(t.spark, *doubled, root=root, run_id="run-1")
    run_publish(t.spark, daily_path=daily_path, hourly_path=hourly_path, mart_root=root, run_id="run-2", months=[(2024, 1)])
    return comparable(read_mart(t.spark, root, HOURLY_MART).drop("published_at"))


@query("publish_fixed_window", "SELECT pickup_date, trip_count FROM daily WHERE NOT pickup_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'")
def _(t: Tables) -> DataFrame:
    """A window given with no rows for it is emptied; nothing else changes."""
    root = scratch_dir(t.spark, "marts")
    publish_marts(t.spark, t.daily, t.hourly, root=root, run_id="run-1")
    window = (date(2024, 1, 10), date(2024, 1, 12))
    publish_marts(t.spark, t.daily.limit(0), t.hourly.limit(0), root=root, run_id="run-2", window=window)
    return read_mart(t.spark, root, DAILY_MART).select("pickup_date", "trip_count")


_TWO_WINDOWS = ((date(2024, 1, 5), date(2024, 1, 7)), (date(2024, 1, 20), date(2024, 1, 22)))
_IN_WINDOWS = "(pickup_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-07' OR pickup_date BETWEEN DATE '2024-01-20' AND DATE '2024-01-22')"


@query(
    "publish_two_windows",
    f"SELECT pickup_date, pickup_hour, trip_count, 'run-1' AS publish_run_id FROM hourly WHERE NOT {_IN_WINDOWS}"
    f" UNION ALL SELECT pickup_date, pickup_hour, 2 * trip_count, 'run-2' FROM hourly WHERE {_IN_WINDOWS} AND pickup_date <> DATE '2024-01-06'",
)
def _(t: Tables) -> DataFrame:
    """One publish replaces two windows and leaves the days between them; a day of a window without rows is emptied."""
    root = scratch_dir(t.spark, "marts")
    publish_marts(t.spark, t.daily, t.hourly, root=root, run_id="run-1")
    staged = [df.filter(f"{_IN_WINDOWS} AND pickup_date <> DATE '2024-01-06'").withColumn("trip_count", F.col("trip_count") * 2) for df in (t.daily, t.hourly)]
    publish_marts(t.spark, *staged, root=root, run_id="run-2", windows=_TWO_WINDOWS)
    return read_mart(t.spark, root, HOURLY_MART).select("pickup_date", "pickup_hour", "trip_count", "publish_run_id")


@query(
    "reconcile_in_publish",
    "SELECT 'run-1' AS run_id, 'succeeded' AS status, NULL AS error_message, count(*) AS hourly_trips FROM valid"
    " UNION ALL SELECT 'run-2', 'failed', concat('hourly_demand_metrics covers ', count(*) - 1, ' trips, expected ', count(*)), count(*) - 1 FROM valid",
)
def _(t: Tables) -> DataFrame:
    """A publish whose trips are all there, and one whose hourly table has one trip too few."""
    root = scratch_dir(t.spark, "marts")
    trips = t.valid.count()
    publish_marts(t.spark, t.daily, t.hourly, root=root, run_id="run-1", trips=trips)
    busiest = t.hourly.orderBy(F.desc("trip_count"), "pickup_date", "pickup_hour").first()
    one = (F.col("pickup_date") == F.lit(busiest["pickup_date"])) & (F.col("pickup_hour") == busiest["pickup_hour"])
    fewer = t.hourly.withColumn("trip_count", F.col("trip_count") - F.when(one, 1).otherwise(0))
    try:
        publish_marts(t.spark, t.daily, fewer, root=root, run_id="run-2", trips=trips)
    except ValueError:
        runs = latest_runs(run_events(t.spark, root)).select("run_id", "status", "error_message")
        staged = [staged_rows(t.spark, HOURLY_MART, root=root, run_id=run) for run in ("run-1", "run-2")]
        totals = staged[0].unionByName(staged[1]).groupBy("publish_run_id").agg(F.sum("trip_count").alias("hourly_trips"))
        return runs.join(totals, F.col("run_id") == F.col("publish_run_id")).drop("publish_run_id")
    raise AssertionError("a publish with a trip too few went through")
