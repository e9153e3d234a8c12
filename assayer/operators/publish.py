"""Publishing both marts together by date-window replacement, with a run log.

Layout below the mart root::

    mart/<table>/publish_dir=<run>/pickup_date=<day>    rows one run published, never changed once written
    versions/<n>                                        an empty file: version n is taken
    run_log, run_log_states                             events and their checkpoints, see :mod:`.run_log`

The run log is the manifest. Every ``succeeded`` event holds its run's windows and version; a date belongs to the newest
version one of whose windows covers it. A publish therefore writes the rows of its own windows and nothing else. Its event
is a single one-row file, so its appearance is the commit: until then readers see the former version of both tables, from
then on the new one of both. Of two publishers that started from the same version only one can take the next one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import UTC, date, datetime, timedelta
from functools import reduce
from operator import or_
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.contracts import (
    DAILY_MART,
    DAILY_SCHEMA,
    ERROR_TEXT_LIMIT,
    HOURLY_MART,
    HOURLY_SCHEMA,
    MartTable,
    require_columns,
)
from assayer.operators.projections import project_for_mart, stamp_publish
from assayer.operators.quality import (
    MartReport,
    assert_constraints,
    assert_non_empty,
    assert_reconciled,
    assert_unique_mart_keys,
    assert_window_complete,
    mart_report,
    overflow_counts,
)
from assayer.operators.run_log import COMPACT_AFTER, compact_run_log, current_version, latest_runs, log_event, run_events
from assayer.operators.sinks import gathered, overwrite
from assayer.sources.storage import claim, remove

MARTS = (DAILY_MART, HOURLY_MART)
_GOLD = {DAILY_MART.name: DAILY_SCHEMA, HOURLY_MART.name: HOURLY_SCHEMA}

Window = tuple[date, date]

def merged_windows(windows: Sequence[Window]) -> tuple[Window, ...]:
    """The same dates as few windows by date, none touching another."""
    day, merged = timedelta(days=1), []
    for first, last in sorted(windows):
        if first > last:
            raise ValueError(f"a window ends before it starts: {first}..{last}")
        if merged and first <= merged[-1][1] + day:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return tuple(merged)


@dataclass(frozen=True)
class PublishSummary:
    run_id: str
    date_from: date
    date_to: date
    daily_zone_row_count: int
    hourly_demand_row_count: int
    mart_version: int
    #: What the run replaced; from ``date_from`` to ``date_to`` with gaps that it left alone.
    windows: tuple[Window, ...] = ()

    def metrics(self) -> dict:
        tables = {"daily_table": DAILY_MART.name, "hourly_table": HOURLY_MART.name, "log_table": "run_log"}
        told = {name: value for name, value in asdict(self).items() if name != "windows"}
        if len(self.windows) > 1:
            told["windows"] = ",".join(f"{first}..{last}" for first, last in self.windows)
        return {**told, **tables}


def _run_dir(run_id: str) -> str:
    return f"run-{quote(run_id, safe='').replace('%', '=')}"


def run_path(root: str, table: MartTable, run_id: str) -> str:
    """Where a run's rows of a mart lie, from staging on."""
    return f"{root}/mart/{table.name}/publish_dir={_run_dir(run_id)}"


def mart_schema(table: MartTable) -> T.StructType:
    """A mart's columns in order, with the stamps and the directory column."""
    kinds = {f.name: f.dataType for f in _GOLD[table.name]} | dict.fromkeys(table.money, T.DecimalType(20, 2))
    stamps = {"publish_run_id": T.StringType(), "published_at": T.TimestampType(), "publish_dir": T.StringType()}
    return T.StructType([T.StructField(c, kind) for c, kind in {**{c: kinds[c] for c in table.columns}, **stamps}.items()])


# ---- run log ----------------------------------------------------------------------------------------------


def log_started(spark: SparkSession, root: str, *, run_id: str, started_at: datetime) -> None:
    log_event(spark, root, run_id=run_id, status="running", started_at=started_at)


def log_failed(spark: SparkSession, root: str, *, run_id: str, started_at: datetime, error: BaseException) -> None:
    log_event(
        spark,
        root,
        run_id=run_id,
        status="failed",
        started_at=started_at,
        completed_at=datetime.now(UTC),
        error_message=str(error)[:ERROR_TEXT_LIMIT],
    )


def log_succeeded(spark: SparkSession, root: str, *, summary: PublishSummary, started_at: datetime) -> None:
    log_event(
        spark,
        root,
        run_id=summary.run_id,
        status="succeeded",
        started_at=started_at,
        completed_at=datetime.now(UTC),
        date_from=summary.date_from,
        date_to=summary.date_to,
        daily_zone_row_count=summary.daily_zone_row_count,
        hourly_demand_row_count=summary.hourly_demand_row_count,
        mart_version=summary.mart_version,
        windows=summary.windows,
    )


@dataclass(frozen=True)
class Segment:
    """Dates, both ends included, whose rows come from one run."""

    run_id: str
    date_from: date
    date_to: date


def overlaid(windows: Sequence[Segment]) -> list[Segment]:
    """What is left of each window, oldest first, after all later ones: segments that do not overlap, by date."""
    day, left = timedelta(days=1), []
    for new in windows:
        cut = []
        for old in left:
            if old.date_from < new.date_from:
                cut.append(Segment(old.run_id, old.date_from, min(old.date_to, new.date_from - day)))
            if old.date_to > new.date_to:
                cut.append(Segment(old.run_id, max(old.date_from, new.date_to + day), old.date_to))
        left = [*cut, new]
    return sorted(left, key=lambda s: s.date_from)


def published_windows(spark: SparkSession, root: str) -> list[list[Segment]]:
    """The windows of each successful publish, oldest first: one small row of the log for each."""
    done = run_events(spark, root).filter("status = 'succeeded'").orderBy("mart_version")
    found = []
    for r in done.select("run_id", "date_from", "date_to", "windows").collect():
        windows = [(w["date_from"], w["date_to"]) for w in r["windows"] or ()] or [(r["date_from"], r["date_to"])]
        found.append([Segment(r["run_id"], *window) for window in windows])
    return found


def _segments(published: Sequence[Sequence[Segment]]) -> list[Segment]:
    return overlaid([segment for windows in published for segment in windows])


def read_mart(spark: SparkSession, root: str, table: MartTable, *, version: int | None = None) -> DataFrame:
    """The current version of a mart, or an earlier one that is still there."""
    published = published_windows(spark, root)
    if not published or version is not None and not 1 <= version <= len(published):
        raise FileNotFoundError(f"nothing has been published to {root}")
    segments = _segments(published[:version])
    paths = sorted({run_path(root, table, s.run_id) for s in segments})
    reader = spark.read.schema(mart_schema(table)).option("basePath", f"{root}/mart/{table.name}")
    # Conditions on the directory columns, so that Spark reads no other files.
    wanted = [
        (F.col("publish_dir") == _run_dir(s.run_id)) & F.col("pickup_date").between(F.lit(s.date_from), F.lit(s.date_to)) for s in segments
    ]
    rows = reader.parquet(*paths).filter(reduce(or_, wanted))
    return rows.select(*table.columns, "publish_run_id", "published_at")


def vacuum(spark: SparkSession, root: str, *, keep: int = 1) -> list[str]:
    """Delete the rows of closed runs that none of the newest ``keep`` versions reads; returns the run ids."""
    if keep < 1:
        raise ValueError("at least the current version has to be kept")
    published = published_windows(spark, root)
    used = {s.run_id for n in range(max(1, len(published) - keep + 1), len(published) + 1) for s in _segments(published[:n])}
    closed = [r["run_id"] for r in latest_runs(run_events(spark, root)).filter("status <> 'running'").select("run_id").collect()]
    return sorted(run for run in closed if run not in used and any([remove(spark, run_path(root, table, run)) for table in MARTS]))


def release_version(spark: SparkSession, root: str, version: int) -> bool:
    """Free a version that a publisher took and died with. Refused once it is published."""
    newest = current_version(spark, root)
    if newest is not None and version <= newest[0]:
        raise ValueError(f"version {version} is published")
    return remove(spark, _claim_path(root, version))


def _claim_path(root: str, version: int) -> str:
    return f"{root}/versions/{version}"


# ---- staging and replacement ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Staged:
    """What was observed while a mart's rows were staged."""

    rows: int
    trips: int
    #: Rows whose date no window of the publish covers.
    outside: int


def stage_counted(
    gold: DataFrame, table: MartTable, *, root: str, run_id: str, published_at: datetime, windows: Sequence[Window] = ()
) -> Staged:
    """Write the mart rows of one run, by date, from all executors. Readers do not see them yet.

    Rows, trips and rows outside of ``windows`` are counted in the write itself. Amounts are held to the mart's money
    type; those that do not fit are counted there too and fail the run.
    """
    rows = stamp_publish(project_for_mart(gold, table), run_id=run_id, published_at=published_at)
    covered = [F.col("pickup_date").between(F.lit(first), F.lit(last)) for first, last in windows]
    counted = {
        "trips": F.coalesce(F.sum("trip_count"), F.lit(0)),
        "outside": F.count_if(~reduce(or_, covered)) if covered else F.count_if(F.lit(False)),
    }
    seen = overwrite(
        gathered(rows, ["pickup_date"]),
        run_path(root, table, run_id),
        partition_by=["pickup_date"],
        measures={**overflow_counts(table), **counted},
        convert={c: F.col(c).try_cast(table.money_type) for c in table.money},
    )
    assert_constraints(table.name, {name: seen[name] for name in overflow_counts(table)})
    return Staged(seen["rows"], seen["trips"], seen["outside"])


def stage_mart(gold: DataFrame, table: MartTable, *, root: str, run_id: str, published_at: datetime) -> int:
    """:func:`stage_counted` for the row count alone."""
    return stage_counted(gold, table, root=root, run_id=run_id, published_at=published_at).rows


def staged_rows(spark: SparkSession, table: MartTable, *, root: str, run_id: str) -> DataFrame:
    """The rows a run has staged."""
    reader = spark.read.schema(mart_schema(table)).option("basePath", f"{root}/mart/{table.name}")
    return reader.parquet(run_path(root, table, run_id)).select(*table.columns, "publish_run_id", "published_at")


def publish_dates(daily: DataFrame, hourly: DataFrame) -> DataFrame:
    """The pickup dates of both tables, repeats kept."""
    return daily.select("pickup_date").unionAll(hourly.select("pickup_date"))


def publish_date_window(daily: DataFrame, hourly: DataFrame) -> DataFrame:
    """One row: first and last date over both tables."""
    return publish_dates(daily, hourly).agg(
        F.min("pickup_date").alias("date_from"), F.max("pickup_date").alias("date_to")
    )


def in_window(df: DataFrame, date_from: date, date_to: date) -> DataFrame:
    """Rows whose pickup date lies in the window, both ends included."""
    return df.filter(F.col("pickup_date").between(F.lit(date_from), F.lit(date_to)))


def replace_window(current: DataFrame, staged: DataFrame, date_from: date, date_to: date) -> DataFrame:
    """``current`` without the window, plus all of ``staged``.

    Dates inside the window that ``staged`` lacks disappear: the window is replaced as a whole.
    """
    kept = current.filter(~F.col("pickup_date").between(F.lit(date_from), F.lit(date_to)))
    return kept.unionByName(staged)


def _checked_windows(reports: Sequence[MartReport], staged: dict[str, Staged], wanted: Sequence[Window]) -> tuple[Window, ...]:
    if not wanted:
        return (assert_window_complete(*reports),)
    outside = {name: seen.outside for name, seen in staged.items() if seen.outside}
    if outside:
        told = ", ".join(f"{first}..{last}" for first, last in wanted)
        raise ValueError(f"staged rows leave the window {told}: {outside}")
    return merged_windows(wanted)


def publish_marts(
    spark: SparkSession,
    daily: DataFrame,
    hourly: DataFrame,
    *,
    root: str,
    run_id: str,
    window: Window | None = None,
    windows: Sequence[Window] | None = None,
    trips: int | None = None,
) -> PublishSummary:
    """Publish both marts, or neither.

    Without ``window`` and ``windows`` every date from the first to the last staged one is replaced, so a single stray
    date widens the range. Pass one or several to fix what is replaced, all in one version: staged dates outside of them
    then fail the publish, dates between them are left alone, and a window both tables have no rows for is emptied.

    With ``trips`` the trips of each staged table, counted while it is written, have to add up to as many. On an error
    the run is logged as failed and the error is raised again.
    """
    if window is not None and windows is not None:
        raise ValueError("give a window or windows")
    wanted = merged_windows([window] if window is not None else windows or ())
    gold = {DAILY_MART: daily, HOURLY_MART: hourly}
    for table, df in gold.items():
        require_columns(df, table.columns, table.name)
    if not run_events(spark, root).filter(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run {run_id} is already in the run log")
    # Before anything is published, as an error here has to fail the publish.
    compact_run_log(spark, root, least=COMPACT_AFTER)
    started_at = datetime.now(UTC)
    log_started(spark, root, run_id=run_id, started_at=started_at)
    taken = None
    try:
        base = current_version(spark, root)
        staged = {
            table.name: stage_counted(df, table, root=root, run_id=run_id, published_at=started_at, windows=wanted)
            for table, df in gold.items()
        }
        counts = {name: seen.rows for name, seen in staged.items()}
        if not wanted or any(counts.values()):
            assert_non_empty(counts)
        reports = [mart_report(staged_rows(spark, table, root=root, run_id=run_id), table) for table in gold]
        assert_unique_mart_keys(*reports)
        for report in reports:
            assert_constraints(report.table, report.violations)
        replaced = _checked_windows(reports, staged, wanted)
        if trips is not None:
            assert_reconciled(trips, {name: seen.trips for name, seen in staged.items()})
        summary = PublishSummary(
            run_id=run_id,
            date_from=replaced[0][0],
            date_to=replaced[-1][1],
            daily_zone_row_count=counts[DAILY_MART.name],
            hourly_demand_row_count=counts[HOURLY_MART.name],
            mart_version=1 + (base[0] if base else 0),
            windows=replaced,
        )
        path = _claim_path(root, summary.mart_version)
        if not claim(spark, path):
            raise RuntimeError(f"another run took version {summary.mart_version} of these marts meanwhile; see release_version")
        taken = path
        log_succeeded(spark, root, summary=summary, started_at=started_at)
        return summary
    except Exception as error:
        if taken is not None and any(s.run_id == run_id for windows in published_windows(spark, root) for s in windows):
            # Its event is there, so the run is published, whatever went wrong after that. A second closing event would contradict it.
            raise
        if taken is not None:
            remove(spark, taken)
        log_failed(spark, root, run_id=run_id, started_at=started_at, error=error)
        raise
