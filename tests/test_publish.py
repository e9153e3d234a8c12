from __future__ import annotations

from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayer.contracts import DAILY_MART, DAILY_SCHEMA, HOURLY_MART, HOURLY_SCHEMA, RUN_LOG_SCHEMA
from assayer.operators import publish as module
from assayer.operators import run_log
from assayer.operators.publish import (
    publish_date_window,
    publish_dates,
    publish_marts,
    read_mart,
    replace_window,
    overlaid,
    run_path,
    stage_mart,
    staged_rows,
    vacuum,
    Segment,
)
from assayer.operators.run_log import compact_run_log, current_version, latest_runs, log_event, run_by_id, run_events
from assayer.sources.storage import create_text, names_below

AT = datetime(2024, 2, 1, tzinfo=UTC)


def _gold(spark, *days, trips=1, tip="1.00"):
    """Gold tables with one zone and one hour per given day of January."""
    money = (Decimal("10.00"), Decimal("8.00"), Decimal(tip))
    tail = (1.0, 0.0, 1, AT)
    dates = [date(2024, 1, 1) + timedelta(days=d - 1) for d in days]
    daily = [(d, d.year, d.month, 236, "B", "Z", "S", trips, *money, 1.0, 2.0, 3.0, *tail) for d in dates]
    hourly = [(d, d.year, d.month, 8, trips, 1, *money, 1.0, 2.0, *tail) for d in dates]
    return spark.createDataFrame(daily, DAILY_SCHEMA), spark.createDataFrame(hourly, HOURLY_SCHEMA)


def _mart(spark, root, table=DAILY_MART):
    rows = read_mart(spark, root, table).collect()
    return {(r["pickup_date"].month, r["pickup_date"].day): (r["trip_count"], r["publish_run_id"]) for r in rows}


def _log(spark, root):
    return {r["run_id"]: r for r in latest_runs(run_events(spark, root)).collect()}


def test_first_publish(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        read_mart(spark, root, DAILY_MART)
    summary = publish_marts(spark, *_gold(spark, 1, 2), root=root, run_id="r1")
    assert (summary.date_from, summary.date_to) == (date(2024, 1, 1), date(2024, 1, 2))
    assert (summary.daily_zone_row_count, summary.hourly_demand_row_count, summary.mart_version) == (2, 2, 1)
    daily, hourly = read_mart(spark, root, DAILY_MART), read_mart(spark, root, HOURLY_MART)
    assert daily.columns == [*DAILY_MART.columns, "publish_run_id", "published_at"]
    assert hourly.columns == [*HOURLY_MART.columns, "publish_run_id", "published_at"]
    assert dict(daily.dtypes)["gross_revenue_amount"] == "decimal(20,2)"
    stamps = {r["published_at"] for df in (daily, hourly) for r in df.collect()}
    assert len(stamps) == 1
    row = _log(spark, root)["r1"]
    assert (row["status"], row["daily_zone_row_count"], row["error_message"]) == ("succeeded", 2, None)
    assert row["completed_at"] >= row["started_at"]


def test_window_is_replaced_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    publish_marts(spark, *_gold(spark, 1, 2, 3, 4), root=root, run_id="r1")
    publish_marts(spark, *_gold(spark, 1, 3, trips=9), root=root, run_id="r2")
    for table in (DAILY_MART, HOURLY_MART):
        assert _mart(spark, root, table) == {(1, 1): (9, "r2"), (1, 3): (9, "r2"), (1, 4): (1, "r1")}


def test_stray_date_widens_the_window_unless_it_is_given(spark, tmp_path):
    root = str(tmp_path)
    publish_marts(spark, *_gold(spark, 1, 10, 20, 30), root=root, run_id="r1")
    with pytest.raises(ValueError, match="leave the window"):
        publish_marts(spark, *_gold(spark, 1, 30), root=root, run_id="r2", window=(date(2024, 1, 1), date(2024, 1, 5)))
    assert len(_mart(spark, root)) == 4
    publish_marts(spark, *_gold(spark, 10, trips=2), root=root, run_id="r3", window=(date(2024, 1, 10), date(2024, 1, 25)))
    assert _mart(spark, root) == {(1, 1): (1, "r1"), (1, 10): (2, "r3"), (1, 30): (1, "r1")}
    publish_marts(spark, *_gold(spark, 1, 30, trips=5), root=root, run_id="r4")
    assert _mart(spark, root) == {(1, 1): (5, "r4"), (1, 30): (5, "r4")}


def test_window_spans_both_tables(spark, tmp_path):
    root = str(tmp_path)
    publish_marts(spark, *_gold(spark, 1, 2, 3, 4), root=root, run_id="r1")
    daily, _ = _gold(spark, 2, trips=7)
    _, hourly = _gold(spark, 3, trips=7)
    summary = publish_marts(spark, daily, hourly, root=root, run_id="r2")
    assert (summary.date_from.day, summary.date_to.day) == (2, 3)
    assert set(_mart(spark, root)) == {(1, 1), (1, 2), (1, 4)}
    assert set(_mart(spark, root, HOURLY_MART)) == {(1, 1), (1, 3), (1, 4)}


def _spoilt(spark, what):
    daily, hourly = _gold(spark, 1, 2, trips=9)
    if what == "duplicate":
        return daily.unionByName(daily), hourly
    if what == "empty":
        return daily, hourly.limit(0)
    if what == "check":
        return daily, hourly.withColumn("pickup_hour", F.lit(24) + F.dayofmonth("pickup_date"))
    if what == "null":
        return daily.withColumn("pickup_zone", F.lit(None).cast("string")), hourly
    if what == "overflow":
        return daily.withColumn("total_tip_amount", F.lit("1234567890123456789").cast("decimal(22,2)")), hourly
    return daily.withColumn("pickup_date", F.lit(None).cast("date")).limit(1), hourly


@pytest.mark.parametrize(
    ("what", "message"),
    [
        ("duplicate", "duplicate keys"),
        ("empty", "at least one row"),
        ("check", "pickup_hour_range"),
        ("null", "pickup_zone_not_null"),
        ("overflow", "total_tip_amount_fits"),
        ("null_date", "pickup_date_not_null"),
    ],
)
def test_failed_publish_changes_nothing(spark, tmp_path, what, message):
    root = str(tmp_path)
    publish_marts(spark, *_gold(spark, 1, 2), root=root, run_id="good")
    before = _mart(spark, root), _mart(spark, root, HOURLY_MART)
    with pytest.raises(ValueError, match=message):
        publish_marts(spark, *_spoilt(spark, what), root=root, run_id="bad")
    assert (_mart(spark, root), _mart(spark, root, HOURLY_MART)) == before
    row = _log(spark, root)["bad"]
    assert row["status"] == "failed" and message in row["error_message"] and row["completed_at"] is not None
    assert current_version(spark, root) == (1, "good")


def test_failure_between_the_two_tables_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish_marts(spark, *_gold(spark, 1), root=root, run_id="r1")
    real, broken = module.overwrite, run_path(root, HOURLY_MART, "r2")

    def write(df, path, **options):
        if path == broken:
            raise OSError("disk " + "x" * 3000)
        return real(df, path, **options)

    monkeypatch.setattr(module, "overwrite", write)
    with pytest.raises(OSError):
        publish_marts(spark, *_gold(spark, 1, trips=9), root=root, run_id="r2")
    assert _mart(spark, root) == {(1, 1): (1, "r1")}
    assert len(_log(spark, root)["r2"]["error_message"]) == 2000


def test_of_two_racing_publishers_one_wins(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish_marts(spark, *_gold(spark, 1), root=root, run_id="r1")
    real = module.current_version
    # The second starts from the version before the first has published.
    monkeypatch.setattr(module, "current_version", lambda *a: (1, "r1"))
    publish_marts(spark, *_gold(spark, 1, trips=5), root=root, run_id="r2")
    with pytest.raises(RuntimeError, match="took version 2"):
        publish_marts(spark, *_gold(spark, 1, trips=9), root=root, run_id="r3")
    monkeypatch.setattr(module, "current_version", real)
    assert _mart(spark, root) == {(1, 1): (5, "r2")}
    assert _log(spark, root)["r3"]["status"] == "failed"
    publish_marts(spark, *_gold(spark, 1, trips=7), root=root, run_id="r4")
    assert current_version(spark, root) == (3, "r4")


def test_a_version_taken_by_a_dead_run_can_be_freed(spark, tmp_path):
    root = str(tmp_path)
    publish_marts(spark, *_gold(spark, 1), root=root, run_id="r1")
    module.claim(spark, f"{root}/versions/2")
    with pytest.raises(RuntimeError, match="release_version"):
        publish_marts(spark, *_gold(spark, 1), root=root, run_id="r2")
    with pytest.raises(ValueError, match="is published"):
        module.release_version(spark, root, 1)
    assert module.release_version(spark, root, 2)
    publish_marts(spark, *_gold(spark, 1), root=root, run_id="r3")


def test_a_publish_writes_its_window_only_and_vacuum_the_rest(spark, tmp_path):
    root = str(tmp_path)
    publish_marts(spark, *_gold(spark, *range(1, 31)), root=root, run_id="r1")
    publish_marts(spark, *_gold(spark, 7, trips=9), root=root, run_id="r2")
    days = lambda run: sorted(p.name for p in (tmp_path / "mart" / DAILY_MART.name / f"publish_dir=run-{run}").glob("pickup_date=*"))
    assert days("r2") == ["pickup_date=2024-01-07"] and len(days("r1")) == 30
    assert len(_mart(spark, root)) == 30 and _mart(spark, root)[1, 7] == (9, "r2")
    old = read_mart(spark, root, DAILY_MART, version=1)
    assert {r["trip_count"] for r in old.collect()} == {1}
    files = read_mart(spark, root, DAILY_MART).filter("pickup_date = DATE '2024-01-07'")
    assert files.count() == 1
    publish_marts(spark, *_gold(spark, *range(1, 31), trips=3), root=root, run_id="r3")
    assert vacuum(spark, root, keep=3) == []
    assert vacuum(spark, root) == ["r1", "r2"]
    assert {v for v, _ in _mart(spark, root).values()} == {3}


def test_overlaid_windows():
    day = lambda n: date(2024, 1, n)
    segments = overlaid([Segment("a", day(1), day(20)), Segment("b", day(5), day(8)), Segment("c", day(8), day(25)), Segment("d", day(2), day(2))])
    assert [(s.run_id, s.date_from.day, s.date_to.day) for s in segments] == [("a", 1, 1), ("d", 2, 2), ("a", 3, 4), ("b", 5, 7), ("c", 8, 25)]


def test_run_ids(spark, tmp_path):
    root = str(tmp_path)
    odd = "run 1/../=%"
    publish_marts(spark, *_gold(spark, 1), root=root, run_id=odd)
    assert _mart(spark, root) == {(1, 1): (1, odd)}
    with pytest.raises(ValueError, match="already"):
        publish_marts(spark, *_gold(spark, 1), root=root, run_id=odd)
    assert [r["status"] for r in run_by_id(run_events(spark, root), odd).collect()] == ["succeeded"]


def test_missing_columns_fail_before_anything_is_logged(spark, tmp_path):
    daily, hourly = _gold(spark, 1)
    with pytest.raises(ValueError, match=r"\['trip_count'\]"):
        publish_marts(spark, daily, hourly.drop("trip_count"), root=str(tmp_path), run_id="r")
    assert run_events(spark, str(tmp_path)).count() == 0


def test_staging_writes_the_projection(spark, tmp_path):
    daily, _ = _gold(spark, 1, 2)
    assert stage_mart(daily, DAILY_MART, root=str(tmp_path), run_id="r", published_at=AT) == 2
    staged = staged_rows(spark, DAILY_MART, root=str(tmp_path), run_id="r")
    assert "pickup_year" not in staged.columns and staged.columns[-2:] == ["publish_run_id", "published_at"]


def test_date_frames_and_replacement(spark):
    daily, _ = _gold(spark, 1, 3)
    _, hourly = _gold(spark, 2, 3)
    assert publish_dates(daily, hourly).count() == 4
    assert tuple(publish_date_window(daily, hourly).first()) == (date(2024, 1, 1), date(2024, 1, 3))
    replaced = replace_window(_gold(spark, 1, 2, 3, 4)[0], daily.filter("pickup_date = DATE '2024-01-03'"), date(2024, 1, 2), date(2024, 1, 3))
    assert sorted(r["pickup_date"].day for r in replaced.collect()) == [1, 3, 4]


def _run(number, status="succeeded"):
    at = AT + timedelta(minutes=number)
    return {"run_id": f"run-{number:03}", "status": status, "started_at": at} | (
        {"mart_version": number, "date_from": date(2024, 1, 1), "date_to": date(2024, 1, 2)} if status == "succeeded" else {}
    )


def test_an_event_comes_back_as_it_was_logged(spark, tmp_path):
    root, windows = str(tmp_path), ((date(2002, 12, 1), date(2002, 12, 31)), (date(2024, 1, 1), date(2024, 1, 31)))
    at = datetime(2024, 2, 1, 6, 30, 1, 234567, tzinfo=UTC)
    text = 'line one\nline "two" \u00e9 \U0001f4be'
    log_event(spark, root, run_id="a/b c", status="failed", started_at=at, error_message=text, windows=windows)
    row = run_events(spark, root).withColumn("micros", F.unix_micros("started_at")).first()
    assert (row["run_id"], row["status"], row["error_message"], row["completed_at"], row["mart_version"]) == ("a/b c", "failed", text, None, None)
    assert row["micros"] == int(at.timestamp()) * 1_000_000 + 234567
    assert tuple(tuple(w) for w in row["windows"]) == windows
    with pytest.raises(ValueError, match="no columns"):
        log_event(spark, root, run_id="x", stauts="running")


def test_a_long_log_is_read_as_one_checkpoint_and_a_short_tail(spark, tmp_path):
    """A thousand events: the states before and after are the same, and so is what a publish makes of them."""
    root = str(tmp_path)
    for number in range(1, 501):
        log_event(spark, root, run_id=f"run-{number:03}", status="running", started_at=AT)
        log_event(spark, root, **_run(number, "failed" if number % 10 == 0 else "succeeded"))
    before = {tuple(r) for r in latest_runs(run_events(spark, root)).collect()}
    assert len(before) == 500 and current_version(spark, root) == (499, "run-499")
    assert compact_run_log(spark, root) and not compact_run_log(spark, root)
    log_event(spark, root, run_id="open", status="running", started_at=AT)
    assert len(run_events(spark, root).inputFiles()) <= 3 and run_events(spark, root).count() == 501
    assert {tuple(r) for r in latest_runs(run_events(spark, root)).filter("run_id <> 'open'").collect()} == before
    assert current_version(spark, root) == (499, "run-499")
    # The next checkpoint closes the open run, and deletes what the first one stood for.
    log_event(spark, root, run_id="open", status="failed", started_at=AT, error_message="late")
    assert compact_run_log(spark, root)
    assert _log(spark, root)["open"]["error_message"] == "late"
    assert len([n for n in names_below(spark, f"{root}/run_log") if not n.startswith(".")]) == 2
    assert run_events(spark, root).count() == 501


def test_windows_and_versions_survive_checkpoints(spark, tmp_path, monkeypatch):
    """With a checkpoint before each publish every version reads as without one, windows with gaps too."""
    monkeypatch.setattr(module, "COMPACT_AFTER", 1)
    root, day = str(tmp_path), lambda d: date(2024, 1, d)
    publish_marts(spark, *_gold(spark, 1, 2, 3, 4, 5), root=root, run_id="r1")
    publish_marts(spark, *_gold(spark, 1, 5, trips=7), root=root, run_id="r2", windows=((day(1), day(1)), (day(4), day(5))))
    with pytest.raises(ValueError):
        publish_marts(spark, *_spoilt(spark, "repeated keys"), root=root, run_id="r3")
    publish_marts(spark, *_gold(spark, 3, trips=9), root=root, run_id="r4")
    assert _mart(spark, root) == {(1, 1): (7, "r2"), (1, 2): (1, "r1"), (1, 3): (9, "r4"), (1, 5): (7, "r2")}
    assert {r["trip_count"] for r in read_mart(spark, root, DAILY_MART, version=1).collect()} == {1}
    assert {run: row["status"] for run, row in _log(spark, root).items()} == {"r1": "succeeded", "r2": "succeeded", "r3": "failed", "r4": "succeeded"}
    with pytest.raises(ValueError, match="already"):
        publish_marts(spark, *_gold(spark, 1), root=root, run_id="r1")


def test_of_two_compactions_one_is_written_and_a_dead_one_changes_nothing(spark, tmp_path, monkeypatch):
    root, other = str(tmp_path / "one"), str(tmp_path / "other")
    for log in (root, other):
        log_event(spark, log, **_run(1))
    real = run_log.create_text

    def slower(spark, path, text):
        assert create_text(spark, path, text)
        return real(spark, path, text)

    monkeypatch.setattr(run_log, "create_text", slower)
    assert not compact_run_log(spark, root)
    monkeypatch.setattr(run_log, "create_text", lambda *_: (_ for _ in ()).throw(OSError("died here")))
    with pytest.raises(OSError, match="died here"):
        compact_run_log(spark, other)
    monkeypatch.undo()
    assert [r["run_id"] for r in run_events(spark, other).collect()] == ["run-001"] and compact_run_log(spark, other)


def test_logs_of_parquet_events_are_read_and_compacted(spark, tmp_path):
    root = str(tmp_path)
    old = {"run_id": "old", "status": "succeeded", "started_at": AT, "mart_version": 1, "date_from": date(2024, 1, 1), "date_to": date(2024, 1, 1)}
    spark.createDataFrame([tuple(old.get(n) for n in RUN_LOG_SCHEMA.names)], RUN_LOG_SCHEMA).write.parquet(f"{root}/run_log")
    log_event(spark, root, run_id="new", status="running", started_at=AT)
    assert current_version(spark, root) == (1, "old") and compact_run_log(spark, root)
    assert current_version(spark, root) == (1, "old") and set(_log(spark, root)) == {"old", "new"}
