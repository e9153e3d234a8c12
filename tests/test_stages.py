from __future__ import annotations

from datetime import date
from types import SimpleNamespace

import pytest
from conftest import ARRIVAL

from assayer.contracts import DAILY_MART, HOURLY_MART
from assayer.operators import sinks
from assayer.operators.publish import read_mart
from assayer.operators.sinks import overwrite
from assayer.plans import stages
from assayer.plans.scratch import scratch_dir
from assayer.sources import SourceSpec


def test_bronze_stage(spark, trips_csv, tmp_path):
    out = str(tmp_path / "bronze")
    spec = SourceSpec(trips_csv, "csv", "sample")
    run = stages.run_bronze(spark, spec=spec, output_path=out, batch_id="b-1", ingested_at=ARRIVAL)
    assert (run.output.rows, run.batch_id, run.spec.source, run.metrics()["source_year"]) == (5, "b-1", "sample", None)
    assert run.input_bytes > 100
    written = spark.read.parquet(out)
    assert written.count() == 5
    assert [r[0] for r in written.select("_batch_id").distinct().collect()] == ["b-1"]
    with pytest.raises(FileNotFoundError):
        stages.run_bronze(spark, spec=SourceSpec(trips_csv + "x", "csv", "sample"), output_path=out, batch_id="b", ingested_at=ARRIVAL)


def test_zone_stage(spark, zones_csv, tmp_path):
    out = str(tmp_path / "zones")
    run = stages.run_zones(spark, spec=SourceSpec(zones_csv, "csv", "lookup"), output_path=out)
    assert run.output.rows == 7
    written = spark.read.parquet(out)
    assert written.columns == ["location_id", "borough", "zone", "service_zone", "_source_file_path"]
    assert written.select("location_id").distinct().count() == 7


@pytest.mark.parametrize(("lines", "message"), [("", "at least one row"), ("1,a,b,c\n1,a,b,c\n", "duplicate"), ("x,a,b,c\n", "null")])
def test_bad_zones_are_not_written(spark, tmp_path, lines, message):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\n" + lines, encoding="utf-8")
    out = tmp_path / "out"
    with pytest.raises(ValueError, match=message):
        stages.run_zones(spark, spec=SourceSpec(str(path), "csv", "lookup"), output_path=str(out))
    assert not out.exists()


def test_silver_stage(spark, bronze, tmp_path):
    overwrite(bronze, str(tmp_path / "bronze"))
    run = stages.run_silver(spark, bronze_path=str(tmp_path / "bronze"), silver_path=str(tmp_path / "silver"))
    assert (run.total_row_count, run.valid_row_count, run.invalid_row_count, run.invalid_row_rate) == (5, 3, 2, 0.4)
    empty = stages.run_silver(spark, bronze_path=_empty(spark, bronze, tmp_path), silver_path=str(tmp_path / "s2"))
    assert (empty.total_row_count, empty.invalid_row_rate) == (0, 0.0)


def _empty(spark, bronze, tmp_path):
    overwrite(bronze.limit(0), str(tmp_path / "empty"))
    return str(tmp_path / "empty")


def _gold(spark, bronze, zones, tmp_path, **options):
    overwrite(bronze, str(tmp_path / "bronze"))
    overwrite(zones, str(tmp_path / "zones"))
    stages.run_silver(spark, bronze_path=str(tmp_path / "bronze"), silver_path=str(tmp_path / "silver"))
    return stages.run_gold(
        spark,
        silver_path=str(tmp_path / "silver"),
        zones_path=str(tmp_path / "zones"),
        daily_path=str(tmp_path / "daily"),
        hourly_path=str(tmp_path / "hourly"),
        **options,
    )


def test_gold_stage(spark, bronze, zones, tmp_path):
    run = _gold(spark, bronze, zones, tmp_path)
    assert (run.trips, run.unmatched_trips, run.zone_match_rate) == (3, 0, 1.0)
    assert (run.daily.rows, run.hourly.rows) == (3, 3)
    assert run.window == (date(2024, 1, 1), date(2024, 1, 2))
    daily, hourly = stages.read_gold(spark, run.daily.path, run.hourly.path)
    assert daily.agg({"trip_count": "sum"}).first()[0] == hourly.agg({"trip_count": "sum"}).first()[0] == 3
    assert (tmp_path / "daily" / "pickup_year=2024" / "pickup_month=1").is_dir()


def test_gold_rejects_repeated_zones(spark, bronze, zones, tmp_path):
    with pytest.raises(ValueError, match="duplicate"):
        _gold(spark, bronze, zones.unionByName(zones), tmp_path)


def test_gold_of_no_trips(spark, bronze, zones, tmp_path):
    run = _gold(spark, bronze.limit(0), zones, tmp_path)
    assert (run.trips, run.zone_match_rate, run.window, run.daily.rows) == (0, 0.0, (None, None), 0)
    with pytest.raises(ValueError, match="at least one row"):
        stages.run_publish(spark, daily_path=run.daily.path, hourly_path=run.hourly.path, mart_root=str(tmp_path / "m"), run_id="r")


def test_gold_of_one_month_keeps_the_others(spark, bronze_rows, zones, tmp_path):
    february = {"tpep_pickup_datetime": "2024-02-03 08:00:00", "tpep_dropoff_datetime": "2024-02-03 09:00:00"}
    _gold(spark, bronze_rows({}, february), zones, tmp_path)
    run = _gold(spark, bronze_rows(february, february, {}), zones, tmp_path, months=[(2024, 2)])
    assert run.trips == 2
    daily, _ = stages.read_gold(spark, run.daily.path, run.hourly.path)
    assert {(r["pickup_month"], r["trip_count"]) for r in daily.collect()} == {(1, 1), (2, 2)}


JANUARY, FEBRUARY = {}, {"tpep_pickup_datetime": "2024-02-03 08:00:00", "tpep_dropoff_datetime": "2024-02-03 09:00:00"}
NO_TIME, BAD = {"tpep_pickup_datetime": "never"}, {"fare_amount": "-1"}


class Lake:
    """Loads of units into bronze and silver below a folder."""

    def __init__(self, spark, bronze_rows, folder):
        self.spark, self.rows, self.folder = spark, bronze_rows, folder

    def load(self, unit, *changes):
        overwrite(self.rows(*changes) if changes else self.rows({}).limit(0), sinks.unit_path(f"{self.folder}/bronze", unit))
        return stages.run_silver(self.spark, bronze_path=f"{self.folder}/bronze", silver_path=f"{self.folder}/silver", unit=unit)

    def months(self, valid=True):
        rows = stages.read_silver(self.spark, f"{self.folder}/silver", valid=valid).groupBy("pickup_month").count().collect()
        return {r["pickup_month"]: r["count"] for r in rows}


@pytest.fixture
def lake(spark, bronze_rows, tmp_path):
    return Lake(spark, bronze_rows, tmp_path)


def test_a_months_file_with_a_day_of_another_loses_nothing(lake):
    lake.load("m-1", *[JANUARY] * 5)
    lake.load("m-2", FEBRUARY, JANUARY)
    assert lake.months() == {1: 6, 2: 1}


def test_a_corrected_load_moves_rows_to_the_other_side(lake):
    lake.load("m-1", JANUARY, BAD)
    run = lake.load("m-1", JANUARY, JANUARY)
    assert (lake.months(), lake.months(valid=False)) == ({1: 2}, {})
    assert (run.valid_row_count, run.invalid_row_count, run.months) == (2, 0, ((2024, 1),))


def test_rows_without_a_time_stay_with_their_unit(lake):
    lake.load("m-1", NO_TIME, NO_TIME, NO_TIME)
    lake.load("m-2", NO_TIME)
    assert lake.months(valid=False) == {None: 4}


def test_a_month_that_empties_leaves_gold(spark, lake, zones):
    paths = {name: f"{lake.folder}/{name}" for name in ("silver", "zones", "daily", "hourly")}
    overwrite(zones, paths["zones"])
    gold = lambda months: stages.run_gold(spark, **{f"{k}_path": v for k, v in paths.items()}, months=months)
    gold(lake.load("m-1", JANUARY).months)
    gold(lake.load("m-2", FEBRUARY, FEBRUARY).months)
    run = lake.load("m-2", JANUARY)
    assert run.months == ((2024, 1), (2024, 2))
    summary = gold(run.months)
    assert (summary.trips, summary.daily.rows) == (2, 1)
    for table in stages.read_gold(spark, paths["daily"], paths["hourly"]):
        assert [(r["pickup_month"], r["trip_count"]) for r in table.collect()] == [(1, 2)]


def test_units_have_plain_names():
    with pytest.raises(ValueError, match="source unit"):
        sinks.unit_path("p", "../x")


def test_units_go_through_the_whole_chain(spark, bronze_rows, zones_csv, tmp_path):
    def run(run_id, month, *changes):
        path = str(tmp_path / run_id)
        bronze_rows(*changes).drop("_source_file_path", "_batch_id", "_ingested_at").write.parquet(path)
        spec = SourceSpec(path, "parquet", "tlc", (2024, month))
        zones = SourceSpec(zones_csv, "csv", "lookup")
        return stages.run_all(spark, trips=spec, zones=zones, root=f"{tmp_path}/lake", run_id=run_id, ingested_at=ARRIVAL, replace="unit")

    run("r1", 1, JANUARY, JANUARY)
    run("r2", 2, JANUARY, FEBRUARY)
    mart = lambda: {(r["pickup_date"].month, r["trip_count"], r["source_batch_count"], r["publish_run_id"]) for r in read_mart(spark, f"{tmp_path}/lake/marts", DAILY_MART).collect()}
    assert mart() == {(1, 3, 2, "r2"), (2, 1, 1, "r2")}
    run("r3", 2, FEBRUARY, BAD)
    assert mart() == {(1, 2, 1, "r3"), (2, 1, 1, "r3")}
    last = run("r4", 2, BAD)
    assert last.publish.daily_zone_row_count == 0 and mart() == {(1, 2, 1, "r3")}


def test_publish_needs_a_run_id(spark, tmp_path):
    with pytest.raises(ValueError, match="run_id"):
        stages.run_publish(spark, daily_path="d", hourly_path="h", mart_root=str(tmp_path), run_id=" ")


def test_whole_chain(spark, trips_csv, zones_csv, tmp_path):
    root = str(tmp_path)
    run = stages.run_all(
        spark,
        trips=SourceSpec(trips_csv, "csv", "sample"),
        zones=SourceSpec(zones_csv, "csv", "lookup"),
        root=root,
        run_id="run-1",
        ingested_at=ARRIVAL,
    )
    assert (run.silver.valid_row_count, run.gold.daily.rows, run.publish.daily_zone_row_count) == (3, 3, 3)
    for table in (DAILY_MART, HOURLY_MART):
        mart = read_mart(spark, f"{root}/marts", table)
        assert mart.agg({"trip_count": "sum"}).first()[0] == 3
        assert {r[0] for r in mart.select("publish_run_id").collect()} == {"run-1"}
    metrics = {(r["stage"], r["metric"]): r["value"] for r in stages.run_metrics(spark, run).collect()}
    assert metrics["silver", "invalid_row_rate"] == "0.4"
    assert metrics["gold", "zone_match_rate"] == "1.0"
    assert metrics["bronze", "source_year"] is None
    assert metrics["publish", "date_to"] == "2024-01-02"


def test_other_time_zones_are_rejected(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            stages.run_silver(spark, bronze_path="x", silver_path="y")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _session(master, **conf):
    return SimpleNamespace(conf=conf_of(conf), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: conf.get("set_on_context")))


def conf_of(values):
    return SimpleNamespace(get=lambda name, default: values.get(name.replace(".", "_"), default))


def test_scratch_follows_the_session():
    shared = _session("spark://host:7077", spark_checkpoint_dir="/shared/folder/")
    assert scratch_dir(shared, "x").startswith("/shared/folder/x-")
    assert scratch_dir(shared, "x") != scratch_dir(shared, "x")
    assert "/x-" in scratch_dir(_session("local[2]"), "x")
    assert scratch_dir(_session("spark://host:7077", set_on_context="/other"), "x").startswith("/other/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(_session("spark://host:7077"), "x")


def _plans(spark, monkeypatch, module, run):
    """Physical plans of everything ``module`` writes while ``run`` goes on."""
    plans, real = [], module.overwrite

    def spy(df, path, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, path, **options)

    monkeypatch.setattr(module, "overwrite", spy)
    run()
    monkeypatch.undo()
    return plans


def test_silver_is_one_narrow_scan(spark, bronze, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    overwrite(bronze, path)
    (plan,) = _plans(
        spark, monkeypatch, sinks, lambda: stages.run_silver(spark, bronze_path=path, silver_path=str(tmp_path / "s"))
    )
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan and "InMemoryTableScan" not in plan and "lambda" not in plan


def test_gold_scans_the_trips_once(spark, bronze, zones, tmp_path, monkeypatch):
    plans = _plans(spark, monkeypatch, stages, lambda: _gold(spark, bronze, zones, tmp_path)) + _plans(
        spark, monkeypatch, sinks, lambda: _gold(spark, bronze, zones, tmp_path)
    )
    on_trips = [plan for plan in plans if "fare_amount" in plan and "FileScan" in plan and "HashAggregate" in plan]
    assert len(on_trips) == 1
    (plan,) = on_trips
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    columns = plan[plan.index("ReadSchema") :]
    assert "vendor_id" not in columns and "_invalid_reasons" not in columns
