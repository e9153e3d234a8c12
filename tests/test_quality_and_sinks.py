from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayer.contracts import DAILY_MART, HOURLY_MART
from assayer.operators.metrics import daily_zone_from_trips, hourly_demand_metrics
from assayer.operators.quality import (
    assert_constraints,
    assert_non_empty,
    assert_unique_mart_keys,
    assert_unique_non_null_key,
    assert_window_complete,
    constraint_violations,
    duplicate_keys,
    key_counts,
    mart_report,
    money_overflow,
    null_keys,
    reconcile,
    status_violations,
)
from assayer.operators.rules import valid_rows
from assayer.operators.sinks import overwrite, overwrite_silver, overwrite_silver_pair
from assayer.plans.stages import read_silver


def _zones(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "location_id int")


def _check(df, key="location_id"):
    return assert_unique_non_null_key(df, key=key, dataset="zones")


def test_key_check(spark):
    assert _check(_zones(spark, 1, 2, 3)) == 3
    assert _check(_zones(spark)) == 0
    with pytest.raises(ValueError, match="missing its key column other"):
        _check(_zones(spark, 1), key="other")
    with pytest.raises(ValueError, match="null"):
        _check(_zones(spark, 1, None))
    with pytest.raises(ValueError, match="duplicate"):
        _check(_zones(spark, 236, 236))
    with pytest.raises(ValueError, match="null"):
        _check(_zones(spark, 236, 236, None, None))


def test_key_frames(spark):
    df = _zones(spark, 1, 1, None)
    assert {tuple(r) for r in key_counts(df, "location_id").collect()} == {(1, 2), (None, 1)}
    assert null_keys(df, "location_id").first()["row_count"] == 1
    assert [tuple(r) for r in duplicate_keys(df, ["location_id"]).collect()] == [(1, 2)]


def test_non_empty():
    assert_non_empty({"a": 1})
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        assert_non_empty({"a": 1, "c": 0, "b": 0})


@pytest.fixture
def gold(silver, zones):
    trips = valid_rows(silver)
    return daily_zone_from_trips(trips, zones), hourly_demand_metrics(trips)


def test_clean_marts_pass(gold):
    daily, hourly = gold
    reports = mart_report(daily, DAILY_MART), mart_report(hourly, HOURLY_MART)
    assert [(r.duplicate_keys, r.violations) for r in reports] == [(0, {}), (0, {})]
    assert_unique_mart_keys(*reports)
    assert assert_window_complete(*reports) == (date(2024, 1, 1), date(2024, 1, 2))
    reconcile(3, daily=daily, hourly=hourly)
    with pytest.raises(ValueError, match="hourly covers 3 trips, expected 4"):
        reconcile(4, hourly=hourly)


def test_violations_are_counted_and_null_checks_pass(gold):
    daily, hourly = gold
    spoilt = daily.withColumns(
        {
            "trip_count": -F.col("trip_count"),
            "card_payment_share": F.lit(1.5),
            "cash_payment_share": F.lit(None).cast("double"),
            "avg_trip_distance": F.lit(None).cast("double"),
        }
    )
    found = {r["constraint_name"]: r["violations"] for r in constraint_violations(spoilt, DAILY_MART).collect()}
    assert {name for name, n in found.items() if n} == {
        "trip_count_non_negative",
        "card_payment_share_range",
        "cash_payment_share_not_null",
    }
    assert found["cash_payment_share_range"] == 0
    report = mart_report(spoilt, DAILY_MART)
    assert report.violations == {name: n for name, n in found.items() if n}
    with pytest.raises(ValueError, match="card_payment_share_range"):
        assert_constraints(DAILY_MART.name, report.violations)
    late = mart_report(hourly.withColumn("pickup_hour", F.lit(24)), HOURLY_MART)
    assert late.violations == {"pickup_hour_range": 3}
    assert late.duplicate_keys == 1
    with pytest.raises(ValueError, match="duplicate keys"):
        assert_unique_mart_keys(late)


def test_empty_mart_has_no_window(gold):
    report = mart_report(gold[0].limit(0), DAILY_MART)
    assert (report.duplicate_keys, report.date_from, report.violations) == (0, None, {})
    with pytest.raises(ValueError, match="no complete date range"):
        assert_window_complete(report)


def test_money_overflow(gold):
    blown = gold[0].withColumn("total_tip_amount", F.lit(Decimal("1234567890123456789.00")).cast("decimal(22,2)"))
    found = {r["constraint_name"]: r["violations"] for r in money_overflow(blown, DAILY_MART).collect()}
    assert found == {"gross_revenue_amount_fits": 0, "fare_revenue_amount_fits": 0, "total_tip_amount_fits": 3}


def test_status_domain(spark):
    log = spark.createDataFrame([("running",), ("failed",), ("lost",)], "status string")
    assert status_violations(log).first()["violations"] == 1


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "d")
    assert overwrite(spark.createDataFrame([(1, "first")], "id int, v string"), path) == {"rows": 1}
    assert overwrite(spark.createDataFrame([(2, "second")], "id int, v string"), path) == {"rows": 1}
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2, "second")]
    assert overwrite(spark.createDataFrame([], "id int, v string"), path) == {"rows": 0}
    assert spark.read.parquet(path).count() == 0


def test_partitioned_overwrite(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "id int, y int, m int")
    overwrite(rows, path, partition_by=["y", "m"])
    assert (tmp_path / "d" / "y=2024" / "m=1").is_dir()
    changed = spark.createDataFrame([(9, 2024, 2)], "id int, y int, m int")
    overwrite(changed, path, partition_by=["y", "m"], replace="partitions")
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, 2024, 1), (9, 2024, 2)}
    overwrite(changed, path, partition_by=["y", "m"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(9, 2024, 2)}


def test_overwrite_arguments(spark, tmp_path):
    df, path = spark.range(1), str(tmp_path / "d")
    with pytest.raises(ValueError, match="at least one column"):
        overwrite(df, path, partition_by=[])
    with pytest.raises(ValueError, match=r"\['a', 'b'\]"):
        overwrite(df, path, partition_by=["b", "id", "a"])
    with pytest.raises(ValueError, match="partition_by"):
        overwrite(df, path, replace="partitions")
    with pytest.raises(ValueError, match="'some'"):
        overwrite(df, path, replace="some")


def test_silver_sinks_are_lossless(spark, silver, tmp_path):
    one = str(tmp_path / "one")
    assert overwrite_silver(silver, one) == {"rows": 5, "valid_rows": 3, "invalid_rows": 2}
    valid, invalid = read_silver(spark, one), read_silver(spark, one, valid=False)
    assert valid.columns == invalid.columns == silver.columns
    assert sorted(valid.unionByName(invalid).drop("_ingested_at").collect(), key=str) == sorted(
        silver.drop("_ingested_at").collect(), key=str
    )
    pair = str(tmp_path / "valid"), str(tmp_path / "invalid")
    assert overwrite_silver_pair(silver, *pair) == (3, 2)
    assert (tmp_path / "valid" / "pickup_year=2024").is_dir()
    assert not any(p.name.startswith("pickup_year") for p in (tmp_path / "invalid").iterdir())


def test_silver_reads_only_its_directories(spark, silver, tmp_path):
    path = str(tmp_path / "s")
    overwrite_silver(silver, path)
    files = read_silver(spark, path, months=[(2024, 1), (2024, 7)]).inputFiles()
    assert files and all("/source_unit=all/row_set=valid/row_month=m2024-01/" in f for f in files)
    assert all("/row_set=invalid/row_month=all/" in f for f in read_silver(spark, path, valid=False).inputFiles())
    assert read_silver(spark, path, months=[(2024, 7)]).count() == read_silver(spark, path, months=[]).count() == 0
    all_valid = str(tmp_path / "v")
    overwrite_silver(valid_rows(silver), all_valid)
    assert read_silver(spark, all_valid, valid=False).count() == 0
    overwrite_silver(silver.limit(0), all_valid)
    assert read_silver(spark, all_valid).count() == 0


def test_the_snapshot_query_computes_each_table_from_the_trips_once(spark, monkeypatch):
    from assayer.plans.queries import QUERIES, chain

    real, scans = chain.overwrite, []

    def watched(df, *args, **options):
        scans.append("event_id" in df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *args, **options)

    monkeypatch.setattr(chain, "overwrite", watched)
    assert QUERIES["sink_snapshot_after_failure"](spark, "/root/testdata/sf0.001").count() > 0
    assert sum(scans) == 2 and len(scans) == 6
