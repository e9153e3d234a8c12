from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayer.contracts import DAILY_SCHEMA, HOURLY_SCHEMA
from assayer.operators.metrics import (
    daily_zone_from_trips,
    daily_zone_metrics,
    gold_input_summary,
    hourly_demand_metrics,
    order_daily,
    order_hourly,
    rate,
    top_hours,
    top_zones,
    top_zones_per_day,
    trip_rollup,
)
from assayer.operators.projections import build_silver, zone_dimension
from assayer.operators.rules import valid_rows
from assayer.operators.zones import attach_zone, enrich_trips, text_bytes, unmatched_trips

ZONE_DDL = "location_id int, borough string, zone string, service_zone string"


@pytest.fixture
def enriched(silver, zones):
    return enrich_trips(valid_rows(silver), zones)


def test_zone_dimension_is_typed_and_trimmed(spark):
    raw = spark.createDataFrame(
        [("41.0", "  Eastbank ", "A", None, "f")], "LocationID string, Borough string, Zone string, service_zone string, _source_file_path string"
    )
    zones = zone_dimension(raw)
    assert zones.columns == ["location_id", "borough", "zone", "service_zone", "_source_file_path"]
    assert tuple(zones.first()) == (41, "Eastbank", "A", None, "f")
    with pytest.raises(ValueError, match="Borough"):
        zone_dimension(raw.drop("Borough"))


def test_enrichment_keeps_every_trip(enriched):
    assert enriched.count() == 3
    row = enriched.filter("pickup_location_id = 41").first()
    assert (row["pickup_borough"], row["pickup_zone"], row["_zone_lookup_matched"]) == ("Northside", "Old Harbour", True)
    assert enriched.columns[-4:] == ["pickup_borough", "pickup_zone", "pickup_service_zone", "_zone_lookup_matched"]


def test_unknown_zone_and_null_attribute(spark, silver):
    trips = valid_rows(silver).withColumn("pickup_location_id", F.when(F.col("pickup_location_id") == 58, 999).otherwise(F.col("pickup_location_id")))
    zones = spark.createDataFrame([(41, None, "Z", "S"), (62, "B", "Y", None)], ZONE_DDL)
    rows = {r["pickup_location_id"]: r for r in enrich_trips(trips, zones).collect()}
    assert (rows[999]["pickup_zone"], rows[999]["_zone_lookup_matched"]) == ("Unknown", False)
    assert (rows[41]["pickup_borough"], rows[41]["_zone_lookup_matched"]) == ("Unknown", True)
    assert rows[62]["pickup_service_zone"] == "Unknown"
    assert [r["pickup_location_id"] for r in unmatched_trips(enrich_trips(trips, zones)).collect()] == [999]


def test_enrichment_needs_the_trip_contract(silver, zones):
    with pytest.raises(ValueError, match=r"\['_batch_id', 'is_valid'\]"):
        enrich_trips(silver.drop("is_valid", "_batch_id"), zones)


def test_the_caller_decides_about_a_broadcast(spark, silver, zones):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(attach_zone(valid_rows(silver), zones, broadcast=True))
    assert "SortMergeJoin" in plan(attach_zone(valid_rows(silver), zones, broadcast=False))
    assert "Broadcast" not in plan(attach_zone(valid_rows(silver), zones, broadcast=False))
    assert zones.agg(text_bytes(zones)).first()[0] > 7 * 16
    assert zones.limit(0).agg(text_bytes(zones)).first()[0] == 0


def _jobs(spark, build):
    spark.sparkContext.setJobGroup("counted", "counted")
    build()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return spark.sparkContext.statusTracker().getJobIdsForGroup("counted")


def test_building_frames_runs_no_job(spark, silver, zones):
    trips = valid_rows(silver)
    assert not _jobs(spark, lambda: (daily_zone_from_trips(trips, zones), enrich_trips(trips, zones), hourly_demand_metrics(trips)))


def test_merges_copy_no_rows(spark, silver, zones):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    hourly, daily = plan(hourly_demand_metrics(valid_rows(silver))), plan(daily_zone_from_trips(valid_rows(silver), zones))
    assert "Expand" not in hourly + daily
    assert hourly.count("Exchange hashpartitioning") == 2


def test_daily_golden(silver, zones, enriched):
    expected = {
        41: (date(2024, 1, 1), "18.00", "12.60", "3.10", 2.4, 12.0, 5.25, 1.0),
        58: (date(2024, 1, 1), "29.00", "24.70", "0.00", 6.5, 30.0, 3.8, 0.0),
        62: (date(2024, 1, 2), "49.10", "33.60", "6.70", 9.6, 24.0, 3.5, 1.0),
    }
    for daily in (daily_zone_metrics(enriched), daily_zone_from_trips(valid_rows(silver), zones)):
        assert [(f.name, f.dataType) for f in daily.schema] == [(f.name, f.dataType) for f in DAILY_SCHEMA]
        rows = {r["pickup_location_id"]: r for r in daily.collect()}
        assert set(rows) == set(expected)
        for location, (day, gross, fare, tip, distance, minutes, per_mile, _) in expected.items():
            r = rows[location]
            assert (r["pickup_date"], r["trip_count"], r["source_batch_count"]) == (day, 1, 1)
            assert (r["gross_revenue_amount"], r["fare_revenue_amount"], r["total_tip_amount"]) == (
                Decimal(gross), Decimal(fare), Decimal(tip),
            )
            assert (r["avg_trip_distance"], r["avg_trip_duration_minutes"]) == (distance, minutes)
            assert r["avg_fare_per_mile"] == pytest.approx(per_mile)
            assert r["latest_source_ingested_at"] == datetime(2024, 1, 3, 12)
        assert (rows[41]["card_payment_share"], rows[58]["cash_payment_share"]) == (1.0, 1.0)


def test_hourly_golden(enriched):
    hourly = hourly_demand_metrics(enriched)
    assert [(f.name, f.dataType) for f in hourly.schema] == [(f.name, f.dataType) for f in HOURLY_SCHEMA]
    rows = order_hourly(hourly).collect()
    assert [(r["pickup_date"].day, r["pickup_hour"], r["trip_count"], r["distinct_pickup_zones"]) for r in rows] == [
        (1, 6, 1, 1),
        (1, 21, 1, 1),
        (2, 16, 1, 1),
    ]


def test_null_payment_counts_in_the_denominator_and_null_tips_stay_null(bronze_rows, spark):
    trips = build_silver(
        bronze_rows(
            {"payment_type": None, "tip_amount": None, "_batch_id": "a"},
            {"payment_type": "1", "tip_amount": None, "_batch_id": "b"},
            {"payment_type": "2", "tip_amount": "x", "_batch_id": "b"},
            {"payment_type": "3", "tip_amount": None, "_batch_id": None},
        )
    )
    zones = spark.createDataFrame([], ZONE_DDL)
    row = daily_zone_from_trips(trips, zones).first()
    assert (row["card_payment_share"], row["cash_payment_share"], row["total_tip_amount"]) == (0.25, 0.25, None)
    assert (row["trip_count"], row["source_batch_count"], row["pickup_zone"]) == (4, 2, "Unknown")


def test_all_null_averages_are_null(bronze_rows, spark):
    trips = build_silver(bronze_rows({"trip_distance": "0"}))
    row = daily_zone_from_trips(trips, spark.createDataFrame([], ZONE_DDL)).first()
    assert (row["avg_trip_distance"], row["avg_fare_per_mile"]) == (0.0, None)


def test_against_brute_force_with_a_hot_zone(bronze_rows, zones):
    """A third of all trips in one zone and hour, several batches, checked against plain Python sums."""
    changes = []
    for i in range(300):
        hot = i % 3 == 0
        hour = 8 if hot else i % 24
        changes.append(
            {
                "tpep_pickup_datetime": f"2024-01-{1 + (0 if hot else i % 5):02d} {hour:02d}:00:00",
                "tpep_dropoff_datetime": f"2024-01-{7 + i % 3:02d} {hour:02d}:30:00",
                "PULocationID": "41" if hot else str(55 + i % 12),
                "total_amount": f"{i}.{i % 100:02d}",
                "trip_distance": f"{1 + i % 9}.5",
                "payment_type": str(i % 4),
                "_batch_id": f"b{i % 7}",
            }
        )
    trips = valid_rows(build_silver(bronze_rows(*changes)))
    groups, hours = defaultdict(list), defaultdict(list)
    for c in changes:
        groups[c["tpep_pickup_datetime"][:10], int(c["PULocationID"])].append(c)
        hours[c["tpep_pickup_datetime"][:13]].append(c)
    daily = {(str(r["pickup_date"]), r["pickup_location_id"]): r for r in daily_zone_from_trips(trips, zones).collect()}
    assert set(daily) == set(groups)
    for key, members in groups.items():
        r = daily[key]
        assert r["trip_count"] == len(members)
        assert r["gross_revenue_amount"] == sum(Decimal(m["total_amount"]) for m in members)
        assert r["avg_trip_distance"] == pytest.approx(sum(float(m["trip_distance"]) for m in members) / len(members))
        assert r["card_payment_share"] == pytest.approx(sum(m["payment_type"] == "1" for m in members) / len(members))
        assert r["source_batch_count"] == len({m["_batch_id"] for m in members})
    hourly = {f"{r['pickup_date']} {r['pickup_hour']:02d}": r for r in hourly_demand_metrics(trips).collect()}
    assert set(hourly) == set(hours)
    for key, members in hours.items():
        assert hourly[key]["distinct_pickup_zones"] == len({m["PULocationID"] for m in members})
        assert hourly[key]["source_batch_count"] == len({m["_batch_id"] for m in members})


def test_rollup_merges_exactly(enriched):
    """Merging the hour-level rollup gives what aggregating the trips gives."""
    from assayer.operators.metrics import merge_daily

    direct = {r["pickup_location_id"]: r for r in daily_zone_metrics(enriched).collect()}
    zones_columns = ["pickup_borough", "pickup_zone", "pickup_service_zone"]
    rollup = trip_rollup(enriched, ("pickup_date", "pickup_year", "pickup_month", "pickup_hour", "pickup_location_id", "_batch_id", *zones_columns))
    assert {r["pickup_location_id"]: r for r in merge_daily(rollup).collect()} == direct


def test_summary(enriched, zones, silver):
    summary = gold_input_summary(attach_zone(trip_rollup(valid_rows(silver)), zones)).first()
    assert tuple(summary) == (3, 0, date(2024, 1, 1), date(2024, 1, 2))
    empty = gold_input_summary(attach_zone(trip_rollup(valid_rows(silver).limit(0)), zones)).first()
    assert tuple(empty) == (0, 0, None, None)


def test_orders_and_top(spark):
    daily = spark.createDataFrame(
        [(date(2024, 1, d), z, "B", f"Z{z}", n, Decimal(a)) for d, z, n, a in ((1, 1, 5, 9), (1, 2, 7, 1), (1, 3, 7, 2), (2, 1, 3, 1))],
        "pickup_date date, pickup_location_id int, pickup_borough string, pickup_zone string, trip_count bigint, gross_revenue_amount decimal(22,2)",
    )
    assert [r["pickup_location_id"] for r in order_daily(daily).collect()] == [2, 3, 1, 1]
    assert [r["pickup_location_id"] for r in top_zones(daily, 2).collect()] == [1, 2]
    assert [r["pickup_location_id"] for r in top_zones(daily, 2, by="gross_revenue_amount").collect()] == [1, 3]
    assert {(r["pickup_date"].day, r["pickup_location_id"]) for r in top_zones_per_day(daily, 1).collect()} == {(1, 2), (2, 1)}
    with pytest.raises(ValueError):
        top_zones(daily, by="pickup_zone")
    hourly = daily.withColumn("pickup_hour", F.col("pickup_location_id"))
    assert top_hours(hourly, 1).first()["trip_count"] == 8


def test_rates():
    assert rate(2, 5) == 0.4
    assert rate(0, 0) == 0.0


def test_hot_zone_is_combined_before_the_shuffle(silver, zones):
    """Trips are shuffled once, after a partial aggregation, and the zone join comes behind it."""
    plan = daily_zone_from_trips(valid_rows(silver), zones)._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "HashAggregate" in line or "Exchange" in line or "Join" in line or "Scan" in line]
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    below = [line for line in lines[join + 1 :] if "BroadcastExchange" not in line]
    assert sum("Exchange hashpartitioning" in line for line in below) == 1
    assert "HashAggregate" in below[0] and "partial_sum" in below[2]
