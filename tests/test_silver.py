from __future__ import annotations

from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayer.contracts import SILVER_SCHEMA, require_columns
from assayer.functions import to_instant, to_int, to_money
from assayer.functions.casts import CAST_SQL, cast_text
from assayer.operators.projections import build_silver, with_lineage
from assayer.operators.rules import TRIP_RULES, Rule, reason_counts, split_rows, tag_rows
from assayer.operators.sinks import silver_layout
from assayer.sources import scan_trips_csv

both_ansi = pytest.mark.parametrize("ansi", ["true", "false"], indirect=True)


def _values(spark, column, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column("x")).collect()]


@both_ansi
def test_int_cast(spark, ansi):
    cases = {
        "1": 1, " 7 ": 7, "1.0": 1, "236.0": 236, "1.9": 1, "-1.9": -1, ".5": 0, ".": 0, "5.": 5, "+5": 5, "": None,
        "abc": None, "NaN": None, "1e3": None, "7d": None, "1.x": None, "99999999999": None, "99999999999.5": None,
        "2147483647.9": 2147483647, None: None,
    }
    assert _values(spark, to_int, list(cases)) == list(cases.values())


def test_int_cast_equals_the_lenient_cast(spark):
    """Spark's own cast without ANSI is the meaning to keep."""
    texts = ["1", " 7 ", "1.0", "-1.9", ".5", ".", "-.", "+", "", "NaN", "1e3", "7d", "99999999999.5", "0x1", "1,5", "--1"]
    mine = _values(spark, to_int, texts)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert mine == _values(spark, lambda c: F.col(c).cast("int"), texts)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789+-. eEdx", max_size=12), min_size=20, max_size=60))
def test_int_cast_property(spark, texts):
    mine = _values(spark, to_int, texts)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert mine == _values(spark, lambda c: F.col(c).cast("int"), texts)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@both_ansi
def test_money_and_timestamp_casts(spark, ansi):
    assert _values(spark, to_money, ["1.005", "18.4", "99999999999.99", "x", ""]) == [
        Decimal("1.01"), Decimal("18.40"), None, None, None,
    ]
    texts = ["2024-01-01 08:15:00", "2024-01-01 08:15:00.5", "2024-01-01", "2024-02-30 08:15:00", "junk"]
    parsed = _values(spark, lambda c: to_instant(c).cast("string"), texts)
    assert parsed == ["2024-01-01 08:15:00", None, None, None, None]


def _same_as_parser(spark, texts):
    parser = lambda c: F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss"))
    assert _values(spark, lambda c: to_instant(c).cast("string"), texts) == _values(
        spark, lambda c: parser(c).cast("string"), texts
    )


def test_timestamp_shortcut_reads_like_the_parser(spark):
    stamp = "2024-01-01 08:15:00"
    _same_as_parser(
        spark,
        [stamp, f" {stamp}", f"{stamp} ", f"{stamp}\n", stamp.replace(" ", "T"), "2024-1-01 08:15:00", "12024-1-01 08:15:00",
         "+12024-01-01 08:15:00", "0000-01-01 00:00:00", "9999-12-31 23:59:59", "2024-01-01 24:00:00", "2024-01-01 23:59:60",
         "2023-02-29 00:00:00", "2024-02-29 00:00:00", "2024-01-01 8:15:0.5", "2024-01-01 08:15:0Z", "2024-13-01 00:00:00"],
    )


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.from_regex(r"[0-9]{4}-[0-3][0-9]-[0-3][0-9][ T]?[0-2][0-9]:[0-6][0-9]:[0-6][0-9][ Z.0-9]?", fullmatch=True), min_size=20, max_size=60))
def test_timestamp_shortcut_property(spark, texts):
    _same_as_parser(spark, texts)


def test_lineage(spark, trips_csv):
    raw = scan_trips_csv(spark, trips_csv)
    arrival = datetime(2024, 1, 3, 12, tzinfo=UTC)
    row = with_lineage(raw, batch_id="b-1", ingested_at=arrival).selectExpr("_batch_id", "unix_timestamp(_ingested_at)").first()
    assert tuple(row) == ("b-1", int(arrival.timestamp()))
    with pytest.raises(ValueError, match="batch_id"):
        with_lineage(raw, batch_id="  ", ingested_at=arrival)
    with pytest.raises(ValueError, match="time zone"):
        with_lineage(raw, batch_id="b", ingested_at=datetime(2024, 1, 3))
    with pytest.raises(ValueError, match="_source_file_path"):
        with_lineage(raw.drop("_source_file_path"), batch_id="b", ingested_at=arrival)


def test_derived_columns(silver):
    row = silver.filter("pickup_location_id = 41").first()
    assert (row["pickup_date"], row["pickup_hour"], row["pickup_year"], row["pickup_month"]) == (date(2024, 1, 1), 6, 2024, 1)
    assert row["trip_duration_minutes"] == 12.0
    assert row["fare_per_mile"] == pytest.approx(5.25)
    assert silver.filter("pickup_location_id = 59").first()["trip_duration_minutes"] == -7.0
    assert silver.filter("pickup_location_id = 60").first()["fare_per_mile"] is None


def test_silver_schema(silver):
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]


def test_split_of_the_sample(silver):
    valid, invalid = split_rows(silver)
    assert (valid.count(), invalid.count()) == (3, 2)
    assert {(r["reason"], r["row_count"]) for r in reason_counts(silver).collect()} == {
        ("dropoff_not_after_pickup", 1),
        ("non_positive_trip_distance", 1),
    }


def test_missing_bronze_columns_are_named(bronze):
    with pytest.raises(ValueError, match=r"\['VendorID', 'extra'\]"):
        build_silver(bronze.drop("extra", "VendorID"))


RULE_CASES = {
    "invalid_pickup_timestamp": {"tpep_pickup_datetime": "2024-01-01 08:15:00.5"},
    "invalid_dropoff_timestamp": {"tpep_dropoff_datetime": "2024-01-01"},
    "dropoff_not_after_pickup": {"tpep_dropoff_datetime": "2024-01-01 06:40:00"},
    "non_positive_trip_distance": {"trip_distance": "-0.1"},
    "invalid_fare_amount": {"fare_amount": "99999999999.99"},
    "invalid_total_amount": {"total_amount": "-0.01"},
    "missing_pickup_location": {"PULocationID": "x"},
    "missing_dropoff_location": {"DOLocationID": None},
}


@both_ansi
def test_each_rule_alone_and_all_that_can_meet(ansi, bronze_rows):
    together = {"tpep_pickup_datetime": "bad", "tpep_dropoff_datetime": None, "trip_distance": None, "fare_amount": "-1",
                "total_amount": "", "PULocationID": None, "DOLocationID": "y"}
    rows = build_silver(bronze_rows(*RULE_CASES.values(), together)).coalesce(1).collect()
    assert [r["_invalid_reasons"] for r in rows[:-1]] == [[reason] for reason in RULE_CASES]
    assert rows[-1]["_invalid_reasons"] == [r.reason for r in TRIP_RULES if r.reason != "dropoff_not_after_pickup"]
    assert not any(r["is_valid"] for r in rows)


@both_ansi
def test_edges_that_stay_valid(ansi, bronze_rows):
    rows = build_silver(
        bronze_rows(
            {"fare_amount": "0", "total_amount": "0.00"},
            {"PULocationID": "236.0"},
            {"trip_distance": "NaN"},
            {"payment_type": None},
        )
    ).collect()
    assert [r["is_valid"] for r in rows] == [True] * 4
    assert [r["_invalid_reasons"] for r in rows] == [[]] * 4
    assert rows[1]["pickup_location_id"] == 236


def test_extra_rules_are_opt_in(silver):
    base = silver.drop("_invalid_reasons", "is_valid")
    late = Rule("pickup_too_late", "pickup_date > DATE '2024-01-01'")
    tagged = tag_rows(base, (*TRIP_RULES, late))
    assert tagged.filter("is_valid").count() == 2
    assert tagged.filter("pickup_location_id = 60").first()["_invalid_reasons"] == [
        "non_positive_trip_distance",
        "pickup_too_late",
    ]


def test_rule_with_null_outcome_does_not_break(spark):
    tagged = tag_rows(spark.createDataFrame([(None,), (3,), (-3,)], "a int"), [Rule("negative", "a < 0")])
    assert [(r["is_valid"], r["_invalid_reasons"]) for r in tagged.collect()] == [
        (True, []),
        (True, []),
        (False, ["negative"]),
    ]


def test_tagging_stays_in_generated_code(silver):
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Project" in plan and "lambda" not in plan
    assert "Exchange" not in plan


def test_require_columns_allows_extras(spark):
    df = spark.range(1)
    assert require_columns(df, ["id"], "numbers") is df
    with pytest.raises(ValueError, match=r"numbers lacks required columns: \['a', 'b'\]"):
        require_columns(df, ["b", "id", "a"], "numbers")


def test_words_are_no_numbers_or_times_without_an_exception(spark):
    """The cheap comparison decides only about text that no cast takes; all other text gets what the cast gives."""
    texts = ["", " ", "none", "None", "NaN", "e5", "x1", "_", "1e3", "+1", "-1.005", ".5", " 7 ", "1z", "{1}", "٣", None]
    rows = spark.createDataFrame([(t,) for t in texts], "a string")
    assert "'A'" in CAST_SQL["money"] and "'A'" in CAST_SQL["timestamp"]
    cast = rows.select("a", cast_text("a", "money").alias("got"), F.expr("try_cast(a AS decimal(12,2))").alias("plain"))
    assert cast.filter("NOT got <=> plain").isEmpty()
    times = ["", "bad-ts", "T", "2024-01-02 03:04:05", "2024-01-02", "2024-01-02 03:04:05.5", "+12024-01-02 03:04:05", "2024-02-30 08:15:00", None]
    plain = "try_to_timestamp(a, 'yyyy-MM-dd HH:mm:ss')"
    cast = spark.createDataFrame([(t,) for t in times], "a string").select(cast_text("a", "timestamp").alias("got"), F.expr(plain).alias("plain"))
    assert cast.filter("NOT got <=> plain").isEmpty()


def test_month_directories_are_named_as_by_a_formatter_for_any_year(spark):
    rows = spark.createDataFrame([(y, m, True) for y in (0, 7, 1999, 9999, 12345) for m in (1, 12)], "pickup_year int, pickup_month int, is_valid boolean")
    named = silver_layout(rows).select("row_month", F.format_string("m%04d-%02d", "pickup_year", "pickup_month").alias("told")).collect()
    assert all(r["row_month"] == r["told"] for r in named)


def test_few_bytes_of_trips_are_shared_by_all_cores(spark, tmp_path):
    """Four files of half a megabyte are read by four tasks, and timestamps are written as longs."""
    path = str(tmp_path / "small")
    spark.range(0, 4 * 65536, 1, 4).selectExpr("id", "timestamp_micros(id) AS t").write.parquet(path)
    assert spark.read.parquet(path).rdd.getNumPartitions() == 4
    import pyarrow.parquet as pq

    file = next(p for p in (tmp_path / "small").iterdir() if p.suffix == ".parquet")
    assert pq.ParquetFile(file).schema.column(1).physical_type == "INT64"
