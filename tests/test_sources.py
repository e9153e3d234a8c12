from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from assayer.contracts import SOURCE_PATH, TRIP_COLUMNS
from assayer.sources import (
    SourceSpec,
    ensure_available,
    has_data,
    listed_bytes,
    rename_drifted,
    scan_dataset,
    scan_trips,
    scan_trips_csv,
    scan_trips_parquet,
    scan_zones_csv,
    schema_groups,
    trip_source,
    zone_source,
)


def test_csv_scan_has_contract_columns_as_strings(spark, trips_csv):
    df = scan_trips_csv(spark, trips_csv)
    assert df.columns == [*TRIP_COLUMNS, SOURCE_PATH]
    assert {type(f.dataType) for f in df.schema} == {StringType}
    assert df.count() == 5
    assert df.first()[SOURCE_PATH].endswith("/trips.csv")


def test_zone_scan(spark, zones_csv):
    df = scan_zones_csv(spark, zones_csv)
    assert df.count() == 7
    assert df.filter("LocationID = '41'").first()["Zone"] == "Old Harbour"


def test_missing_inputs_are_file_not_found(spark, tmp_path):
    absent = str(tmp_path / "absent")
    for scan in (scan_trips_csv, scan_zones_csv, scan_trips_parquet, scan_dataset):
        with pytest.raises(FileNotFoundError):
            scan(spark, absent)


def test_short_row_fails_once_columns_are_read(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\n1,Eastbank\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        scan_zones_csv(spark, str(path)).collect()


def test_header_names_are_compared_only_on_request(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("a,b,c,d\n1,Eastbank,Pier,Airfield\n", encoding="utf-8")
    assert scan_zones_csv(spark, str(path)).first()["Borough"] == "Eastbank"
    with pytest.raises(Exception, match="CSV header"):
        scan_zones_csv(spark, str(path), enforce_schema=False).collect()


def _typed_parquet(spark, trips_csv, path, **replaced):
    raw = scan_trips_csv(spark, trips_csv).drop(SOURCE_PATH)
    raw.withColumns(replaced).withColumnRenamed("airport_fee", "Airport_fee").write.parquet(path)
    return path


def test_parquet_scan_normalizes_names_and_types(spark, trips_csv, tmp_path):
    path = _typed_parquet(
        spark,
        trips_csv,
        str(tmp_path / "m.parquet"),
        VendorID=F.col("VendorID").cast("int"),
        passenger_count=F.col("passenger_count").cast("double"),
        tpep_pickup_datetime=F.to_timestamp_ntz("tpep_pickup_datetime"),
        _source_file_path=F.lit("stale"),
        bonus=F.lit(7),
    )
    df = scan_trips_parquet(spark, path)
    assert {type(f.dataType) for f in df.schema} == {StringType}
    assert "airport_fee" in df.columns and "Airport_fee" not in df.columns
    row = df.filter("PULocationID = '41'").first()
    assert (row["VendorID"], row["passenger_count"], row["bonus"]) == ("2", "2.0", "7")
    assert row["tpep_pickup_datetime"] == "2024-01-01 06:40:00"
    assert row[SOURCE_PATH] != "stale" and ".parquet" in row[SOURCE_PATH]
    assert df.columns[-1] == SOURCE_PATH


def test_parquet_files_of_different_types_unite(spark, trips_csv, tmp_path):
    first = _typed_parquet(spark, trips_csv, str(tmp_path / "a"), VendorID=F.col("VendorID").cast("int"))
    second = _typed_parquet(spark, trips_csv, str(tmp_path / "b"), VendorID=F.col("VendorID").cast("double"), x=F.lit(1))
    df = scan_trips_parquet(spark, first, second)
    assert df.count() == 10
    assert {r[0] for r in df.select("VendorID").distinct().collect()} == {"1", "2", "1.0", "2.0"}
    assert df.filter("x IS NULL").count() == 5


def test_files_of_one_folder_keep_their_types_and_share_scans_by_schema(spark, trips_csv, tmp_path):
    folder = tmp_path / "mixed"
    raw = scan_trips_csv(spark, trips_csv).drop(SOURCE_PATH)
    variants = (
        {"passenger_count": F.col("passenger_count").cast("int")},
        {"passenger_count": F.col("passenger_count").cast("double")},
        {"tpep_pickup_datetime": F.to_timestamp_ntz("tpep_pickup_datetime")},
    )
    for round_ in range(3):
        for replaced in variants:
            raw.withColumns(replaced).coalesce(1).write.mode("append").parquet(str(folder))
    (folder / "_notes").mkdir()
    (folder / "_notes" / "x.parquet").write_text("not parquet", encoding="utf-8")
    assert sorted(len(files) for _, _, files in schema_groups(spark, str(folder))) == [3, 3, 3]
    df = scan_trips_parquet(spark, str(folder))
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 3
    assert df.count() == 45
    counts = {r["passenger_count"]: r["count"] for r in df.groupBy("passenger_count").count().collect()}
    # Text in the first and third variant: three files of ints, three of text, three of doubles.
    assert counts == {"1": 12, "2": 6, "3": 6, "4": 6, "1.0": 6, "2.0": 3, "3.0": 3, "4.0": 3}
    assert {r[0] for r in df.select("tpep_pickup_datetime").distinct().collect()} == {r[0] for r in raw.select("tpep_pickup_datetime").collect()}


def test_many_paths_are_one_scan_where_their_schema_is_one(spark, trips_csv, tmp_path):
    paths = [_typed_parquet(spark, trips_csv, str(tmp_path / f"m{i}"), VendorID=F.col("VendorID").cast("int" if i % 2 else "bigint")) for i in range(8)]
    df = scan_trips_parquet(spark, *paths)
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2 and df.count() == 40
    glob = scan_trips_parquet(spark, str(tmp_path / "m[0-3]"))
    assert glob.count() == 20 and glob.select(SOURCE_PATH).distinct().count() == 4


def test_directory_columns_are_read(spark, trips_csv, tmp_path):
    path = str(tmp_path / "parted")
    scan_trips_csv(spark, trips_csv).drop(SOURCE_PATH).withColumn("hvfhs", F.col("VendorID")).write.partitionBy("hvfhs").parquet(path)
    assert {(r["hvfhs"], r["VendorID"]) for r in scan_trips_parquet(spark, path).collect()} == {("1", "1"), ("2", "2")}


def test_parquet_without_a_contract_column_is_rejected(spark, trips_csv, tmp_path):
    path = str(tmp_path / "short")
    scan_trips_csv(spark, trips_csv).drop("fare_amount", "extra").write.parquet(path)
    with pytest.raises(ValueError, match=r"\['extra', 'fare_amount'\]"):
        scan_trips_parquet(spark, path)


def test_rename_keeps_the_contract_spelling_if_present(spark):
    both = spark.range(1).select(F.lit(1).alias("airport_fee"), F.lit(2).alias("other"))
    assert rename_drifted(both, {"other": "airport_fee"}).columns == ["airport_fee", "other"]
    assert rename_drifted(both, {"other": "fee"}).columns == ["airport_fee", "fee"]


def test_dispatch_by_format(spark, trips_csv, tmp_path):
    assert scan_trips(spark, SourceSpec(trips_csv, "csv", "sample")).count() == 5
    path = _typed_parquet(spark, trips_csv, str(tmp_path / "p"))
    assert scan_trips(spark, SourceSpec(path, "parquet", "tlc")).count() == 5
    with pytest.raises(ValueError, match="json"):
        scan_trips(spark, SourceSpec(path, "json", "tlc"))


def test_empty_dataset_reads_with_schema(spark, tmp_path):
    path = str(tmp_path / "empty")
    spark.range(0).selectExpr("id", "id AS p").write.partitionBy("p").parquet(path)
    assert scan_dataset(spark, path, spark.range(0).schema).count() == 0


def test_sample_and_zone_specs():
    sample = trip_source("/data")
    assert (sample.source, sample.file_format, sample.period, sample.unit, sample.url) == ("sample", "csv", None, "sample", None)
    zones = zone_source("/data")
    assert zones.path == "/data/taxi_zone_lookup.csv" and zones.url.endswith("/misc/taxi_zone_lookup.csv")


def test_monthly_spec():
    spec = trip_source("/data", source="tlc", year=2024, month=1)
    assert (spec.path, spec.file_format, spec.period, spec.unit) == ("/data/yellow_tripdata_2024-01.parquet", "parquet", (2024, 1), "tlc-2024-01")
    assert spec.url.endswith("/yellow_tripdata_2024-01.parquet")


@pytest.mark.parametrize("month", [0, 13])
def test_month_has_to_exist(month):
    with pytest.raises(ValueError, match="between 1 and 12"):
        trip_source("/data", source="tlc", month=month)


def test_other_years_and_sources_are_rejected():
    with pytest.raises(ValueError, match="Only 2024"):
        trip_source("/data", source="tlc", year=2025)
    with pytest.raises(ValueError, match="unknown trip source"):
        trip_source("/data", source="green")


def test_availability(spark, tmp_path):
    spec = SourceSpec(str(tmp_path / "f.parquet"), "parquet", "tlc", url="http://example.invalid/f")
    assert not has_data(spark, spec.path)
    with pytest.raises(FileNotFoundError):
        ensure_available(spark, spec)
    calls = []

    def fetch(url, path):
        calls.append((url, path))
        (tmp_path / "f.parquet").write_bytes(b"payload")

    assert ensure_available(spark, spec, fetch=fetch) == spec
    assert calls == [(spec.url, spec.path)]
    assert has_data(spark, spec.path)

    def never(url, path):
        raise AssertionError("present input must not be fetched again")

    assert ensure_available(spark, spec, fetch=never) == spec


def test_empty_file_is_not_available(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    spec = SourceSpec(str(tmp_path / "empty.csv"), "csv", "sample")
    with pytest.raises(FileNotFoundError):
        ensure_available(spark, spec)
    with pytest.raises(RuntimeError):
        ensure_available(spark, SourceSpec(spec.path, "csv", "x", url="u"), fetch=lambda url, path: None)


def test_hidden_files_are_no_data(spark, tmp_path):
    folder = tmp_path / "d"
    (folder / "deep").mkdir(parents=True)
    (folder / "_SUCCESS").write_bytes(b"x")
    (folder / ".part.crc").write_bytes(b"x")
    (folder / "empty").write_bytes(b"")
    assert not has_data(spark, str(folder))
    (folder / "deep" / "part").write_bytes(b"x")
    assert has_data(spark, str(folder)) and has_data(spark, f"{tmp_path}/*")


def test_listed_bytes_are_those_of_the_scan(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone,service_zone\n1,a,b,c\n", encoding="utf-8")
    assert listed_bytes(scan_zones_csv(spark, str(tmp_path / "z.csv"))) == (tmp_path / "z.csv").stat().st_size
