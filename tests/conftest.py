from __future__ import annotations

import sys
from datetime import UTC, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from assayer.contracts import TRIP_COLUMNS, ZONE_COLUMNS  # noqa: E402
from assayer.operators.projections import build_silver, with_lineage, zone_dimension  # noqa: E402
from assayer.session import tune_session  # noqa: E402
from assayer.sources import scan_trips_csv, scan_zones_csv  # noqa: E402

# Made up for these tests: two days, three sound trips, one that ends before it starts and one without a distance.
TRIP_LINES = """\
2,2024-01-01 06:40:00,2024-01-01 06:52:00,2,2.40,2,Y,41,57,1,12.6,1.0,0.4,3.1,0.0,0.9,18.0,0.0,0.0
1,2024-01-01 21:03:00,2024-01-01 21:33:00,1,6.50,1,N,58,41,2,24.7,0.5,0.4,0.0,2.5,0.9,29.0,0.0,0.0
1,2024-01-01 11:20:00,2024-01-01 11:13:00,3,4.10,1,N,59,58,1,15.0,0.0,0.4,1.5,0.0,0.9,17.8,0.0,0.0
2,2024-01-02 05:15:00,2024-01-02 05:55:00,1,0.00,3,N,60,62,1,48.0,1.5,0.4,9.0,5.5,0.9,65.3,0.0,1.1
1,2024-01-02 16:45:00,2024-01-02 17:09:00,4,9.60,1,Y,62,57,1,33.6,2.0,0.4,6.7,5.5,0.9,49.1,0.0,1.1
"""
ZONE_LINES = """\
41,Northside,Old Harbour,Inner Ring
57,Northside,Mill Quarter,Inner Ring
58,Northside,Canal Street,Inner Ring
59,Eastbank,Botanic Garden,Outer Ring
60,Eastbank,Observatory Hill,Outer Ring
61,Eastbank,Fair Grounds,Outer Ring
62,Southfield,Airfield Terminal,Airfield
"""
ARRIVAL = datetime(2024, 1, 3, 12, 0, tzinfo=UTC)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("assayer-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune_session(session)
    session.stop()


@pytest.fixture
def ansi(request, spark):
    """Run with the ANSI flag as parametrized, then put it back."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(scope="session")
def trips_csv(tmp_path_factory) -> str:
    path = tmp_path_factory.mktemp("raw") / "trips.csv"
    path.write_text(",".join(TRIP_COLUMNS) + "\n" + TRIP_LINES, encoding="utf-8")
    return str(path)


@pytest.fixture(scope="session")
def zones_csv(tmp_path_factory) -> str:
    path = tmp_path_factory.mktemp("raw") / "zones.csv"
    path.write_text(",".join(ZONE_COLUMNS) + "\n" + ZONE_LINES, encoding="utf-8")
    return str(path)


@pytest.fixture
def bronze(spark, trips_csv):
    return with_lineage(scan_trips_csv(spark, trips_csv), batch_id="batch-1", ingested_at=ARRIVAL)


@pytest.fixture
def silver(bronze):
    return build_silver(bronze)


@pytest.fixture
def zones(spark, zones_csv):
    return zone_dimension(scan_zones_csv(spark, zones_csv))


_GOOD = dict(zip(TRIP_COLUMNS, TRIP_LINES.splitlines()[0].split(","), strict=True))


@pytest.fixture
def bronze_rows(spark):
    """Bronze rows that are valid but for the given changes: ``bronze_rows({...}, {...})``."""

    def build(*changes: dict):
        columns = (*TRIP_COLUMNS, "_source_file_path", "_batch_id", "_ingested_at")
        schema = ", ".join(f"{c} string" for c in columns[:-1]) + ", _ingested_at timestamp"
        base = {**_GOOD, "_source_file_path": "mem", "_batch_id": "b", "_ingested_at": ARRIVAL}
        return spark.createDataFrame([tuple({**base, **change}[c] for c in columns) for change in changes], schema)

    return build
