"""Session settings the jobs are meant to run with. All are runtime settings; none is needed for right results but UTC."""

from __future__ import annotations

from pyspark.sql import SparkSession

SESSION_SETTINGS: dict[str, str] = {
    # Timestamps are parsed and split into date and hour in this zone.
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods beyond this size. Past it, Spark is to generate many small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keep a few partition files open per task instead of sorting every row by partition before a write.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Trips are a few bytes each in parquet and much work to parse: with the usual 4 MB a few million of them keep no more
    # than a handful of cores busy. Splits are still no smaller than a core's share of the input.
    "spark.sql.files.openCostInBytes": "262144",
    # Twelve bytes a timestamp, each hashed for the dictionary, are written at several times the cost of a long.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A union of scans with one task each is to have as many tasks, not one that reads them all: compaction has such unions.
    "spark.sql.unionOutputPartitioning": "false",
}


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session and return it."""
    for name, value in SESSION_SETTINGS.items():
        spark.conf.set(name, value)
    return spark
