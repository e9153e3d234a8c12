"""Scans. All of them are lazy; only the schema and the file listing are touched up front."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.contracts import (
    DRIFT_RENAMES,
    SOURCE_PATH,
    TRIP_COLUMNS,
    TRIP_SCHEMA,
    ZONE_SCHEMA,
    require_columns,
)
from assayer.functions import to_text
from assayer.sources.specs import SourceSpec
from assayer.sources.storage import path_exists, visible_files


def _require_path(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"nothing to read at {path}")
    return path


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, *, enforce_schema: bool = True) -> DataFrame:
    """Header CSV under a fixed all-string schema, failing on malformed rows, plus the source file path.

    Columns are matched by position. ``enforce_schema=False`` makes Spark compare the header names too.
    Malformed rows are only noticed when the columns are read, so write the scan before trusting a count.
    """
    reader = (
        spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", enforce_schema)
    )
    return reader.csv(_require_path(spark, path)).withColumn(SOURCE_PATH, F.col("_metadata.file_path"))


def scan_trips_csv(spark: SparkSession, path: str, *, enforce_schema: bool = True) -> DataFrame:
    return scan_csv(spark, path, TRIP_SCHEMA, enforce_schema=enforce_schema)


def scan_zones_csv(spark: SparkSession, path: str, *, enforce_schema: bool = True) -> DataFrame:
    return scan_csv(spark, path, ZONE_SCHEMA, enforce_schema=enforce_schema)


def rename_drifted(df: DataFrame, renames: dict[str, str] = DRIFT_RENAMES) -> DataFrame:
    """Rename known variant spellings, each only while the contract's own spelling is absent."""
    present = set(df.columns)
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in present and new not in present})


def all_to_text(df: DataFrame) -> DataFrame:
    """Every column as string, extras included."""
    return df.select([to_text(name).alias(name) for name in df.columns])


#: Footers asked for at a time; each is read by a task of its own.
FOOTERS_AT_ONCE = 16


def schema_groups(spark: SparkSession, *paths: str) -> list[tuple[T.StructType, str | None, list[str]]]:
    """The parquet files at the paths, grouped by physical schema and base directory: (schema, base, files).

    Each footer is read once, in a task. Files of a group can be read in one scan; those of different groups may not agree
    in the type or the spelling of a column, also within one folder.
    """
    files = [file for path in paths for file in visible_files(spark, _require_path(spark, path))]
    if not files:
        raise FileNotFoundError(f"no parquet file at {', '.join(paths)}")

    def footer(file: tuple[str, str | None]) -> T.StructType:
        return _based(spark, file[1]).parquet(file[0]).schema

    groups: dict[tuple[str, str | None], tuple[T.StructType, str | None, list[str]]] = {}
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        for (file, base), schema in zip(files, pool.map(inheritable_thread_target(spark)(footer), files), strict=True):
            # Only a directory that names partition columns matters to the reader.
            base = base if base and "=" in file[len(base) :] else None
            groups.setdefault((schema.simpleString(), base), (schema, base, []))[2].append(file)
    return list(groups.values())


def _based(spark: SparkSession, base: str | None) -> DataFrameReader:
    return spark.read.option("basePath", base) if base else spark.read


def scan_trips_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet trips as strings plus a fresh source path. Files of all paths are united by column name.

    Monthly files differ in physical types, so each file keeps its own schema; files that share one are one scan.
    """
    scans = [_scan_group(_based(spark, base).schema(schema).parquet(*files), files[0]) for schema, base, files in schema_groups(spark, *paths)]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), scans)


def _scan_group(scan: DataFrame, first: str) -> DataFrame:
    # The hidden metadata column must be taken before the first projection hides it.
    located = scan.withColumn(SOURCE_PATH, F.col("_metadata.file_path"))
    trips = require_columns(rename_drifted(located), TRIP_COLUMNS, f"trip parquet {first}")
    ordered = [c for c in trips.columns if c != SOURCE_PATH] + [SOURCE_PATH]
    return all_to_text(trips.select(*[f"`{c}`" for c in ordered]))


def scan_trips(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Scan trips in the format the spec declares."""
    if spec.file_format == "csv":
        return scan_trips_csv(spark, spec.path)
    if spec.file_format == "parquet":
        return scan_trips_parquet(spark, spec.path)
    raise ValueError(f"cannot read trips in format {spec.file_format!r}")


def scan_dataset(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Existing parquet dataset with partition discovery. With ``schema``, an empty dataset reads too."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(_require_path(spark, path))
