"""Source specifications and scans."""

from assayer.sources.readers import (
    all_to_text,
    rename_drifted,
    scan_csv,
    scan_dataset,
    scan_trips,
    scan_trips_csv,
    scan_trips_parquet,
    scan_zones_csv,
    schema_groups,
)
from assayer.sources.specs import SourceSpec, ensure_available, trip_source, zone_source
from assayer.sources.storage import has_data, listed_bytes, path_exists

__all__ = [
    "SourceSpec",
    "all_to_text",
    "ensure_available",
    "has_data",
    "listed_bytes",
    "path_exists",
    "rename_drifted",
    "scan_csv",
    "scan_dataset",
    "scan_trips",
    "scan_trips_csv",
    "scan_trips_parquet",
    "scan_zones_csv",
    "schema_groups",
    "trip_source",
    "zone_source",
]
