"""Zone enrichment: a left join that keeps every trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.contracts import VALID_TRIP_COLUMNS, require_columns
from assayer.functions import or_unknown

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
_ATTRIBUTES = ("borough", "zone", "service_zone")


def text_bytes(df: DataFrame) -> Column:
    """Upper estimate of a frame's size, as an aggregate: the text of every value and a fixed share per row and column."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    return F.coalesce(F.sum(width + F.lit(16 * (1 + len(df.columns)))), F.lit(0))


def attach_zone(df: DataFrame, zones: DataFrame, *, key: str = "pickup_location_id", broadcast: bool | None = None) -> DataFrame:
    """``df`` plus three zone attributes (``Unknown`` where absent) and ``_zone_lookup_matched``.

    The flag comes from the key, so a matched zone with NULL attributes still counts as matched. ``broadcast`` is the
    decision of a caller that knows the size of ``zones``: True broadcasts them, False sort-merge joins, and None leaves
    it to Spark's own statistics. No job runs here.
    """
    lookup = zones.select("location_id", *_ATTRIBUTES)
    if broadcast is not None:
        lookup = lookup.hint("broadcast" if broadcast else "merge")
    lookup = lookup.alias("zone_side")
    rows = df.alias("row_side")
    return rows.join(lookup, F.col(f"row_side.{key}") == F.col("zone_side.location_id"), "left").select(
        "row_side.*",
        *[or_unknown(F.col(f"zone_side.{name}")).alias(f"pickup_{name}") for name in _ATTRIBUTES],
        F.col("zone_side.location_id").isNotNull().alias("_zone_lookup_matched"),
    )


def enrich_trips(valid_trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Row-level enrichment of valid trips. Check the zone key first: a repeated key multiplies trips."""
    return attach_zone(require_columns(valid_trips, VALID_TRIP_COLUMNS, "valid trips"), zones)


def unmatched_trips(enriched: DataFrame) -> DataFrame:
    return enriched.filter(~F.col("_zone_lookup_matched"))
