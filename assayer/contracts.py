"""Dataset contracts: column lists, schemas and the column-presence check."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---- Fixed values: names, order and texts are part of the data contract. ----

TRIP_COLUMNS: tuple[str, ...] = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
)
ZONE_COLUMNS: tuple[str, ...] = ("LocationID", "Borough", "Zone", "service_zone")
SOURCE_PATH = "_source_file_path"
LINEAGE_COLUMNS: tuple[str, ...] = (SOURCE_PATH, "_batch_id", "_ingested_at")

# Spelling seen in some source files -> spelling of the contract.
DRIFT_RENAMES: dict[str, str] = {"Airport_fee": "airport_fee"}

# Raw column -> (silver column, kind of cast).
SILVER_CASTS: dict[str, tuple[str, str]] = {
    "VendorID": ("vendor_id", "int"),
    "tpep_pickup_datetime": ("pickup_timestamp", "timestamp"),
    "tpep_dropoff_datetime": ("dropoff_timestamp", "timestamp"),
    "passenger_count": ("passenger_count", "int"),
    "trip_distance": ("trip_distance", "double"),
    "RatecodeID": ("rate_code_id", "int"),
    "store_and_fwd_flag": ("store_and_fwd_flag", "string"),
    "PULocationID": ("pickup_location_id", "int"),
    "DOLocationID": ("dropoff_location_id", "int"),
    "payment_type": ("payment_type", "int"),
    "fare_amount": ("fare_amount", "money"),
    "extra": ("extra", "money"),
    "mta_tax": ("mta_tax", "money"),
    "tip_amount": ("tip_amount", "money"),
    "tolls_amount": ("tolls_amount", "money"),
    "improvement_surcharge": ("improvement_surcharge", "money"),
    "total_amount": ("total_amount", "money"),
    "congestion_surcharge": ("congestion_surcharge", "money"),
    "airport_fee": ("airport_fee", "money"),
}
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
MONEY_TYPE = "decimal(12,2)"
UNKNOWN = "Unknown"
CARD_PAYMENT, CASH_PAYMENT = 1, 2

VALID_TRIP_COLUMNS: tuple[str, ...] = (
    "pickup_date",
    "pickup_year",
    "pickup_month",
    "pickup_hour",
    "pickup_location_id",
    "trip_distance",
    "trip_duration_minutes",
    "fare_per_mile",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
    "_batch_id",
    "_ingested_at",
    "is_valid",
)
DAILY_KEYS: tuple[str, ...] = (
    "pickup_date",
    "pickup_year",
    "pickup_month",
    "pickup_location_id",
    "pickup_borough",
    "pickup_zone",
    "pickup_service_zone",
)
HOURLY_KEYS: tuple[str, ...] = ("pickup_date", "pickup_year", "pickup_month", "pickup_hour")
MONTH_PARTITIONS: tuple[str, ...] = ("pickup_year", "pickup_month")

RUN_STATUSES: tuple[str, ...] = ("running", "succeeded", "failed")
ERROR_TEXT_LIMIT = 2000

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "strings": T.ArrayType(T.StringType()),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(12, 2),
    "money_sum": T.DecimalType(22, 2),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


TRIP_SCHEMA = _schema(**dict.fromkeys(TRIP_COLUMNS, "string"))
ZONE_SCHEMA = _schema(**dict.fromkeys(ZONE_COLUMNS, "string"))
SILVER_SCHEMA = _schema(
    **dict(SILVER_CASTS.values()),
    _source_file_path="string",
    _batch_id="string",
    _ingested_at="timestamp",
    pickup_date="date",
    pickup_hour="int",
    pickup_year="int",
    pickup_month="int",
    trip_duration_minutes="double",
    fare_per_mile="double",
    _invalid_reasons="strings",
    is_valid="boolean",
)
_SUMS = dict.fromkeys(("gross_revenue_amount", "fare_revenue_amount", "total_tip_amount"), "money_sum")
_AVERAGES = dict.fromkeys(("avg_trip_distance", "avg_trip_duration_minutes"), "double")
_SHARES_AND_LINEAGE = {
    "card_payment_share": "double",
    "cash_payment_share": "double",
    "source_batch_count": "bigint",
    "latest_source_ingested_at": "timestamp",
}
DAILY_SCHEMA = _schema(
    pickup_date="date",
    pickup_year="int",
    pickup_month="int",
    pickup_location_id="int",
    pickup_borough="string",
    pickup_zone="string",
    pickup_service_zone="string",
    trip_count="bigint",
    **_SUMS,
    **_AVERAGES,
    avg_fare_per_mile="double",
    **_SHARES_AND_LINEAGE,
)
HOURLY_SCHEMA = _schema(
    pickup_date="date",
    pickup_year="int",
    pickup_month="int",
    pickup_hour="int",
    trip_count="bigint",
    distinct_pickup_zones="bigint",
    **_SUMS,
    **_AVERAGES,
    **_SHARES_AND_LINEAGE,
)
RUN_LOG_SCHEMA = _schema(
    run_id="string",
    status="string",
    started_at="timestamp",
    completed_at="timestamp",
    date_from="date",
    date_to="date",
    daily_zone_row_count="bigint",
    hourly_demand_row_count="bigint",
    error_message="string",
    mart_version="bigint",
)


@dataclass(frozen=True)
class MartTable:
    """A published table: ordered columns, key, nullability and CHECK rules (SQL text)."""

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    nullable: frozenset[str]
    checks: dict[str, str] = field(default_factory=dict, hash=False)
    money: tuple[str, ...] = ("gross_revenue_amount", "fare_revenue_amount", "total_tip_amount")
    money_type: str = "decimal(20,2)"

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(c for c in (*self.columns, "publish_run_id", "published_at") if c not in self.nullable)


_SHARE_CHECKS = {
    "card_payment_share_range": "card_payment_share BETWEEN 0 AND 1",
    "cash_payment_share_range": "cash_payment_share BETWEEN 0 AND 1",
}
DAILY_MART = MartTable(
    name="daily_zone_metrics",
    columns=tuple(c for c in DAILY_SCHEMA.names if c not in MONTH_PARTITIONS),
    key=("pickup_date", "pickup_location_id"),
    nullable=frozenset({"total_tip_amount", "avg_trip_distance", "avg_trip_duration_minutes", "avg_fare_per_mile"}),
    checks={"trip_count_non_negative": "trip_count >= 0", **_SHARE_CHECKS},
)
HOURLY_MART = MartTable(
    name="hourly_demand_metrics",
    columns=tuple(c for c in HOURLY_SCHEMA.names if c not in MONTH_PARTITIONS),
    key=("pickup_date", "pickup_hour"),
    nullable=frozenset({"total_tip_amount", "avg_trip_distance", "avg_trip_duration_minutes"}),
    checks={
        "pickup_hour_range": "pickup_hour BETWEEN 0 AND 23",
        "trip_count_non_negative": "trip_count >= 0",
        "distinct_pickup_zones_non_negative": "distinct_pickup_zones >= 0",
        **_SHARE_CHECKS,
    },
)

# ---- End of fixed values. ----

#: Outermost partition of bronze and silver: the source, or the month of a monthly source, a load replaces as a whole.
SOURCE_UNIT = "source_unit"


def require_columns(df: DataFrame, required: Iterable[str], dataset: str) -> DataFrame:
    """Return ``df`` unchanged, or raise naming every absent column. Extra columns are allowed."""
    absent = sorted(set(required).difference(df.columns))
    if absent:
        raise ValueError(f"{dataset} lacks required columns: {absent}")
    return df
