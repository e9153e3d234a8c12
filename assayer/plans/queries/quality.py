"""Data-quality queries, each in its form with violations as rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.contracts import DAILY_MART, HOURLY_MART
from assayer.operators.metrics import gold_input_summary, trip_rollup
from assayer.operators.quality import (
    assert_non_empty,
    assert_unique_non_null_key,
    assert_window_complete,
    constraint_violations,
    duplicate_keys,
    key_report,
    mart_report,
    money_overflow,
)
from assayer.operators.zones import attach_zone
from assayer.plans.queries.registry import Tables, query

_DAY = date(2024, 1, 2)


def _repeated(df: DataFrame) -> DataFrame:
    """The table with the rows of one day staged twice."""
    return df.unionByName(df.filter(F.col("pickup_date") == F.lit(_DAY)))


def _keys_sql(table: str, keys: str) -> str:
    return (
        f"SELECT {keys}, count(*) AS row_count FROM (SELECT {keys} FROM {table} UNION ALL SELECT {keys} FROM {table}"
        f" WHERE pickup_date = DATE '{_DAY}') GROUP BY {keys} HAVING count(*) > 1"
    )


@query("duplicate_daily_keys", _keys_sql("daily", "pickup_date, pickup_location_id"))
def _(t: Tables) -> DataFrame:
    return duplicate_keys(_repeated(t.daily), DAILY_MART.key)


@query("duplicate_hourly_keys", _keys_sql("hourly", "pickup_date, pickup_hour"))
def _(t: Tables) -> DataFrame:
    return duplicate_keys(_repeated(t.hourly), HOURLY_MART.key)


_REPORT = (
    "SELECT '{name}' AS dataset, CAST(sum(n) AS BIGINT) AS row_count,"
    " CAST(coalesce(sum(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_key_rows,"
    " count(CASE WHEN n > 1 THEN 1 END) AS duplicate_keys"
    " FROM (SELECT {key} AS k, count(*) AS n FROM {table} GROUP BY {key})"
)


@query(
    "assert_unique_non_null_key",
    _REPORT.format(name="zones", key="location_id", table="zone_dim")
    + " UNION ALL "
    + _REPORT.format(name="trips", key="pickup_location_id", table="typed"),
)
def _(t: Tables) -> DataFrame:
    """What the check looks at: zones pass, and trips, keyed by location, show both kinds of violation."""
    zones = key_report(t.zones, "location_id").withColumn("dataset", F.lit("zones"))
    return zones.unionByName(key_report(t.silver, "pickup_location_id").withColumn("dataset", F.lit("trips")))


@query("assert_non_empty_zones", "SELECT count(*) AS row_count, count(*) > 0 AS passes FROM zone_dim")
def _(t: Tables) -> DataFrame:
    rows = assert_unique_non_null_key(t.zones, key="location_id", dataset="zone dimension")
    assert_non_empty({"zone dimension": rows})
    return t.zones.limit(1).select(F.lit(rows).cast("bigint").alias("row_count"), F.lit(True).alias("passes"))


@query(
    "assert_non_empty_marts",
    "SELECT (SELECT count(*) FROM daily) AS daily_rows, (SELECT count(*) FROM hourly) AS hourly_rows",
)
def _(t: Tables) -> DataFrame:
    """One mart emptied has to be named; both as they are have to pass."""
    counts = {"daily_rows": t.daily.count(), "hourly_rows": t.hourly.count()}
    try:
        assert_non_empty({**counts, "hourly_rows": t.hourly.limit(0).count()})
    except ValueError as error:
        if "hourly_rows" not in str(error):
            raise
    else:
        raise AssertionError("an empty mart passed")
    assert_non_empty(counts)
    return t.daily.limit(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


@query(
    "assert_unique_mart_keys",
    "SELECT 'daily_zone_metrics' AS table_name, count(*) AS duplicate_keys FROM (SELECT 1 FROM daily"
    " GROUP BY pickup_date, pickup_location_id HAVING count(*) > 1) UNION ALL"
    " SELECT 'hourly_demand_metrics', count(*) FROM (SELECT 1 FROM hourly GROUP BY pickup_date, pickup_hour HAVING count(*) > 1)",
)
def _(t: Tables) -> DataFrame:
    return _duplicate_totals(t.daily, t.hourly)


def _duplicate_totals(daily: DataFrame, hourly: DataFrame) -> DataFrame:
    totals = [
        duplicate_keys(df, table.key).agg(
            F.lit(table.name).alias("table_name"), F.count("*").alias("duplicate_keys")
        )
        for df, table in ((daily, DAILY_MART), (hourly, HOURLY_MART))
    ]
    return totals[0].unionByName(totals[1])


@query(
    "assert_window_complete",
    "SELECT min(pickup_date) AS date_from, max(pickup_date) AS date_to"
    " FROM (SELECT pickup_date FROM daily UNION ALL SELECT pickup_date FROM hourly)",
)
def _(t: Tables) -> DataFrame:
    first, last = assert_window_complete(mart_report(_stamped(t.daily), DAILY_MART), mart_report(_stamped(t.hourly), HOURLY_MART))
    return t.daily.limit(1).select(F.lit(first).alias("date_from"), F.lit(last).alias("date_to"))


def _stamped(gold: DataFrame) -> DataFrame:
    return gold.withColumns({"publish_run_id": F.lit("run-1"), "published_at": F.current_timestamp()})


@query(
    "mart_report",
    f"SELECT 'daily_zone_metrics' AS table_name, (SELECT count(*) FROM ({_keys_sql('daily', 'pickup_date, pickup_location_id')})) AS duplicate_keys,"
    " min(pickup_date) AS date_from, max(pickup_date) AS date_to FROM daily UNION ALL"
    f" SELECT 'hourly_demand_metrics', (SELECT count(*) FROM ({_keys_sql('hourly', 'pickup_date, pickup_hour')})), min(pickup_date), max(pickup_date) FROM hourly",
)
def _(t: Tables) -> DataFrame:
    """The checks of a publish, on marts of which one day is staged twice."""
    reports = [mart_report(_stamped(_repeated(df)), table) for df, table in ((t.daily, DAILY_MART), (t.hourly, HOURLY_MART))]
    if any(report.violations for report in reports):
        raise AssertionError(f"sound rows break constraints: {reports}")
    told = [
        t.daily.limit(1).select(
            F.lit(r.table).alias("table_name"),
            F.lit(r.duplicate_keys).cast("bigint").alias("duplicate_keys"),
            F.lit(r.date_from).alias("date_from"),
            F.lit(r.date_to).alias("date_to"),
        )
        for r in reports
    ]
    return told[0].unionByName(told[1])


# ---- table constraints, on gold rows of which some are spoilt on purpose ----

_LATE = "DATE '2024-01-20'"
_SPOILT_DAILY_SQL = (
    "(SELECT * REPLACE (CASE WHEN pickup_location_id = 3 THEN NULL ELSE pickup_zone END AS pickup_zone,"
    f" CASE WHEN pickup_date > {_LATE} THEN -trip_count ELSE trip_count END AS trip_count,"
    " CASE WHEN pickup_location_id = 4 THEN 1.5e0 ELSE card_payment_share END AS card_payment_share,"
    " CASE WHEN pickup_location_id = 5 THEN NULL ELSE cash_payment_share END AS cash_payment_share) FROM daily)"
)
_SPOILT_HOURLY_SQL = (
    f"(SELECT * REPLACE (CASE WHEN pickup_date > {_LATE} THEN pickup_hour + 20 ELSE pickup_hour END AS pickup_hour,"
    " CASE WHEN pickup_hour = 7 THEN -distinct_pickup_zones ELSE distinct_pickup_zones END AS distinct_pickup_zones)"
    " FROM hourly)"
)


def _spoilt_daily(t: Tables) -> DataFrame:
    location = F.col("pickup_location_id")
    return t.daily.withColumns(
        {
            "pickup_zone": F.when(location != 3, F.col("pickup_zone")),
            "trip_count": F.expr(f"if(pickup_date > {_LATE}, -trip_count, trip_count)"),
            "card_payment_share": F.when(location == 4, 1.5).otherwise(F.col("card_payment_share")),
            "cash_payment_share": F.when(location != 5, F.col("cash_payment_share")),
        }
    )


def _spoilt_hourly(t: Tables) -> DataFrame:
    return t.hourly.withColumns(
        {
            "pickup_hour": F.expr(f"if(pickup_date > {_LATE}, pickup_hour + 20, pickup_hour)"),
            "distinct_pickup_zones": F.expr("if(pickup_hour = 7, -distinct_pickup_zones, distinct_pickup_zones)"),
        }
    )


def _violations_of(t: Tables, wanted: str) -> DataFrame:
    """Violations in both spoilt tables, of the constraints whose name matches."""
    found = constraint_violations(_spoilt_daily(t), DAILY_MART).unionByName(
        constraint_violations(_spoilt_hourly(t), HOURLY_MART)
    )
    return found.filter(F.col("constraint_name").rlike(wanted))


def _count_sql(table: str, relation: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS constraint_name,"
        f" count(*) FILTER (WHERE {broken}) AS violations FROM {relation}"
        for name, broken in rules.items()
    )


def _both(daily_rules: dict[str, str], hourly_rules: dict[str, str]) -> str:
    parts = []
    if daily_rules:
        parts.append(_count_sql("daily_zone_metrics", _SPOILT_DAILY_SQL, daily_rules))
    if hourly_rules:
        parts.append(_count_sql("hourly_demand_metrics", _SPOILT_HOURLY_SQL, hourly_rules))
    return " UNION ALL ".join(parts)


def _nulls(*columns: str) -> dict[str, str]:
    return {f"{c}_not_null": f"{c} IS NULL" for c in columns}


_SHARED_NOT_NULL = (
    "trip_count",
    "gross_revenue_amount",
    "fare_revenue_amount",
    "card_payment_share",
    "cash_payment_share",
    "source_batch_count",
    "latest_source_ingested_at",
)
_SHARES = {
    "card_payment_share_range": "NOT (card_payment_share BETWEEN 0 AND 1)",
    "cash_payment_share_range": "NOT (cash_payment_share BETWEEN 0 AND 1)",
}


@query(
    "constraint_not_null",
    _both(
        _nulls(
            "pickup_date", "pickup_location_id", "pickup_borough", "pickup_zone", "pickup_service_zone", *_SHARED_NOT_NULL
        ),
        _nulls("pickup_date", "pickup_hour", "distinct_pickup_zones", *_SHARED_NOT_NULL),
    ),
)
def _(t: Tables) -> DataFrame:
    return _violations_of(t, "_not_null$")


@query(
    "constraint_non_negative",
    _both(
        {"trip_count_non_negative": "trip_count < 0"},
        {
            "trip_count_non_negative": "trip_count < 0",
            "distinct_pickup_zones_non_negative": "distinct_pickup_zones < 0",
        },
    ),
)
def _(t: Tables) -> DataFrame:
    return _violations_of(t, "_non_negative$")


@query("constraint_share_range", _both(_SHARES, _SHARES))
def _(t: Tables) -> DataFrame:
    return _violations_of(t, "_share_range$")


@query("constraint_hour_range", _both({}, {"pickup_hour_range": "NOT (pickup_hour BETWEEN 0 AND 23)"}))
def _(t: Tables) -> DataFrame:
    return _violations_of(t, "_hour_range$")


@query(
    "constraint_money_fits",
    _count_sql(
        "daily_zone_metrics",
        "(SELECT gross_revenue_amount * 1e15::DECIMAL(20,0) AS g, fare_revenue_amount AS f, total_tip_amount AS t"
        " FROM (SELECT pickup_date, CAST(gross_revenue_amount AS DECIMAL(18,2)) AS gross_revenue_amount,"
        " fare_revenue_amount, total_tip_amount FROM daily))",
        {
            "gross_revenue_amount_fits": "g IS NOT NULL AND TRY_CAST(g AS DECIMAL(20,2)) IS NULL",
            "fare_revenue_amount_fits": "f IS NOT NULL AND TRY_CAST(f AS DECIMAL(20,2)) IS NULL",
            "total_tip_amount_fits": "t IS NOT NULL AND TRY_CAST(t AS DECIMAL(20,2)) IS NULL",
        },
    ),
)
def _(t: Tables) -> DataFrame:
    """Gross amounts blown up so that some leave the mart's money type."""
    blown = t.daily.withColumn(
        "gross_revenue_amount", F.expr("cast(gross_revenue_amount as decimal(18,2)) * cast(1e15 as decimal(20,0))")
    )
    return money_overflow(blown, DAILY_MART)


@query(
    "constraint_primary_keys",
    "SELECT 'daily_zone_metrics' AS table_name, count(*) AS duplicate_keys FROM (" + _keys_sql("daily", "pickup_date, pickup_location_id") + ")"
    " UNION ALL SELECT 'hourly_demand_metrics', count(*) FROM (" + _keys_sql("hourly", "pickup_date, pickup_hour") + ")",
)
def _(t: Tables) -> DataFrame:
    return _duplicate_totals(_repeated(t.daily), _repeated(t.hourly))


@query(
    "reconcile_counts",
    "SELECT (SELECT count(*) FROM valid) AS valid_trip_count, (SELECT CAST(sum(trip_count) AS BIGINT) FROM daily)"
    " AS daily_trips, (SELECT CAST(sum(trip_count) AS BIGINT) FROM hourly) AS hourly_trips",
)
def _(t: Tables) -> DataFrame:
    """One pass per table, joined on nothing: three one-row frames stacked and folded."""
    summary = gold_input_summary(attach_zone(trip_rollup(t.valid), t.zones))
    parts = [
        summary.select(F.lit("valid_trip_count").alias("name"), F.col("valid_trip_count").alias("n")),
        t.daily.agg(F.lit("daily_trips").alias("name"), F.sum("trip_count").alias("n")),
        t.hourly.agg(F.lit("hourly_trips").alias("name"), F.sum("trip_count").alias("n")),
    ]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    names = ("valid_trip_count", "daily_trips", "hourly_trips")
    return stacked.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in names])
