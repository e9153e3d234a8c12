"""Data-quality operators. Each check has a frame form (violations as rows) and a raising form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from assayer.contracts import RUN_STATUSES, MartTable


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("row_count"))


def null_keys(df: DataFrame, key: str) -> DataFrame:
    return key_counts(df, key).filter(F.col(key).isNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def key_report(df: DataFrame, key: str, **measures: Column) -> DataFrame:
    """One row: total rows, rows with NULL key, repeated keys, and the totals of further sums over ``df``."""
    found = F.col("row_count")
    counts = df.groupBy(key).agg(F.count("*").alias("row_count"), *[m.alias(name) for name, m in measures.items()])
    return counts.agg(
        F.coalesce(F.sum(found), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), found)), F.lit(0)).alias("null_key_rows"),
        F.count_if(found > 1).alias("duplicate_keys"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in measures],
    )


def assert_unique_non_null_key(df: DataFrame, *, key: str, dataset: str) -> int:
    """Raise on an absent key column, else on NULL keys, else on repeated keys. Returns the row count; one job."""
    return checked_key(df, key=key, dataset=dataset)["row_count"]


def checked_key(df: DataFrame, *, key: str, dataset: str, **measures: Column) -> Row:
    """The checks of ``assert_unique_non_null_key`` and further sums over ``df``, all in one job."""
    if key not in df.columns:
        raise ValueError(f"{dataset} is missing its key column {key}")
    report = key_report(df, key, **measures).first()
    if report["null_key_rows"]:
        raise ValueError(f"{dataset} has null values in key {key}")
    if report["duplicate_keys"]:
        raise ValueError(f"{dataset} has duplicate values in key {key}")
    return report


def assert_non_empty(counts: dict[str, int]) -> None:
    """Raise naming the datasets that have no row."""
    empty = sorted(name for name, count in counts.items() if count == 0)
    if empty:
        raise ValueError(f"at least one row is needed in: {empty}")


def assert_unique_mart_keys(*reports: MartReport) -> None:
    repeated = [report.table for report in reports if report.duplicate_keys]
    if repeated:
        raise ValueError(f"staged rows have duplicate keys in: {repeated}")


def assert_window_complete(*reports: MartReport) -> tuple[date, date]:
    """First and last date over all reports; raise when there is none."""
    starts = [report.date_from for report in reports if report.date_from]
    ends = [report.date_to for report in reports if report.date_to]
    if not starts or not ends:
        raise ValueError("staged rows have no complete date range")
    return min(starts), max(ends)


def _constraint_counts(df: DataFrame, table: MartTable) -> dict[str, Column]:
    """Violations per NOT NULL and CHECK rule. As in SQL, a CHECK whose outcome is NULL passes."""
    counts = {f"{c}_not_null": F.count_if(F.col(c).isNull()) for c in table.not_null if c in df.columns}
    return counts | {name: F.count_if(~F.expr(rule)) for name, rule in table.checks.items()}


def overflow_counts(table: MartTable) -> dict[str, Column]:
    """Amounts per money column that do not fit the mart's money type."""
    return {
        f"{c}_fits": F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(table.money_type).isNull()) for c in table.money
    }


def constraint_violations(df: DataFrame, table: MartTable) -> DataFrame:
    """(table_name, constraint_name, violations) for NOT NULL and CHECK rules, counted in one pass.

    NOT NULL is checked on the columns ``df`` has.
    """
    return _as_rows(df, table.name, _constraint_counts(df, table))


def money_overflow(df: DataFrame, table: MartTable) -> DataFrame:
    """(table_name, constraint_name, violations) for amounts that do not fit the mart's money type."""
    return _as_rows(df, table.name, overflow_counts(table))


def status_violations(run_log: DataFrame) -> DataFrame:
    outside = ~F.col("status").isin(*RUN_STATUSES)
    return _as_rows(run_log, "run_log", {"status_domain": F.count_if(outside)})


def _as_rows(df: DataFrame, table_name: str, counts: dict[str, Column]) -> DataFrame:
    totals = df.agg(*[column.alias(name) for name, column in counts.items()])
    return totals.unpivot([], list(counts), "constraint_name", "violations").select(
        F.lit(table_name).alias("table_name"), "constraint_name", "violations"
    )


@dataclass(frozen=True)
class MartReport:
    """What a publish has to know about one staged table."""

    table: str
    duplicate_keys: int
    date_from: date | None
    date_to: date | None
    violations: dict[str, int]


def mart_report(staged: DataFrame, table: MartTable) -> MartReport:
    """Key, date-range and constraint checks of a staged table in one job with one shuffle, on the table's key."""
    counts = _constraint_counts(staged, table)
    per_key = staged.groupBy(*table.key).agg(
        F.count("*").alias("key_rows"), *[column.alias(name) for name, column in counts.items()]
    )
    found = per_key.agg(
        F.count_if(F.col("key_rows") > 1).alias("duplicate_keys"),
        F.min("pickup_date").alias("date_from"),
        F.max("pickup_date").alias("date_to"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
    ).first()
    return MartReport(
        table=table.name,
        duplicate_keys=found["duplicate_keys"],
        date_from=found["date_from"],
        date_to=found["date_to"],
        violations={name: found[name] for name in counts if found[name]},
    )


def assert_constraints(table: str, violations: Mapping[str, int]) -> None:
    """Raise naming every constraint with violations."""
    broken = ", ".join(f"{name} ({count} rows)" for name, count in sorted(violations.items()) if count)
    if broken:
        raise ValueError(f"{table} breaks {broken}")


def assert_reconciled(valid_trip_count: int, totals: Mapping[str, int]) -> None:
    """Raise unless the trips of each table add up to the number of valid trips."""
    for name, total in totals.items():
        if total != valid_trip_count:
            raise ValueError(f"{name} covers {total} trips, expected {valid_trip_count}")


def reconcile(valid_trip_count: int, **marts: DataFrame) -> None:
    """The same for frames, whose trips are summed up here."""
    for name, mart in marts.items():
        assert_reconciled(valid_trip_count, {name: mart.agg(F.coalesce(F.sum("trip_count"), F.lit(0))).first()[0]})
