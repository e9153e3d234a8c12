"""Validation rules as data: a reason name and the SQL condition that breaks the row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``broken_when`` is SQL text; a NULL outcome does not break the row."""

    reason: str
    broken_when: str

    @property
    def broken_sql(self) -> str:
        return f"coalesce({self.broken_when}, false)"

    def broken(self) -> Column:
        return F.expr(self.broken_sql)


# Reason names and their order.
TRIP_RULES: tuple[Rule, ...] = (
    Rule("invalid_pickup_timestamp", "pickup_timestamp IS NULL"),
    Rule("invalid_dropoff_timestamp", "dropoff_timestamp IS NULL"),
    Rule("dropoff_not_after_pickup", "dropoff_timestamp <= pickup_timestamp"),
    Rule("non_positive_trip_distance", "coalesce(trip_distance, 0e0) <= 0e0"),
    Rule("invalid_fare_amount", "coalesce(fare_amount, -1) < 0"),
    Rule("invalid_total_amount", "coalesce(total_amount, -1) < 0"),
    Rule("missing_pickup_location", "pickup_location_id IS NULL"),
    Rule("missing_dropoff_location", "dropoff_location_id IS NULL"),
)


def broken_reasons(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules in rule order, empty when none is broken.

    Built from array concatenation, which stays inside generated code; filtering an array with a lambda does not.
    """
    named = [f"CASE WHEN {r.broken_when} THEN array('{r.reason}') ELSE cast(array() AS array<string>) END" for r in rules]
    return F.expr(f"concat({', '.join(named)})")


def no_rule_broken(rules: Sequence[Rule]) -> Column:
    return F.expr(" AND ".join(f"NOT {rule.broken_sql}" for rule in rules))


def tag_rows(df: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """Add ``_invalid_reasons`` and ``is_valid`` (true exactly when no rule is broken, never NULL).

    ``is_valid`` is a plain conjunction, so a filter on it stops at the first broken rule and builds no array.
    """
    return df.withColumns({"_invalid_reasons": broken_reasons(rules), "is_valid": no_rule_broken(rules)})


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("is_valid"))


def invalid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(~F.col("is_valid"))


def split_rows(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): together exactly the input."""
    return valid_rows(tagged), invalid_rows(tagged)


def reason_counts(tagged: DataFrame) -> DataFrame:
    """Rows per broken rule; a row with several reasons counts once under each."""
    return (
        tagged.select(F.explode("_invalid_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("row_count"))
    )
