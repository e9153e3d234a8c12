"""Per-trip scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.contracts import ERROR_TEXT_LIMIT, UNKNOWN


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps in minutes; negative when ``end`` comes first."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def per_unit(amount: Column, units: Column) -> Column:
    """``amount / units`` as double where units is positive, otherwise NULL."""
    return F.when(units > 0, amount.cast("double") / units)


def or_unknown(attribute: Column) -> Column:
    return F.coalesce(attribute, F.lit(UNKNOWN))


def cut_error(text: Column) -> Column:
    return F.substring(text, 1, ERROR_TEXT_LIMIT)
