"""Scalar column functions."""

from assayer.functions.casts import cast_text, to_double, to_instant, to_int, to_money, to_text
from assayer.functions.trip_math import cut_error, minutes_between, or_unknown, per_unit

__all__ = [
    "cast_text",
    "cut_error",
    "minutes_between",
    "or_unknown",
    "per_unit",
    "to_double",
    "to_instant",
    "to_int",
    "to_money",
    "to_text",
]
