"""Text-to-type casts that give NULL on bad input whatever the session's ANSI flag says.

Each cast is one SQL expression over a named column, so building a wide projection stays cheap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.contracts import MONEY_TYPE, TIMESTAMP_PATTERN

# Only text with a point is matched against patterns. The expressions are kept short on purpose: the silver
# projection holds many of them, and a generated method that grows too long is not compiled by the JVM.
_INT = r"""try_cast(CASE
    WHEN contains({x}, '.') AND {x} RLIKE r'^\s*[+-]?\d+\.\d*\s*$' THEN substring_index({x}, '.', 1)
    WHEN contains({x}, '.') AND {x} RLIKE r'^\s*[+-]?\.\d*\s*$' THEN '0'
    ELSE {x} END AS int)"""

# Text that begins with an ASCII letter is no number and no time. A cast finds that out by an exception, which costs more
# than all other casts of the row; two comparisons of bytes do not.
_WORD = "{x} >= 'A' AND {x} < '{{'"

# Text of exactly the padded shape goes through the plain cast, which is much cheaper than the pattern parser
# and reads that shape alike. The parser decides about everything else.
_TIMESTAMP = (
    r"CASE WHEN {x} RLIKE r'^\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}:\d{{2}}:\d{{2}}\z' THEN try_cast({x} AS timestamp)"
    f" WHEN {_WORD} THEN NULL ELSE try_to_timestamp({{x}}, '{TIMESTAMP_PATTERN}') END"
)

CAST_SQL: dict[str, str] = {
    "int": _INT,
    "double": "try_cast({x} AS double)",
    "money": f"CASE WHEN {{x}} = '' OR {_WORD} THEN NULL ELSE try_cast({{x}} AS {MONEY_TYPE}) END",
    "timestamp": _TIMESTAMP,
    "string": "cast({x} AS string)",
}


def cast_text(column: str, kind: str) -> Column:
    """The named text column as ``kind``, one of ``CAST_SQL``."""
    return F.expr(CAST_SQL[kind].format(x=f"`{column}`"))


def to_int(column: str) -> Column:
    """Integer, dropping a decimal fraction: ``'1.0'`` gives 1, ``'1e3'`` and ``'x'`` give NULL."""
    return cast_text(column, "int")


def to_double(column: str) -> Column:
    return cast_text(column, "double")


def to_money(column: str) -> Column:
    """Decimal with two digits, rounded half up; NULL when it does not fit."""
    return cast_text(column, "money")


def to_instant(column: str) -> Column:
    """Timestamp in the one accepted pattern; fractions, bare dates and impossible dates give NULL."""
    return cast_text(column, "timestamp")


def to_text(column: str) -> Column:
    return cast_text(column, "string")
