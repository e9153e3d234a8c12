"""Parquet sinks. Row counts are taken while writing, so nothing is cached or computed twice."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from assayer.contracts import MONTH_PARTITIONS, SOURCE_UNIT
from assayer.operators.rules import invalid_rows, valid_rows
from assayer.sources.storage import remove

UNIT_NAME = re.compile(r"[A-Za-z0-9_.-]+")


def overwrite(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] | None = None,
    replace: str = "all",
    measures: Mapping[str, Column] | None = None,
    convert: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
) -> dict[str, Any]:
    """Write ``df`` to ``path`` and return ``rows`` plus any extra ``measures``.

    Measures look at ``df``; after that columns in ``convert`` are replaced and those in ``drop`` left out.

    ``replace='all'`` replaces the dataset; ``replace='partitions'`` only those partitions ``df`` has rows for, and
    ``replace='nothing'`` adds to what is there.
    The measures are observed in the writing stage itself: each of its tasks counts once, also when lost
    executors make Spark run tasks again.
    """
    if replace not in ("all", "partitions", "nothing"):
        raise ValueError(f"replace has to be 'all', 'partitions' or 'nothing', not {replace!r}")
    if partition_by is not None and not partition_by:
        raise ValueError("partition_by needs at least one column")
    if replace == "partitions" and partition_by is None:
        raise ValueError("replacing partitions needs partition_by")
    unknown = sorted(set(partition_by or ()) - set(df.columns))
    if unknown:
        raise ValueError(f"partition columns not in the frame: {unknown}")
    seen = Observation()
    columns = {"rows": F.count(F.lit(1)), **(measures or {})}
    observed = df.observe(seen, *[c.alias(name) for name, c in columns.items()])
    writer = observed.withColumns(dict(convert or {})).drop(*drop).write.mode("append" if replace == "nothing" else "overwrite")
    if partition_by:
        mode = "dynamic" if replace == "partitions" else "static"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", mode)
    writer.parquet(path)
    return seen.get


def gathered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of one output partition together, letting adaptive execution split those that are too big."""
    return df.hint("rebalance", *columns)


def overwrite_by_month(
    df: DataFrame,
    path: str,
    *,
    months: Sequence[tuple[int, int]] | None = None,
    measures: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
) -> dict[str, Any]:
    """Gold sink: one small set of files per month.

    With ``months``, given as (year, month), exactly these are replaced; ``df`` has rows of no others. A month it has no
    row for is emptied.
    """
    replace = "all" if months is None else "partitions"
    seen = {} if months is None else {f"month_{y}_{m}": F.count_if((F.col("pickup_year") == y) & (F.col("pickup_month") == m)) for y, m in months}
    written = overwrite(gathered(df, MONTH_PARTITIONS), path, partition_by=MONTH_PARTITIONS, replace=replace, measures={**seen, **(measures or {})}, drop=drop)
    for year, month in months or ():
        if not written[f"month_{year}_{month}"]:
            remove(df.sparkSession, f"{path}/pickup_year={year}/pickup_month={month}")
    return written


def overwrite_gold_pair(
    daily: DataFrame, hourly: DataFrame, daily_path: str, hourly_path: str, *, months: Sequence[tuple[int, int]] | None = None
) -> tuple[int, int]:
    return tuple(overwrite_by_month(df, path, months=months)["rows"] for df, path in ((daily, daily_path), (hourly, hourly_path)))


def silver_layout(tagged: DataFrame) -> DataFrame:
    """The directory columns of silver: the side, and for valid rows the month of the pickup.

    Invalid rows are few and any of their columns may be missing, so they have one directory.
    """
    valid = F.col("is_valid")
    # A formatter is asked only for years that are not four digits: it costs as much as several casts.
    year, month = F.col("pickup_year"), F.col("pickup_month")
    padded = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"))
    month = F.when(year.between(0, 9999), padded).otherwise(F.format_string("%04d-%02d", year, month))
    return tagged.withColumns(
        {"row_set": F.when(valid, "valid").otherwise("invalid"), "row_month": F.when(valid, F.concat(F.lit("m"), month)).otherwise("all")}
    )


def overwrite_silver(tagged: DataFrame, path: str, *, unit: str | None = None) -> dict[str, int]:
    """Write valid and invalid rows in one pass, below a directory for each source unit.

    With ``unit`` exactly what that unit wrote before is replaced, its valid and its invalid rows together, also where
    one side is now empty. Without it the whole dataset is; ``tagged`` may carry ``source_unit``. One scan, one cast,
    no shuffle and no cache. Read either side back with ``read_silver``.
    """
    whole = unit is None
    if whole and SOURCE_UNIT not in tagged.columns:
        tagged = tagged.withColumn(SOURCE_UNIT, F.lit("all"))
    return overwrite(
        silver_layout(tagged),
        path if whole else unit_path(path, unit),
        partition_by=(*((SOURCE_UNIT,) if whole else ()), "row_set", "row_month"),
        measures={"valid_rows": F.count_if(F.col("is_valid")), "invalid_rows": F.count_if(~F.col("is_valid"))},
    )


def unit_path(path: str, unit: str) -> str:
    """The directory of one source unit of a bronze or silver dataset."""
    if not UNIT_NAME.fullmatch(unit):
        raise ValueError(f"a source unit is made of letters, digits, '-', '_' and '.': {unit!r}")
    return f"{path}/{SOURCE_UNIT}={unit}"


def overwrite_silver_pair(tagged: DataFrame, valid_path: str, invalid_path: str) -> tuple[int, int]:
    """Two separate datasets, valid by month and invalid flat. Evaluates ``tagged`` once per dataset."""
    valid = overwrite(valid_rows(tagged), valid_path, partition_by=MONTH_PARTITIONS)["rows"]
    return valid, overwrite(invalid_rows(tagged), invalid_path)["rows"]
