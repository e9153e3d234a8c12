"""Which months of a dataset its consumer has yet to take over: empty marker files beside the data.

Marks are put before the data change and taken away after the consumer has committed, so a run that fails in between
leaves them to the next. A mark is a file of its own: those set after a consumer looked stay.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from uuid import uuid4

from pyspark.sql import SparkSession

from assayer.sources.storage import claim, names_below, remove

Month = tuple[int, int]
Marks = Mapping[Month, list[str]]


def month_name(month: Month) -> str:
    return "m{:04d}-{:02d}".format(*month)


def month_of(name: str) -> Month:
    return int(name[1:5]), int(name[6:8])


def _below(dataset: str) -> str:
    # Spark leaves out what starts with an underscore.
    return f"{dataset}/_changed"


def mark(spark: SparkSession, dataset: str, months: Iterable[Month]) -> None:
    """Note that these months are about to change."""
    for month in months:
        claim(spark, f"{_below(dataset)}/{month_name(month)}/{uuid4().hex}")


def marked(spark: SparkSession, dataset: str) -> Marks:
    """The marked months with the paths of their marks."""
    names = names_below(spark, _below(dataset))
    found = {month_of(name): [f"{_below(dataset)}/{name}/{m}" for m in names_below(spark, f"{_below(dataset)}/{name}") if not m.startswith(".")] for name in names}
    return {month: paths for month, paths in found.items() if paths}


def clear(spark: SparkSession, marks: Marks, months: Iterable[Month]) -> None:
    """Take away the marks of these months that were seen."""
    for month in months:
        for path in marks.get(month, ()):
            remove(spark, path)
