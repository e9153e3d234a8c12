"""The run log of publishes: one small file for each event, and checkpoints of what they add up to.

Layout below the mart root::

    run_log/<token>.json            one event
    run_log_states/<n>.json         checkpoint n: its rows' directory and the event files it stands for
    run_log_states/rows-<token>     one row per run, in the latest state it had then

Events and checkpoints appear by a rename that replaces nothing, so there is no moment at which one is half there, and
writers need not wait for each other. Readers take the newest checkpoint and the event files it does not stand for: their
number is bounded by how often :func:`compact_run_log` is called, not by the age of the log. Files that a checkpoint stands
for are deleted by the one after it, so a reader is safe from a compaction that runs meanwhile.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime
from functools import reduce
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.contracts import RUN_LOG_SCHEMA
from assayer.sources.storage import create_text, names_below, read_text, remove

#: The run log's columns and, where a run replaced several windows, all of them.
EVENT_SCHEMA = T.StructType(
    [*RUN_LOG_SCHEMA.fields, T.StructField("windows", T.ArrayType(T.StructType([T.StructField(c, T.DateType()) for c in ("date_from", "date_to")])))]
)

#: Events are JSON; logs begun by earlier releases have Parquet files, until the first checkpoint.
_EVENT_FILES = (".json", ".parquet")

#: A publish first makes a checkpoint where at least so many event files have none.
COMPACT_AFTER = 20


def _told(value: Any) -> Any:
    """A value as JSON has it; a time without a zone is local, as Spark takes it."""
    if isinstance(value, datetime):
        return value.astimezone(UTC).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, str):
        return value.encode("utf-8", "replace").decode("utf-8")
    return value


def log_event(spark: SparkSession, root: str, *, windows: Sequence[tuple[date, date]] = (), **values: Any) -> None:
    """Append one event. No Spark job runs."""
    unknown = sorted(values.keys() - set(EVENT_SCHEMA.names))
    if unknown:
        raise ValueError(f"the run log has no columns {unknown}")
    event = {name: _told(value) for name, value in values.items() if value is not None}
    if windows:
        event["windows"] = [{"date_from": _told(first), "date_to": _told(last)} for first, last in windows]
    if not create_text(spark, f"{root}/run_log/{uuid4().hex}.json", json.dumps(event)):
        raise FileExistsError(f"an event of this name is already in {root}/run_log")


@dataclass(frozen=True)
class _Listing:
    """What a reader needs to know: the newest checkpoint and the event files beside it."""

    number: int
    #: The rows of the newest checkpoint, below ``run_log_states``; empty without one.
    rows: str
    #: Event files that the checkpoint stands for and that are still there.
    covered: tuple[str, ...]
    tail: tuple[str, ...]


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = names_below(spark, f"{root}/run_log_states")
    return sorted(int(name[: -len(".json")]) for name in names if name.endswith(".json") and not name.startswith("."))


def _checkpoint(spark: SparkSession, root: str, number: int) -> dict[str, Any]:
    return json.loads(read_text(spark, f"{root}/run_log_states/{number}.json"))


def _listing(spark: SparkSession, root: str) -> _Listing:
    # The checkpoint first: event files that a later one stands for are then still listed.
    numbers = _numbers(spark, root)
    newest = _checkpoint(spark, root, numbers[-1]) if numbers else {"rows": "", "covers": []}
    there = [name for name in names_below(spark, f"{root}/run_log") if name.endswith(_EVENT_FILES) and not name.startswith(".")]
    stands_for = set(newest["covers"])
    return _Listing(
        numbers[-1] if numbers else 0,
        newest["rows"],
        tuple(name for name in there if name in stands_for),
        tuple(name for name in there if name not in stands_for),
    )


def _events(spark: SparkSession, root: str, listing: _Listing) -> DataFrame:
    texts, tables = ([f"{root}/run_log/{name}" for name in listing.tail if name.endswith(kind)] for kind in _EVENT_FILES)
    if listing.rows:
        tables.append(f"{root}/run_log_states/{listing.rows}")
    # A damaged event has to fail: read as nulls it would hide a publish.
    reader = spark.read.schema(EVENT_SCHEMA).option("mode", "FAILFAST")
    parts = [reader.json(texts)] if texts else []
    parts += [reader.parquet(path) for path in tables]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], EVENT_SCHEMA)


def run_events(spark: SparkSession, root: str) -> DataFrame:
    """The events of the run log, of runs in a checkpoint the latest one only; empty before the first run."""
    return _events(spark, root, _listing(spark, root))


def _latest(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    is_closing = (F.col("status") != "running").cast("int")
    return events.groupBy(F.col("run_id").alias("log_key")).agg(F.max_by(F.struct(*columns), is_closing).alias("state")).select("state.*")


def latest_runs(events: DataFrame) -> DataFrame:
    """One row per run in its latest state: the closing event where there is one, else ``running``."""
    return _latest(events, RUN_LOG_SCHEMA.names)


def run_by_id(events: DataFrame, run_id: str) -> DataFrame:
    return latest_runs(events.filter(F.col("run_id") == run_id))


def compact_run_log(spark: SparkSession, root: str, *, least: int = 1) -> bool:
    """Write a checkpoint of all runs' latest states, if ``least`` event files have none; whether one was written.

    Of several that run at once one writes it. One that dies leaves the log as it was, and perhaps a directory of rows
    that nothing names.
    """
    if least < 1:
        raise ValueError("a checkpoint stands for at least one event")
    listing = _listing(spark, root)
    if len(listing.tail) < least:
        return False
    states, rows = f"{root}/run_log_states", f"rows-{uuid4().hex}"
    _latest(_events(spark, root, listing), EVENT_SCHEMA.names).write.parquet(f"{states}/{rows}")
    told = json.dumps({"rows": rows, "covers": [*listing.covered, *listing.tail]})
    if not create_text(spark, f"{states}/{listing.number + 1}.json", told):
        remove(spark, f"{states}/{rows}")
        return False
    for name in listing.covered:
        remove(spark, f"{root}/run_log/{name}")
    for number in _numbers(spark, root):
        if number < listing.number:
            remove(spark, f"{states}/{_checkpoint(spark, root, number)['rows']}")
            remove(spark, f"{states}/{number}.json")
    return True


def current_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(version, run id) of the last successful publish, or None."""
    done = F.when(F.col("status") == "succeeded", F.struct("mart_version", "run_id"))
    newest = run_events(spark, root).agg(F.max(done).alias("newest")).first()["newest"]
    return (newest["mart_version"], newest["run_id"]) if newest else None
