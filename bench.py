"""Headline queries, timed. Prints one JSON line.

Each query runs once to warm up, then ``RUNS`` times; the median counts. ``throughput`` has single runs over the same
events ``FACTOR`` times over (event ids shifted), in million trips a second, where fixed costs weigh less.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

RUNS = 3
FACTOR = 20
#: Queries over the multiplied events.
LARGE = ("silver_derive", "gold_daily_zone", "gold_hourly_demand", "run_silver")

HEADLINE = (
    "silver_derive",
    "validation_reasons",
    "filter_valid",
    "enrich_left_join",
    "gold_daily_zone",
    "gold_hourly_demand",
    "gold_input_summary",
    "top_zones",
    "top_hours",
    "sink_silver_one_pass",
    "run_silver",
    "run_gold",
    "publish_window_replace",
    "run_publish",
    "run_all",
)


def multiplied(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the events ``FACTOR`` times over and the other tables the trips need."""
    folder = tempfile.mkdtemp(prefix="assayer-bench-")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    step = events.selectExpr("max(event_id) + 1").first()[0]
    copies = spark.range(FACTOR).withColumnRenamed("id", "copy")
    shifted = events.join(copies.hint("broadcast")).selectExpr(f"event_id + copy * {step} AS event_id", "* EXCEPT (event_id, copy)")
    shifted.write.parquet(f"{folder}/events.parquet")
    for name in ("nation", "region"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    from assayer.plans.queries import QUERIES
    from assayer.session import tune_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("assayer-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune_session(spark)
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()

    def timed(name: str, folder: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in HEADLINE:
        timed(name, sf_dir)
        seconds[name] = round(statistics.median(timed(name, sf_dir) for _ in range(RUNS)), 3)
    large = multiplied(spark, sf_dir)
    trips = spark.read.parquet(f"{large}/events.parquet").count()
    throughput = {name: round(trips / 1e6 / timed(name, large), 3) for name in LARGE}
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "throughput": {"unit": "million trips a second", "trips": trips, "queries": throughput},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    main()
