"""What several operators share: word counts, scratch tables, numbering within groups of any size."""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assayer.plans.scratch import scratch_dir

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: its lineage ends there, and lost executors cost no second run."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reachable(spark: SparkSession) -> None:
    """Lets Python workers of local runs import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


#: Bytes of an Arrow batch where texts are long; the last row of a batch may go beyond.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes, so that the length of texts does not decide what a task holds. A lower limit stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, str(BATCH_BYTES))


def arrow_map(df: DataFrame, each: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``each`` over the record batches of every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from each(batch)

    reachable(df.sparkSession)
    return df.mapInArrow(run, schema)


def numbered(df: DataFrame, groups: list[str], by: str, ties: list[str], into: str, rows: int | None = None) -> DataFrame:
    """Adds ``into``: a gapless number from 0 within each group, in the order of ``by`` and then ``ties``.

    ``by`` must be a bigint spread evenly over its whole range, such as a hash. Its high bits cut every group into
    buckets of about max(2000, sqrt(rows)) rows, so that no task holds a whole group; bucket sizes are summed up first.
    ``df`` is evaluated twice, the first time with the columns ``groups`` and ``by`` only. Rows that agree in ``by``
    and ``ties`` are numbered in any order.
    """
    rows = df.count() if rows is None else rows
    bits = max(0, math.ceil(math.log2(max(1, rows) / max(2000.0, math.sqrt(max(1, rows))))))
    # The sign bit is flipped so that the buckets follow the order of signed numbers.
    bucket = F.shiftrightunsigned(F.col(by).bitwiseXOR(F.lit(-(2**63))), 64 - bits) if bits else F.lit(0).cast("bigint")
    bucketed = df.withColumn("_bucket", bucket)
    # Group keys may be null, so they are compared null-safely.
    keys = [f"_k{i}" for i in range(len(groups))]
    sizes = bucketed.groupBy(*[F.col(g).alias(k) for g, k in zip(groups, keys, strict=True)], F.col("_bucket").alias("_b")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*groups, "_bucket").orderBy(by, *ties)
    placed = bucketed.withColumn("_at", F.row_number().over(within))
    same = F.col("_bucket") == F.col("_b")
    for g, k in zip(groups, keys, strict=True):
        same = same & F.col(g).eqNullSafe(F.col(k))
    return placed.join(starts, same).withColumn(into, F.col("_start") + F.col("_at") - 1).drop("_bucket", "_b", "_n", "_at", "_start", *keys)
