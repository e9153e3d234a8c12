"""Token-id files: one compressed wavelet matrix per shard of documents in key order.

A shard is one row of a Parquet file: its place (``part``, ``seq``), the keys and lengths of its documents, and the bytes
of a wavelet matrix of their ids, complete in themselves. Spark writes and reads the files, so they can lie in any store Spark reaches. Shards can
be looked into without decoding them: a token at a position, counts, and occurrences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayer.llm.common import arrow_map, reachable
from assayer.llm.encoding import encoder
from assayer.llm.wavelet import WaveletMatrix

#: Ids of a shard after which a new one starts, at the next document. So many stay in a core's cache while planes are built.
SHARD_TOKENS = 1 << 20
#: Shards of one Parquet file at most.
SHARDS_PER_FILE = 8


def write_token_shards(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    shard_tokens: int = SHARD_TOKENS,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encodes every whole text, appends ``end_id``, and writes the shards in ascending key order below ``path``.

    Documents are dealt out by key range, so shards follow each other in key order; null keys come first. A null text
    is empty: its document is the end id alone. Repeated keys are in the order of their texts. Columns other than the
    two named are ignored. An empty table writes no shard.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    schema = f"part int, seq int, n_docs bigint, n_tokens bigint, keys array<{kind.simpleString()}>, lengths array<bigint>, ids binary"
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        keys, raw, held = [], [], 0

        def shard() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(raw), dtype="<u4")
            lengths = [len(r) // 4 for r in raw]
            columns = {
                "part": pa.array([part], pa.int32()),
                "seq": pa.array([seq], pa.int32()),
                "n_docs": pa.array([len(keys)], pa.int64()),
                "n_tokens": pa.array([len(ids)], pa.int64()),
                "keys": pa.array([keys], pa.list_(key_type)),
                "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "ids": pa.array([WaveletMatrix.build(ids).to_bytes()], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(k)
                raw.append(encoder(tokenizer).encode(t.as_py() or "") + end)
                held += len(raw[-1]) // 4
                if held >= shard_tokens:
                    yield shard()
                    keys, raw, held, seq = [], [], 0, seq + 1
        if keys:
            yield shard()

    reachable(docs.sparkSession)
    ordered.mapInArrow(run, schema).write.option("maxRecordsPerFile", SHARDS_PER_FILE).option("compression", "uncompressed").parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``part, seq, shard_start``: the ids in all shards before. Parts are summed first, shards then within their part."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("_part_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("_part_tokens").over(earlier), F.lit(0)).alias("_part_start"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("_before"))
    return placed.join(starts, F.col("part") == F.col("_part")).select("part", "seq", (F.col("_part_start") + F.col("_before")).alias("shard_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: ``key, start, n_tokens, ids_crc32``; ``start`` counts over all shards."""
    shards = spark.read.parquet(path)
    kind = shards.schema["keys"].dataType.elementType.simpleString()
    schema = f"key {kind}, part int, seq int, offset bigint, n_tokens bigint, ids_crc32 bigint"

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in range(batch.num_rows):
            part, seq, keys, lengths, data = (batch.column(i)[row] for i in range(5))
            raw = memoryview(WaveletMatrix.from_bytes(data.as_py()).decode().tobytes())
            sizes = np.array(lengths.as_py(), dtype=np.int64)
            ends = np.cumsum(sizes)
            sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
            n = len(sizes)
            columns = [
                keys.values,
                pa.array(np.full(n, part.as_py(), dtype=np.int32)),
                pa.array(np.full(n, seq.as_py(), dtype=np.int32)),
                pa.array(ends - sizes),
                pa.array(sizes),
                pa.array(sums, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "part", "seq", "offset", "n_tokens", "ids_crc32"])

    decoded = arrow_map(shards.select("part", "seq", "keys", "lengths", "ids"), each, schema)
    return decoded.join(shard_starts(shards.select("part", "seq", "n_tokens")), ["part", "seq"]).select(
        "key", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Where ``token`` occurs: ``key, position`` (in its document's ids), found by select, shard by shard."""
    shards = spark.read.parquet(path)
    kind = shards.schema["keys"].dataType.elementType.simpleString()

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in range(batch.num_rows):
            keys, lengths, data = (batch.column(i)[row] for i in range(3))
            found = np.array(WaveletMatrix.from_bytes(data.as_py()).positions(token), dtype=np.int64)
            ends = np.cumsum(np.array(lengths.as_py(), dtype=np.int64))
            doc = np.searchsorted(ends, found, side="right")
            starts = np.concatenate(([0], ends))[doc]
            yield pa.RecordBatch.from_arrays([keys.values.take(pa.array(doc)), pa.array(found - starts)], names=["key", "position"])

    return arrow_map(shards.select("keys", "lengths", "ids"), each, f"key {kind}, position bigint")


def token_count(spark: SparkSession, path: str, token: int) -> DataFrame:
    """One row, ``n``: how often ``token`` occurs in all shards, by rank alone."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts = [WaveletMatrix.from_bytes(data.as_py()).count(token) for data in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], names=["n"])

    counted = arrow_map(spark.read.parquet(path).select("ids"), each, "n bigint")
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
