"""Harmonic packing of documents into sequences of a fixed number of tokens.

A piece of r tokens belongs to the class k = capacity // r: k such pieces fill a sequence. Short pieces (up to capacity /
``CLASSES``) have a class for each length. Documents are cut until each piece nearly fills its class's share: whole
sequences first, then shares of exactly capacity // (k + 1), until the rest wastes little. Each class fills its
sequences with its own fixed number of pieces, wherever they come from; which ones is settled by numbering the class.
The fewer than k pieces left over in each class, a bounded number however many documents there are, are put together
by first fit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import arrow_map, numbered, reachable, written
from assayer.llm.encoding import encoder

#: Reciprocal classes; below capacity / CLASSES each length is a class.
CLASSES = 64
#: The share of its slot that a piece may leave empty before it is cut again.
MOST_WASTE = 1 / 32


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(piece length, class) of a document of ``length`` tokens. Classes of short pieces are their negative length."""
    pieces = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if k >= CLASSES:
            pieces.append((rest, -rest))
            break
        slot = capacity // k
        if slot - rest <= slot * MOST_WASTE:
            pieces.append((rest, k))
            break
        share = capacity // (k + 1)
        pieces.append((share, k + 1 if k + 1 < CLASSES else -share))
        rest -= share
    return pieces


def cut_documents(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, key: str, text: str, with_ids: bool
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, class`` of each piece, and ``ids`` (binary) if asked for."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, class int"
    end = np.array([end_id], dtype="<u4").tobytes()

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        of, starts, lengths, sums, totals, classes, ids = [], [], [], [], [], [], []
        for i, cell in enumerate(batch.column(1)):
            raw = encoder(tokenizer).encode(cell.as_py() or "") + end
            at, total = 0, len(raw) // 4
            for length, kind in cut(total, capacity):
                part = raw[4 * at : 4 * (at + length)]
                of.append(i)
                starts.append(at)
                lengths.append(length)
                sums.append(zlib.crc32(part))
                totals.append(total)
                classes.append(kind)
                if with_ids:
                    ids.append(part)
                at += length
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class"]
        columns = [batch.column(0).take(pa.array(of, pa.int64()))]
        columns += [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)] + [pa.array(classes, pa.int32())]
        if with_ids:
            names, columns = [*names, "ids"], [*columns, pa.array(ids, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return arrow_map(rows, each, schema + ", ids binary" * with_ids)


def _first_fit(pieces: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Sequence and offset of the left-over pieces, the longest first."""
    pieces = pieces.sort_values(["length", "_hash", "start"], ascending=[False, True, True], kind="stable")
    room, sequence, offset = np.zeros(0, dtype=np.int64), [], []
    for length in pieces["length"].tolist():
        fits = np.flatnonzero(room >= length)
        if len(fits):
            at = int(fits[0])
        else:
            at, room = len(room), np.append(room, capacity)
        sequence.append(at)
        offset.append(int(capacity - room[at]))
        room[at] -= length
    return pieces.assign(sequence_id=np.array(sequence, dtype=np.int64), offset=np.array(offset, dtype=np.int64))


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, and ``ids`` if asked for.

    Every id, with ``end_id`` at the end of each document, lies in exactly one piece; sequences hold at most
    ``capacity`` ids, without gaps from offset 0. Sequence ids are gapless from 0.

    A null text is empty: its document is the end id alone. Repeated rows are packed each. Columns other than the two
    named are ignored. An empty table gives an empty result.
    """
    cuts = cut_documents(docs, tokenizer, capacity, end_id, key, text, with_ids)
    pieces = written(cuts.withColumn("_hash", F.xxhash64("doc_id", "start", "ids_crc32")), "pack-pieces")
    per_bin = F.when(F.col("class") > 0, F.col("class")).otherwise(F.floor(F.lit(capacity) / -F.col("class"))).cast("bigint")
    # At most about 2 * CLASSES rows.
    full = pieces.groupBy("class").agg(F.count(F.lit(1)).alias("_n")).withColumn("_per", per_bin)
    full = full.withColumn("_bins", F.floor(F.col("_n") / F.col("_per")))
    earlier = Window.orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    classes = written(
        full.withColumnRenamed("class", "_class").withColumn("_first", F.coalesce(F.sum("_bins").over(earlier), F.lit(0))), "pack-classes"
    )
    bins = classes.agg(F.coalesce(F.sum("_bins"), F.lit(0))).first()[0]
    at = numbered(pieces, ["class"], "_hash", ["doc_id", "start"], "_rank").join(F.broadcast(classes), F.col("class") == F.col("_class"))
    whole = F.col("_rank") < F.col("_bins") * F.col("_per")
    placed = written(
        at.withColumn("sequence_id", F.when(whole, F.col("_first") + F.floor(F.col("_rank") / F.col("_per")))).drop("_class", "_n", "_bins", "_first"),
        "pack-placed",
    )
    before = Window.partitionBy("sequence_id").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    filled = placed.filter(F.col("sequence_id").isNotNull()).withColumn("offset", offset)
    reachable(docs.sparkSession)
    rest = placed.filter(F.col("sequence_id").isNull())
    schema = rest.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    # A bounded number of pieces: fewer than a sequence's worth of each class.
    fitted = rest.groupBy("sequence_id").applyInPandas(
        lambda group: _first_fit(group, capacity), f"{schema}, offset bigint"
    ).withColumn("sequence_id", F.col("sequence_id") + F.lit(bins))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return filled.select(*columns).unionByName(fitted.select(*columns))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids`` (little-endian unsigned 32-bit, without padding) of pieces packed with their ids."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate("_pieces", F.lit(b""), lambda all_ids, piece: F.concat(all_ids, piece["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), pieces.alias("_pieces")).select(
        "sequence_id", "length", joined.alias("ids")
    )
