"""Sharding by jump consistent hashing, in DataFrame functions only.

``jump_shard(key, n)`` maps a 64-bit key to one of ``n`` shards without a ring table. Going from n to n + 1 shards, a
key either stays or moves to the new shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import numbered, text_or_empty

#: The multiplier of the generator in the published algorithm (fixed value).
MULTIPLIER = 2862933555777941757
#: Jumps followed for very many shards. A key makes about ln(n) jumps; more than this many has a chance below 1e-100.
MOST_JUMPS = 400

LOW = 0xFFFFFFFF


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """The generator's next 64-bit state (state * MULTIPLIER + 1 mod 2**64) in 32-bit halves, free of overflow."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & LOW

    def times(half: Column, factor: int) -> tuple[Column, Column]:
        """half * factor of two 32-bit numbers, as (high, low) halves of 64 bits."""
        small, big = half * (factor & 0xFFFF), half * (factor >> 16)
        bottom = small.bitwiseAND(F.lit(LOW)) + F.shiftleft(big.bitwiseAND(F.lit(0xFFFF)), 16)
        top = F.shiftright(small, 32) + F.shiftright(big, 16) + F.shiftright(bottom, 32)
        return top, bottom.bitwiseAND(F.lit(LOW))

    top, bottom = times(low, m_low)
    bottom = bottom + 1
    carry = F.shiftright(bottom, 32)
    upper = top + carry + times(high, m_low)[1] + times(low, m_high)[1]
    return upper.bitwiseAND(F.lit(LOW)), bottom.bitwiseAND(F.lit(LOW))


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a bigint key. A null key counts as 0."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key, F.lit(0).cast("bigint"))
    start = F.struct(
        F.lit(-1).cast("bigint").alias("shard"),
        F.lit(0).cast("bigint").alias("next"),
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(F.lit(LOW)).alias("low"),
    )

    def jump(state: Column, _: Column) -> Column:
        high, low = _next_state(state["high"], state["low"])
        moved = F.struct(
            state["next"].alias("shard"),
            F.floor((state["next"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double"))).alias("next"),
            high.alias("high"),
            low.alias("low"),
        )
        return F.when(state["next"] < shards, moved).otherwise(state)

    steps = F.sequence(F.lit(1), F.lit(min(shards, MOST_JUMPS)))
    return F.aggregate(steps, start, jump, lambda state: state["shard"]).cast("int")


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``key``: the key's hash and the number of shards decide, nothing else, so any row can be placed alone
    and equal keys share a shard. ``size`` is the text's UTF-8 bytes plus 1; a null text has none and the checksum of
    an empty one. ``slot`` numbers each shard's rows from 0 without gaps. ``grown_shard`` is the shard with one more.

    Null keys hash to one fixed value and share a shard. Repeated rows each get a slot of their own. Columns beyond
    key and text are ignored; an empty table gives an empty result.
    """
    content = text_or_empty(text)
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(content) + 1).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(key)).alias("_hash"),
    )
    placed = rows.withColumn("shard", jump_shard(F.col("_hash"), shards)).withColumn("grown_shard", jump_shard(F.col("_hash"), shards + 1))
    slots = numbered(placed, ["shard"], "_hash", ["doc_id"], "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
