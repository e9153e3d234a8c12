"""The trie of conversation prefixes, and what sharing each prefix saves.

Every distinct run of first turns is a node, named by a chained hash of its turns, so that texts are read once and never
shuffled: only their hashes and sizes are. Totals over subtrees come by time-forward processing. Nodes are sorted by
reverse level order, a node takes from a spilling queue what its children sent, and sends its own totals to its parent.
Light subtrees, those of prefixes that few conversations share, are dealt out as shards and each task works on its own;
their roots' totals are summed by parent, and the few heavy nodes above them follow in a last such pass.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import reachable, written
from assayer.llm.spill import SpillingQueue

#: Heavy nodes hold more than this share of all (conversation, depth) rows, so there are at most so many of them.
MOST_HEAVY = 50_000
#: The first turns that a conversation can take over are fewer than this, and come from the first of so many.
TAKEN_BELOW, SIBLINGS = 9, 5
ROWS_OUT = 4_000
ROOT = bytes(16)
NO_END = hashlib.sha256(b"").hexdigest()


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    arrays = [pa.array(column, kind) for column, (_, kind) in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in schema])


def _batches(rows: Iterator[tuple], schema: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= ROWS_OUT:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


# ---- conversations as rows of turns ----


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, turn_hash, n_bytes``: the turns of each conversation from 1, in order.

    Null turns come first, and turns with one number are ordered by role and then by hash. Null roles and texts are empty.
    Rows without a conversation are left out. The hash is of the role's length, the role and the text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    hashed = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint"), "turn", role.alias("role"), hashed.alias("turn_hash"), F.octet_length(text).cast("bigint").alias("n_bytes")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "turn_hash")
    return turns.select("conv_id", F.row_number().over(order).cast("bigint").alias("at"), "turn_hash", "n_bytes")


def taken_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its group (fixed rule)."""
    return F.crc32(conv_id.cast("string")) % TAKEN_BELOW


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, part, at, turn_hash, n_bytes``: rebuilt conversations, in the order of part and place.

    Part 0 holds the turns taken from the group's first conversation, part 1 the own ones after as many. Part -1 is one
    row for each conversation, also of those that are left without a turn.
    """
    own = turns.select("conv_id", F.lit(1).alias("part"), "at", "turn_hash", "n_bytes").filter(F.col("at") > taken_turns(F.col("conv_id")))
    every = turns.filter("at = 1").select("conv_id")
    wanted = every.select(F.col("conv_id").alias("_conv"), (F.col("conv_id") - F.col("conv_id") % SIBLINGS).alias("_from"), taken_turns(F.col("conv_id")).alias("_taken"))
    # Both sides of the join have less than ten rows for a key.
    first = turns.filter((F.col("at") < TAKEN_BELOW) & (F.col("conv_id") % SIBLINGS == 0))
    taken = first.join(wanted, (F.col("conv_id") == F.col("_from")) & (F.col("at") <= F.col("_taken")))
    heads = every.select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("bigint").alias("at"), F.lit(None).cast("binary").alias("turn_hash"), F.lit(0).cast("bigint").alias("n_bytes"))
    return heads.unionByName(taken.select(F.col("_conv").alias("conv_id"), F.lit(0).alias("part"), "at", "turn_hash", "n_bytes")).unionByName(own)


_CHAIN = [
    ("conv_id", pa.int64()),
    ("depth", pa.int64()),
    ("node", pa.binary()),
    ("parent", pa.binary()),
    ("n_bytes", pa.int64()),
    ("is_end", pa.bool_()),
]


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, n_bytes, is_end``: one row for each prefix of each conversation, the empty one included.

    ``turns`` as :func:`rebuilt` gives them. A node's name hashes its parent's name and its last turn. Conversations of
    any length are read as a stream.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chained() -> Iterator[tuple]:
            last, node, depth = None, ROOT, 0
            for conv, part, _, turn_hash, n_bytes in _rows(batches):
                if last is not None:
                    yield *last, part < 0
                if part < 0:
                    parent, node, depth = None, ROOT, 0
                else:
                    parent, node, depth = node, hashlib.blake2b(node + turn_hash, digest_size=16).digest(), depth + 1
                last = (conv, depth, node, parent, n_bytes)
            if last is not None:
                yield *last, True

        yield from _batches(chained(), _CHAIN)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
    return ordered.mapInArrow(run, "conv_id bigint, depth bigint, node binary, parent binary, n_bytes bigint, is_end boolean")


# ---- totals ----

_TOTALS = [
    ("node", pa.binary()),
    ("parent", pa.binary()),
    ("conv_id", pa.int64()),
    ("depth", pa.int64()),
    ("n_convs", pa.int64()),
    ("n_children", pa.int64()),
    ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()),
    ("is_top", pa.bool_()),
]
_TOTALS_SQL = "node binary, parent binary, conv_id bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, is_top boolean"


def _subtree_totals(nodes: DataFrame) -> DataFrame:
    """Totals of sorted nodes by time-forward processing within each partition.

    ``nodes`` has ``depth, node, parent, conv_id, n_convs, n_bytes, is_top`` and the totals ``children, leaves, saved`` that
    have come from other shards, deepest nodes first. A node that is no top has its parent in its partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def visited() -> Iterator[tuple]:
            queue = SpillingQueue()
            for depth, node, parent, conv, n_convs, n_bytes, top, children, leaves, saved in _rows(batches):
                for below in queue.take((-depth, node)):
                    children, leaves, saved = children + 1, leaves + below[0], saved + below[1]
                leaves = leaves if children else 1
                saved += (n_convs - 1) * n_bytes
                if not top:
                    queue.push((1 - depth, parent), (leaves, saved))
                yield node, parent, conv, depth, n_convs, children, leaves, saved, top

        yield from _batches(visited(), _TOTALS)

    columns = ["depth", "node", "parent", "conv_id", "n_convs", "n_bytes", "is_top", "children", "leaves", "saved"]
    return nodes.select(*columns).sortWithinPartitions(F.desc("depth"), "node").mapInArrow(run, _TOTALS_SQL)


def _ends(chain: DataFrame) -> DataFrame:
    """``ended, ends_sha256`` of nodes at which conversations end. Ids are hashed as a sorted stream, never held together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed() -> Iterator[tuple]:
            node, ids = None, None
            for at, conv in _rows(batches):
                if at != node:
                    if ids is not None:
                        yield node, ids.hexdigest()
                    node, ids = at, hashlib.sha256(str(conv).encode())
                else:
                    ids.update(f",{conv}".encode())
            if ids is not None:
                yield node, ids.hexdigest()

        yield from _batches(hashed(), [("ended", pa.binary()), ("ends_sha256", pa.string())])

    ends = chain.filter("is_end").select("node", "conv_id")
    return ends.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(run, "ended binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (its smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    Rows with a null conversation are left out; null turns come first, null roles and texts are empty; repeated rows are
    repeated turns. Columns other than conv_id, turn, role and text are ignored. An empty table gives an empty result,
    not even a root.

    The conversations that end at one node are hashed one after another, as their digest demands: a group of equal
    conversations is a stream through one task, in bounded memory.
    """
    spark = conversations.sparkSession
    reachable(spark)
    turns = written(hashed_turns(conversations.select("conv_id", "turn", "role", "text")), "trie-turns")
    chain = written(prefixes(rebuilt(turns)), "trie-prefixes")
    nodes = written(
        chain.groupBy("node", "parent", "depth", "n_bytes").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")), "trie-nodes"
    )
    rows = nodes.agg(F.coalesce(F.sum("n_convs"), F.lit(0))).first()[0]
    is_heavy = F.col("n_convs") >= max(2, math.ceil(rows / MOST_HEAVY))
    # At most MOST_HEAVY rows, as each stands for so large a share of all.
    heavy = written(nodes.filter(is_heavy), "trie-heavy")
    light = nodes.filter(~is_heavy)
    # The shallowest light prefix of a conversation is the top of the shard of all its deeper ones.
    below = chain.join(F.broadcast(heavy.select("node")), "node", "left_anti")
    tops = below.groupBy(F.col("conv_id").alias("_conv")).agg(F.min(F.struct("depth", "node")).alias("_top"))
    none = {name: F.lit(0).cast("bigint") for name in ("children", "leaves", "saved")}
    sharded = light.join(tops, F.col("conv_id") == F.col("_conv")).withColumns({**none, "top": F.col("_top.node"), "is_top": F.col("node") == F.col("_top.node")})
    in_shards = written(_subtree_totals(sharded.repartition("top")), "trie-totals")
    sent = in_shards.filter("is_top").groupBy(F.col("parent").alias("_to")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    received = heavy.join(sent, F.col("node") == F.col("_to"), "left").withColumns(
        {**{name: F.coalesce(name, F.lit(0)) for name in none}, "is_top": F.col("parent").isNull()}
    )
    above = written(_subtree_totals(received.repartition(1)), "trie-totals")
    # A heavy parent is looked up among few; a light one has few children, which are no hot key.
    owners = heavy.select(F.col("node").alias("_parent"), F.col("conv_id").alias("parent_conv_id"))
    under_heavy = in_shards.filter("is_top").unionByName(above).join(F.broadcast(owners), F.col("parent") == F.col("_parent"), "left")
    light_owners = light.select(F.col("node").alias("_parent"), F.col("conv_id").alias("parent_conv_id"))
    under_light = in_shards.filter("NOT is_top").join(light_owners, F.col("parent") == F.col("_parent"), "left")
    both = under_heavy.unionByName(under_light)
    return both.join(_ends(chain), F.col("node") == F.col("ended"), "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_END)).alias("ends_sha256"),
    )
