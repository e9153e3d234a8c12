"""A Merkle manifest of a dataset: one digest for all rows, and for each row the proof that it belongs to it.

Rows are leaves, in order, of a binary tree for each group; the groups' roots are the leaves of a last tree. Trees are
built a block of ``2 ** BLOCK_LEVELS`` nodes at a time, every block in one task, by time-forward processing: nodes are
visited in the order of their labels (level, place), and a queue ordered by label brings each node the digests its
children sent. The blocks' roots are the next round's leaves, so the rounds are few at any size and no task holds a
tree. A reversed sweep then goes down the same blocks: every node receives its path to the root and sends its children
theirs, one sibling longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from assayer.llm.common import reachable, written
from assayer.llm.spill import SpillingQueue

#: Levels a block spans: at most 1024 nodes enter a task's block.
BLOCK_LEVELS = 10
#: What is hashed of a document, in this order.
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Where the unsigned crc32 of the decimal key is divisible by this, the copy to be checked is tampered with.
TAMPERED_EVERY = 7
ROWS_OUT = 2_000
HEX = 64


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: dict[str, Column]) -> Column:
    """The lowercase hex SHA-256 of the fields: '-' for null, else the UTF-8 byte count, ':' and the value."""
    texts = [value.cast("string") for value in fields.values()]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def in_order(df: DataFrame, group: str, order: list[str], into: str, total: str) -> DataFrame:
    """``df`` with ``into``, the gapless place from 0 within ``group`` by ``order``, and ``total``, the group's rows.

    Rows are dealt out by range of group, order and place of reading, so that neither a group nor a repeated key has to
    fit a task; only the counts of each range's groups are summed over ranges. ``group`` must not be null.
    """
    spread = df.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(group, *order, "_read")
    # The id's upper bits are the range's number, the lower ones count its rows in their order.
    ordered = written(spread.sortWithinPartitions(group, *order, "_read").drop("_read").withColumn("_at", F.monotonically_increasing_id()), "in-order")
    ranged = ordered.withColumn("_range", F.shiftright("_at", 33))
    counts = ranged.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_of")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_group", "_of", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias(total))
    placed = ranged.join(starts, (F.col(group) == F.col("_group")) & (F.col("_range") == F.col("_of")))
    return placed.withColumn(into, F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_range", "_group", "_of", "_first", "_before")


# ---- one block ----


def _levels(total: int) -> int:
    """Levels a block rises: to the tree's root where that is within reach, else all of a block's."""
    return min(BLOCK_LEVELS, (total - 1).bit_length())


def forward(leaves: list[str], first: int, levels: int) -> tuple[str, list[tuple[tuple[int, int], list[str]]]]:
    """The root of a block and every inner node's label with its children's digests, in label order.

    ``first`` is the place of the first leaf. Each node takes from the queue what its children sent and sends its own
    digest on, until the level of the block's root.
    """
    queue, nodes = SpillingQueue(), []
    for place, leaf in enumerate(leaves, first):
        queue.push((1, place >> 1), leaf)
    root = leaves[0]
    while levels and (label := queue.next_label()) is not None:
        children = queue.take(label)
        nodes.append((label, children))
        root = digest(*children)
        if label[0] < levels:
            queue.push((label[0] + 1, label[1] >> 1), root)
    return root, nodes


def backward(nodes: list[tuple[tuple[int, int], list[str]]], first: int, count: int, path: str) -> Iterator[str]:
    """The path of each of ``count`` leaves: the steps to the block's root, then ``path``.

    A step is ``L`` or ``R`` and the sibling's digest, by the side it stands on, or ``N`` for a child without one.
    Labels are visited in reverse, so each node has its path before its children need theirs.
    """
    queue = SpillingQueue()
    if nodes:
        queue.push((-nodes[-1][0][0], -nodes[-1][0][1]), path)
    paths = [path] * count
    for (level, place), children in reversed(nodes):
        (own,) = queue.take((-level, -place))
        steps = ["N"] if len(children) == 1 else [f"R{children[1]}", f"L{children[0]}"]
        for child, step in enumerate(steps, 2 * place):
            if level > 1:
                queue.push((1 - level, -child), step + own)
            else:
                paths[child - first] = step + own
    yield from paths


def steps(path: str) -> Iterator[tuple[str, str]]:
    """``(side, digest)`` of each step, from the leaf up; the digest is empty where there is no sibling."""
    at = 0
    while at < len(path):
        side = path[at]
        yield side, path[at + 1 : at + 1 + HEX] if side != "N" else ""
        at += 1 if side == "N" else 1 + HEX


def fold(leaf: str, path: str) -> str:
    """The root that ``leaf`` leads to along ``path``."""
    for side, sibling in steps(path):
        leaf = digest(sibling, leaf) if side == "L" else digest(leaf, sibling)
    return leaf


def proof(path: str) -> str:
    """The siblings of a path as one digest."""
    return digest(*[sibling for _, sibling in steps(path)])


# ---- all blocks ----


def _grouped(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[list[tuple]]:
    """Consecutive rows that agree in their first ``width`` columns. A block is at most 1024 nodes and one path."""
    rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns], strict=True))
    for _, group in groupby(rows, key=itemgetter(*range(width))):
        yield list(group)


def _batches(rows: Iterable[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_OUT:
            yield batch(held)
            held = []
    if held:
        yield batch(held)


_NODE = "tree string, place bigint, digest string, total bigint"


def _blocks(nodes: DataFrame, *more: str) -> DataFrame:
    """Nodes dealt out by block, in order within it."""
    blocked = nodes.withColumn("block", F.shiftright("place", BLOCK_LEVELS))
    return blocked.select("tree", "block", "place", "digest", "total", *more)


def _raised(nodes: DataFrame) -> DataFrame:
    """The blocks' roots: the nodes of the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def roots() -> Iterator[tuple]:
            for group in _grouped(batches, 2):
                tree, block, first, _, total = group[0]
                root, _ = forward([row[3] for row in group], first, _levels(total))
                yield tree, block, root, -(-total >> BLOCK_LEVELS)

        yield from _batches(roots(), ["tree", "place", "digest", "total"], [pa.string(), pa.int64(), pa.string(), pa.int64()])

    return _blocks(nodes).repartition("tree", "block").sortWithinPartitions("tree", "block", "place").mapInArrow(run, _NODE)


def _lowered(nodes: DataFrame, paths: DataFrame, carried: list[str]) -> DataFrame:
    """Each node with its path, given those of the blocks' roots as ``tree, place, path, tops``.

    A block's path travels once, as a row before its nodes, and not beside each of them.
    """
    extra = [F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in carried]
    heads = paths.select("tree", F.col("place").alias("block"), F.lit(-1).cast("bigint").alias("place"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("bigint").alias("total"), "path", "tops", *extra)
    text = F.lit(None).cast("string")
    rows = _blocks(nodes, text.alias("path"), text.alias("tops"), *carried).unionByName(heads)
    kinds = ", ".join(f"{c} {nodes.schema[c].dataType.simpleString()}" for c in carried)
    schema = f"{_NODE}, path string, tops string" + (f", {kinds}" if carried else "")
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), *[to_arrow_type(nodes.schema[c].dataType) for c in carried]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lowered() -> Iterator[tuple]:
            for group in _grouped(batches, 2):
                head, members = group[0], group[1:]
                first, total = members[0][2], members[0][4]
                _, inner = forward([row[3] for row in members], first, _levels(total))
                for row, path in zip(members, backward(inner, first, len(members), head[5]), strict=True):
                    yield row[0], row[2], row[3], row[4], path, head[6], *row[7:]

        yield from _batches(lowered(), ["tree", "place", "digest", "total", "path", "tops", *carried], types)

    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "place").mapInArrow(run, schema)


def _rounds(leaves: DataFrame) -> list[DataFrame]:
    """The written node tables from the leaves' to one with a root for each tree."""
    rounds = [leaves]
    while (rounds[-1].agg(F.max("total")).first()[0] or 0) > 1:
        rounds.append(written(_raised(rounds[-1]), "merkle-nodes"))
    return rounds


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Documents of a language are ordered by id (null first); rows that share an id are ordered by their leaf, so the
    order of reading decides nothing. Trees of languages are ordered by name, null first. ``folded_root`` is
    recomputed from the tampered copy of a row and the original siblings. Rows with a null id or a null number of characters are never
    tampered with. Columns other than the five hashed are ignored. An empty table gives an empty result.
    """
    reachable(docs.sparkSession)
    fields = {name: F.col(name) for name in LEAF_FIELDS}
    changed = {**fields, "n_chars": (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")}
    hit = (F.crc32(F.col("doc_id").cast("string")) % TAMPERED_EVERY == 0) & F.col("n_chars").isNotNull()
    # Texts are read here only; from now on rows are two digests.
    leaves = written(
        docs.select(
            F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"),
            F.col("doc_id"),
            leaf_digest(fields).alias("digest"),
            F.when(hit, leaf_digest(changed)).alias("checked"),
        ),
        "merkle-leaves",
    )
    # '-' sorts before '=', so the tree of null comes first.
    placed = written(in_order(leaves, "tree", ["doc_id", "digest"], "place", "total"), "merkle-placed")
    rounds = _rounds(placed)
    tops = rounds[-1].select(F.lit("all").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = written(in_order(tops, "tree", ["name"], "place", "total"), "merkle-tops")
    top_rounds = _rounds(tops)
    paths = top_rounds[-1].select("tree", "place", F.lit("").alias("path"), F.col("digest").alias("tops"))
    for nodes in reversed(top_rounds[:-1]):
        paths = written(_lowered(nodes, paths, ["name"] if nodes is tops else []), "merkle-paths")
    if len(top_rounds) == 1:
        # A single tree: its root is the root of all.
        paths = tops.select("name", "digest", F.lit("").alias("path"), F.col("digest").alias("tops"))
    paths = paths.select(F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("place"), "path", F.concat("digest", "tops").alias("tops"))
    for nodes in reversed(rounds[1:-1]):
        paths = written(_lowered(nodes, paths, []), "merkle-paths").select("tree", "place", "path", "tops")
    if len(rounds) == 1:
        # Every tree is a single leaf.
        found = placed.join(paths.withColumnRenamed("place", "_place"), "tree")
    else:
        found = _lowered(placed, paths, ["doc_id", "checked"])
    return _verified(found.select("doc_id", "digest", "checked", "path", "tops"))


def _verified(found: DataFrame) -> DataFrame:
    kind = found.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, checked, paths, tops = (batch.column(i).to_pylist() for i in range(1, 5))
            folded = [fold(c or leaf, path) for leaf, c, path in zip(leaves, checked, paths, strict=True)]
            roots = [top[HEX:] for top in tops]
            columns = [
                batch.column(0),
                pa.array(leaves, pa.string()),
                pa.array([top[:HEX] for top in tops], pa.string()),
                pa.array(roots, pa.string()),
                pa.array([proof(path) for path in paths], pa.string()),
                pa.array(folded, pa.string()),
                pa.array([f == r for f, r in zip(folded, roots, strict=True)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.mapInArrow(run, schema)
