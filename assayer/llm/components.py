"""Connected components of a graph given by edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger neighbours (large) or its smaller ones and itself (small) to the least of all."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = both if large else both.filter(F.col("v") < F.col("u"))
    least = seen.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    linked = seen.join(least, "u")
    if large:
        moved = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``u, v``; the root is the least node of its component.

    Each round is written to the shared scratch folder; only two numbers a round reach the driver. Loops and repeated
    edges do no harm; no edges give no rows.
    """
    now = written(edges.select("u", "v").filter(F.col("u") != F.col("v")).distinct(), "components")
    mark = _mark(now)
    while mark[0]:
        after = written(_star(_star(now, large=True), large=False), "components")
        before, mark, now = mark, _mark(after), after
        if mark == before:
            break
    # Now every edge leads from a node to its root.
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of ``n`` local nodes under the edges left-right, the least node of each one's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        after = root.copy()
        np.minimum.at(after, root[left], low)
        np.minimum.at(after, root[right], low)
        after = after[after]
        if (after == root).all():
            return root
        root = after
