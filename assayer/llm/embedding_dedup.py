"""Near-duplicates among embeddings: sorted passes find clusters in every label, which are then compared exactly.

Equal vectors of a label are one vector with a multiplicity. Each pass hashes a vector to the signs of random projections,
orders the vectors of a label lexicographically by the concatenated bits and cuts the order into blocks; a vector is
compared with all of its own and the neighbouring blocks, in half precision and with a slack that covers its rounding.
Links of all passes join clusters. Each cluster is then verified as a whole in double precision: its links, and the
components they make, are what the result holds.

Clusters of any size are cut into tiles of at most two parts of ``PART`` vectors, so a cluster of n vectors costs n^2
comparisons over n / PART tasks. No pair is written out: a tile gives sums and the edges of a spanning forest.

Passes of even number draw hyperplanes about the mean of the label, which tells vectors apart that share a direction; odd
ones draw them through the origin, where a pair at the threshold stays together over one bit with a fixed probability
however near the mean it lies. A pair meets when the bits that tell blocks apart agree. How many these are is measured over
the first passes, for all vectors but those in clusters already wider than a block; it gives the number of passes a label
needs until the mean chance that a pair at the threshold meets in none is at most ``miss``. A vector of a wide cluster
meets others of it in every pass, and one outside as often as that one's own, less crowded, windows allow. There is no other
path: a label whose vectors the bits hardly tell apart takes more passes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import arrow_map, written
from assayer.llm.components import components, local_roots
from assayer.llm.ngram_join import over_runs, tiles

#: Bits of a pass's hash.
BITS = 48
#: Vectors of a block.
BLOCK = 512
#: Passes that every label takes, and over which the bits that part blocks are measured.
FIRST_PASSES = 4
#: By how much the cosine of two unit vectors in half precision may be too low.
SLACK = 2.0**-10 + 1e-4
#: Vectors of one side of a tile, and those compared at a time.
PART, ROWS_AT_ONCE = 4096, 512
SEED = 20_240_501


@lru_cache(maxsize=64)
def planes(dim: int, number: int) -> np.ndarray:
    """The hyperplanes of one pass for one dimension; the same in every task."""
    return np.random.default_rng([SEED, dim, number]).standard_normal((dim, BITS))


def _units(rows: DataFrame) -> DataFrame:
    """``_row, vec_id, label, dim, vector`` (float64 bytes, unit length) of vectors that can link."""
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column(3)
        lengths = np.array([len(v) if v.is_valid else 0 for v in lists])
        for dim in np.unique(lengths[lengths > 0]).tolist():
            some = lists.filter(pa.array(lengths == dim))
            at = np.flatnonzero(lengths == dim)
            values = some.flatten()
            full = values.null_count == 0
            if not full:
                whole = np.array([None not in v for v in some.to_pylist()])
                at, some = at[whole], some.filter(pa.array(whole))
                values = some.flatten()
            x = values.to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
            finite = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore", invalid="ignore"):
                scale = np.abs(np.where(finite[:, None], x, 0)).max(axis=1)
                good = finite & (scale > 0)
                at, x = at[good], x[good] / scale[good][:, None]
            if not len(at):
                continue
            x /= np.sqrt((x * x).sum(axis=1))[:, None]
            picked = batch.take(pa.array(at))
            dims, vectors = pa.array(np.full(len(at), dim, dtype=np.int32)), pa.array([v.tobytes() for v in x], pa.binary())
            yield pa.RecordBatch.from_arrays([*picked.columns[:3], dims, vectors], names=["_row", "vec_id", "label", "dim", "vector"])

    return arrow_map(rows, each, f"_row bigint, vec_id {id_type}, label {label_type}, dim int, vector binary")


def _means(large: DataFrame) -> DataFrame:
    """``grp, mean``: the mean of each group's vectors, over all of them."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        groups = batch.column(0).to_numpy()
        names, first, place = np.unique(groups, return_index=True, return_inverse=True)
        raw, sums = batch.column(1).to_pylist(), []
        for i in range(len(names)):
            x = np.frombuffer(b"".join(raw[k] for k in np.flatnonzero(place == i)), dtype=float)
            sums.append(x.reshape(-1, len(raw[first[i]]) // 8).sum(axis=0).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sums, pa.binary()), pa.array(np.bincount(place))], names=["grp", "total", "n"])

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v, dtype=float) for v in group["total"]], axis=0) / group["n"].sum()
        return pd.DataFrame({"grp": group["grp"].iloc[:1], "mean": [total.tobytes()]})

    sums = arrow_map(large.select("grp", "vector"), each, "grp bigint, total binary, n bigint")
    return written(sums.groupBy("grp").applyInPandas(mean, "grp bigint, mean binary"), "vectors-means")


def _hashed(named: DataFrame, means: DataFrame, passes: range, threshold: float) -> DataFrame:
    """``tid, grp, half, stay, keys``: the vector in half precision and its bits in each of the passes.

    ``stay`` is the least probability that a bit about the group's mean does not part the vector from one at the
    threshold: at a distance r from the mean, they make an angle of asin(d / r) at most, and any angle if d >= r.
    """
    weights = (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)).astype(np.int64)
    apart = math.sqrt(max(0.0, 2 - 2 * threshold))

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dims = batch.column(2).to_numpy()
        for dim in np.unique(dims).tolist():
            some = batch.filter(pa.array(dims == dim))
            x, mean = (np.frombuffer(b"".join(some.column(k).to_pylist()), dtype=float).reshape(-1, dim) for k in (3, 4))
            centred = x - mean
            r = np.sqrt((centred * centred).sum(axis=1))
            stay = np.where(r > apart, 1 - np.arcsin(np.minimum(1, apart / np.maximum(r, 1e-300))) / math.pi, 0.0)
            keys = np.empty((len(x), len(passes)), dtype=np.int64)
            for at, number in enumerate(passes):
                keys[:, at] = ((x if number % 2 else centred) @ planes(dim, number) > 0) @ weights
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(passes), pa.int32()), pa.array(keys.ravel()))
            halves = pa.array([v.tobytes() for v in x.astype(np.float16)], pa.binary())
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), halves, pa.array(stay), lists], names=["tid", "grp", "half", "stay", "keys"])

    beside = named.join(means, "grp").select("tid", "grp", "dim", "vector", "mean")
    return written(arrow_map(beside, each, "tid bigint, grp bigint, half binary, stay double, keys array<bigint>"), "vectors-hashed")


def _blocks(entries: DataFrame, block: int) -> DataFrame:
    """``tid, grp, pass, key, _block``: the block of each vector in every pass, in one order of (pass, group, key)."""
    order = ["pass", "grp", "key", "tid"]
    # Ordered by range over all columns, so that equal keys do not meet in one task; the id is the place in the task.
    sorted_rows = entries.repartitionByRange(*order).sortWithinPartitions(*order).select(*order, F.monotonically_increasing_id().alias("_id"))
    placed = written(sorted_rows, "vectors-order").withColumn("_task", F.shiftright("_id", 33))
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return written(placed.join(F.broadcast(starts), "_task").select(*order, F.floor(place / block).alias("_block")), "vectors-blocks")


def _passes_needed(hashed: DataFrame, blocks: DataFrame, wide: DataFrame, threshold: float, miss: float) -> DataFrame:
    """``grp, passes``: the passes a group needs, from the bits that part its blocks; vectors in ``wide`` (``tid``) do not count.

    Vectors that agree with one in more bits than the nearest keys two blocks away do are in its own or a neighbouring
    block. These bits are taken from all these vectors in all passes of ``blocks``.
    """
    ends = written(blocks.groupBy("pass", "grp", "_block").agg(F.min("key").alias("least"), F.max("key").alias("most")), "vectors-ends")
    at = ["pass", "grp", "_block"]
    seen = blocks.join(ends.select("pass", "grp", (F.col("_block") + 2).alias("_block"), F.col("most").alias("before")), at, "left")
    seen = seen.join(ends.select("pass", "grp", (F.col("_block") - 2).alias("_block"), F.col("least").alias("after")), at, "left")

    def beyond(other: str) -> Column:
        differ = F.col("key").bitwiseXOR(F.col(other))
        agree = F.when(differ == 0, F.lit(BITS)).otherwise(F.lit(BITS) - F.length(F.bin(differ)))
        # ``least`` alone would take the missing key of a group's end for full agreement.
        return F.when(F.col(other).isNull(), F.lit(0)).otherwise(F.least(agree + 1, F.lit(BITS)))

    bits = seen.select("tid", "pass", F.greatest(beyond("before"), beyond("after")).alias("bits")).join(hashed.select("tid", "grp", "stay"), "tid")
    bits = bits.join(wide, "tid", "left_anti")
    through_origin = 1 - math.acos(min(1.0, threshold)) / math.pi
    chance = F.pow(F.when(F.col("pass") % 2 == 0, F.col("stay")).otherwise(F.lit(through_origin)), F.col("bits"))
    meet = bits.groupBy("tid", "grp").agg(F.avg(chance).alias("meet"))
    # Chances are rounded down to a quarter of a power of two; with passes through the origin none is far below 1e-3.
    coarse = F.ceil(F.log2("meet") * -4).cast("int")
    counts = written(meet.groupBy("grp", coarse.alias("coarse")).agg(F.count(F.lit(1)).alias("n")), "vectors-chances")
    worst = counts.groupBy("grp").agg(F.max("coarse").alias("_worst"))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        chances = 2.0 ** (group["coarse"].to_numpy() / -4)
        share = (group["n"] / group["n"].sum()).to_numpy()
        lost = lambda passes: (share * (1 - chances) ** passes).sum() > miss
        low, high = 0, 1
        while lost(high):
            low, high = high, 2 * high
        while high - low > 1:
            low, high = ((low + high) // 2, high) if lost((low + high) // 2) else (low, (low + high) // 2)
        return pd.DataFrame({"grp": group["grp"].iloc[:1], "passes": [high]})

    one = worst.filter("_worst = 0").select("grp", F.lit(1).cast("bigint").alias("passes"))
    several = counts.join(worst.filter("_worst > 0").select("grp"), "grp").groupBy("grp").applyInPandas(solve, "grp bigint, passes bigint")
    return written(one.unionByName(several), "vectors-passes")


def _windows(dealt: DataFrame, threshold: float) -> DataFrame:
    """``u, v``: a spanning forest of the links among a block (``home``) and between it and the next, in half precision."""

    def work(table: pa.Table, runs: np.ndarray) -> pa.RecordBatch:
        tids, groups, home = (table.column(c).to_numpy(zero_copy_only=False) for c in ("tid", "grp", "home"))
        raw = table.column("half").to_pylist()
        out: list[list[np.ndarray]] = [[], []]
        edges = np.flatnonzero(np.diff(runs)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(runs)], strict=True):
            # A block may hold the end of one group and the start of the next; only groups with a vector at home count.
            for one in np.unique(groups[lo:hi][home[lo:hi]]).tolist():
                mine = lo + np.flatnonzero(groups[lo:hi] == one)
                mine = np.concatenate((mine[home[mine]], mine[~home[mine]]))
                if len(mine) < 2:
                    continue
                x = np.frombuffer(b"".join(raw[i] for i in mine.tolist()), dtype=np.float16).reshape(len(mine), -1).astype(np.float32)
                a, b = np.nonzero(np.triu(x[: int(home[mine].sum())] @ x.T >= threshold - SLACK, 1))
                roots = local_roots(len(mine), a, b)
                moved = np.flatnonzero(roots != np.arange(len(mine)))
                for ends, local in zip(out, (moved, roots[moved]), strict=True):
                    ends.append(tids[mine[local]])
        columns = [pa.array(np.concatenate(v) if v else np.zeros(0, dtype=np.int64), pa.int64()) for v in out]
        return pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    return over_runs(dealt, "pass", work, "u bigint, v bigint")


def _forest_of(hashed: DataFrame, blocks: DataFrame, threshold: float) -> DataFrame:
    """``u, v``: a spanning forest of the links that the windows of these passes find."""
    # A vector is at home in its block's task and a guest in that of the block before. Its places are gathered first, so
    # that the vector itself is joined once.
    places = blocks.groupBy("tid").agg(F.collect_list(F.struct("pass", "_block")).alias("_places"))
    spread = hashed.select("tid", "grp", "half").join(places, "tid").select("tid", "grp", "half", F.inline("_places"))
    tasks = F.array(F.struct(F.col("_block").alias("low"), F.lit(True).alias("home")), F.struct((F.col("_block") - 1).alias("low"), F.lit(False).alias("home")))
    dealt = spread.select("tid", "grp", "half", "pass", F.inline(tasks)).withColumn("high", F.col("low"))
    return written(_windows(dealt, threshold), "vectors-forest")


def _keyed(hashed: DataFrame, passes: range) -> DataFrame:
    return hashed.select("tid", "grp", F.posexplode("keys").alias("pass", "key")).withColumn("pass", F.col("pass") + passes.start)


def sorted_passes(named: DataFrame, threshold: float, miss: float, block: int) -> DataFrame:
    """``tid, cluster``: vectors (``tid, grp, dim, vector``) that links found in the passes join; others are left out."""
    passes = range(FIRST_PASSES)
    means = _means(named)
    hashed = _hashed(named, means, passes, threshold)
    blocks = _blocks(_keyed(hashed, passes), block)
    found = _forest_of(hashed, blocks, threshold)
    # A cluster that fills windows shows as one root of more vectors than a block has.
    links = found.distinct()
    roots = links.groupBy("v").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block).select("v")
    wide = links.join(roots, "v").select(F.explode(F.array("u", "v")).alias("tid")).distinct()
    needed = _passes_needed(hashed, blocks, wide, threshold, miss).filter(F.col("passes") > FIRST_PASSES)
    if most := needed.agg(F.max("passes")).first()[0]:
        passes = range(FIRST_PASSES, most)
        hashed = _hashed(named.join(needed.select("grp"), "grp"), means, passes, threshold)
        keyed = _keyed(hashed, passes).join(needed, "grp").filter(F.col("pass") < F.col("passes")).select("tid", "grp", "pass", "key")
        found = found.unionByName(_forest_of(hashed, _blocks(keyed, block), threshold))
    return components(found).select(F.col("node").alias("tid"), F.col("root").alias("cluster"))


def _exact(members: DataFrame, threshold: float) -> DataFrame:
    """``tid, links, to``: links of each vector within a tile, copies included, and forest edges."""

    def work(table: pa.Table, runs: np.ndarray) -> pa.RecordBatch:
        tids, part, low, high, copies = (table.column(c).to_numpy() for c in ("tid", "part", "low", "high", "copies"))
        raw = table.column("vector").to_pylist()
        out: list[list[np.ndarray]] = [[], [], []]
        edges = np.flatnonzero(np.diff(runs)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(runs)], strict=True):
            if hi - lo < 2:
                continue
            x = np.frombuffer(b"".join(raw[lo:hi]), dtype=float).reshape(hi - lo, -1)
            times, n = copies[lo:hi].astype(float), hi - lo
            mixed = low[lo] != high[lo]
            rows = np.flatnonzero(part[lo:hi] == low[lo])
            across = np.flatnonzero(part[lo:hi] == high[lo])
            other, links = x[across], np.zeros(n)
            left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for at in range(0, len(rows), ROWS_AT_ONCE):
                some = rows[at : at + ROWS_AT_ONCE]
                near = x[some] @ other.T >= threshold
                if not mixed:
                    # Each pair once, below the diagonal.
                    near &= across[None, :] < some[:, None]
                a, b = np.nonzero(near)
                a, b = some[a], across[b]
                links += np.bincount(a, weights=times[b], minlength=n) + np.bincount(b, weights=times[a], minlength=n)
                # Only a forest of them is held.
                roots = local_roots(n, a, b)
                moved = np.flatnonzero(roots != np.arange(n))
                left.append(moved)
                right.append(roots[moved])
            roots = local_roots(n, np.concatenate(left), np.concatenate(right))
            told = (links > 0) | (roots != np.arange(n))
            for kept, values in zip(out, (tids[lo:hi][told], links[told].astype(np.int64), tids[lo:hi][roots[told]]), strict=True):
                kept.append(values)
        columns = [pa.array(np.concatenate(v) if v else np.zeros(0, dtype=np.int64), pa.int64()) for v in out]
        return pa.RecordBatch.from_arrays(columns, names=["tid", "links", "to"])

    return over_runs(members, "cluster", work, "tid bigint, links bigint, to bigint")


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    miss: float = 1e-4,
    block: int = BLOCK,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Only vectors of equal, non-null labels and equal length are compared. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the least key reachable by links, ``kept`` tells whether that is the row's own.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and so do rows with a
    null label: they are their own component. Repeated rows count as rows of their own, linked with each other.
    Columns other than the three named are ignored. An empty table gives an empty result.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("_vector")
    )
    rows = written(rows, "vectors")
    units = written(_units(rows.filter(F.col("label").isNotNull() & F.col("_vector").isNotNull())), "vectors-units")
    # Equal vectors are one from here on, with a multiplicity.
    same = ["label", "dim", "vector"]
    distinct = units.groupBy(*same).agg(F.min("_row").alias("tid"), F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    distinct = written(distinct, "vectors-distinct")
    groups = written(distinct.groupBy("label", "dim").agg(F.min("tid").alias("grp"), F.count(F.lit(1)).alias("_n")), "vectors-groups")
    named = distinct.join(groups, ["label", "dim"]).select("tid", "grp", "dim", "vector", "copies", "_n")
    several = named.filter(F.col("_n") > 1)
    clusters = sorted_passes(several, threshold, miss, block)
    clustered = written(distinct.select("tid", "vector", "copies").join(clusters, "tid").select("tid", "cluster", "vector", "copies"), "vectors-clusters")
    sizes = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    members = tiles(clustered.join(sizes, "cluster"), F.col("_n"), PART).drop("_n")
    found = written(_exact(members, threshold), "vectors-links")
    links = found.groupBy("tid").agg(F.sum("links").alias("_links"))
    roots = components(found.select(F.col("tid").alias("u"), F.col("to").alias("v"))).withColumnRenamed("node", "tid")
    rooted = distinct.select("tid", "vec_id", "copies").join(roots, "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    least = rooted.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    about = rooted.join(least, "root").join(links, "tid", "left")
    about = about.select("tid", "component_id", (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    repeated = units.join(distinct.filter(F.col("copies") > 1).select(*same, "tid"), same).select("_row", "tid")
    return (
        rows.select("_row", "vec_id")
        .join(repeated, "_row", "left")
        .withColumn("tid", F.coalesce("tid", "_row"))
        .join(about, "tid", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
        )
    )
