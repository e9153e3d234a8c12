"""Jaccard join on word n-grams with Bayesian candidate pruning.

Texts with the same words are one text from the start. Every text gets a MinHash signature; texts that agree in a whole
band of it are candidates. Candidate pairs compare their signatures a step at a time; after each step a pair is dropped
when, given its matches so far, the posterior probability of its similarity reaching the threshold is below a
tolerance. Texts joined by the pairs left form clusters, and within these the n-gram sets are compared exactly.

Buckets and clusters of any size are cut into tiles of at most two parts of ``PART`` texts, so that no task holds a
whole group and no pair is ever written out: a tile gives sums and the edges of a spanning forest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import arrow_map, reachable, small_batches, written
from assayer.llm.components import components, local_roots

#: A pair at similarity 0.8 shares no band with probability (1 - 0.8 ** 5) ** 30, about 7 in a million.
BANDS, BAND_ROWS = 30, 5
#: Hashes compared before each look at the posterior.
STEP = 15
#: Posterior probability of reaching the threshold below which a pair is dropped.
TOLERANCE = 1e-6
#: Texts of one side of a tile.
PART = 256
#: Word hashes a worker remembers. Beyond it, it starts anew: a bound on memory, not on the input.
REMEMBERED = 400_000
#: N-grams hashed at a time.
ROWS_AT_ONCE = 2048
SEED = 20_240_502


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


@lru_cache(maxsize=4)
def _parameters(kind: str, n: int) -> np.ndarray:
    """Fixed random odd multipliers and offsets."""
    draw = np.random.default_rng([SEED, n, *kind.encode()])
    return draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _over_texts(df: DataFrame, each: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``each`` over small batches; what a worker remembers of words goes with the task, not into later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                if batch.num_rows:
                    yield from each(batch)
        finally:
            _word_hashes.cache_clear()

    reachable(df.sparkSession)
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def words_of(text: str | None) -> list[bytes]:
    """Words are runs of anything but ASCII white space, as they stand."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def text_key(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words), usedforsecurity=False).digest()


def shingles(words: list[bytes], width: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of all runs of ``width`` words; of a shorter text, of all its words."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known = _word_hashes()
    hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    factors = _parameters("shingle", 16 * ((width + 15) // 16))
    n = len(hashes) - width + 1
    mixed = np.full(n, np.uint64(width))
    for k in range(width):
        mixed += hashes[k : k + n] * factors[k]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def signature(grams: np.ndarray) -> np.ndarray:
    """The MinHash signature, ``BANDS * BAND_ROWS`` numbers of 32 bits."""
    size = BANDS * BAND_ROWS
    factors, offsets = _parameters("minhash", size), _parameters("offset", size)
    least = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), ROWS_AT_ONCE):
        least = np.minimum(least, (grams[at : at + ROWS_AT_ONCE, None] * factors + offsets).min(axis=0))
    return (least >> np.uint64(32)).astype("<u4")


@lru_cache(maxsize=4)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """After 1, 2, ... steps, the matches a pair needs to stay.

    With a uniform prior the similarity has a beta posterior after m of n matches, and reaches the threshold t with the
    probability that a binomial of n + 1 trials at t gives at most m.
    """
    needed = []
    for n in range(STEP, BANDS * BAND_ROWS + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance and m < n:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        needed.append(m)
    return tuple(needed)


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, text_hash, key, sig, place`` of each document; without words, key and signature are null."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, sigs = [], []
        for cell in batch.column(1):
            words = words_of(cell.as_py())
            keys.append(text_key(words) if words else None)
            sigs.append(signature(shingles(words, width)).tobytes() if words else None)
        columns = [batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "key", "sig"])

    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    signed = _over_texts(hashed, each, f"doc_id {kind}, text_hash bigint, key binary, sig binary")
    return signed.withColumn("place", F.monotonically_increasing_id())


def _band_keys(texts: DataFrame) -> DataFrame:
    """``bucket, tid``: one row for each text and band."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u4").reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
        factors = _parameters("band", BANDS * BAND_ROWS).reshape(BANDS, BAND_ROWS)
        mixed = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sig.shape[:2]).copy()
        for k in range(BAND_ROWS):
            mixed = (mixed + sig[:, :, k]) * factors[:, k]
            mixed ^= mixed >> np.uint64(31)
        tids = np.repeat(batch.column(0).to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(mixed.ravel().view(np.int64)), pa.array(tids)], names=["bucket", "tid"])

    return arrow_map(texts.select("tid", "sig"), each, "bucket bigint, tid bigint")


def tiles(members: DataFrame, size: Column, part: int | None = None) -> DataFrame:
    """A row for each tile a member belongs to: ``low, high`` number the tile's two parts, ``part`` is its own."""
    parts = F.ceil(size / F.lit(part or PART)).cast("int")
    own = members.withColumn("part", F.pmod(F.xxhash64("tid"), parts).cast("int")).withColumn("_all", F.sequence(F.lit(0), parts - 1))
    spread = own.select("*", F.explode("_all").alias("_other")).drop("_all")
    return spread.withColumn("low", F.least("part", "_other")).withColumn("high", F.greatest("part", "_other")).drop("_other")


def over_runs(df: DataFrame, group: str, work: Callable[[pa.Table, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` over whole runs of equal (``group``, ``low``, ``high``), many at a time; a tile never is in two calls."""

    def number(table: pa.Table) -> np.ndarray:
        keys = [table.column(c).to_numpy() for c in (group, "low", "high")]
        change = np.zeros(table.num_rows, dtype=bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        return np.cumsum(change)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
            if not held.num_rows:
                continue
            runs = number(held)
            end = int(np.searchsorted(runs, runs[-1]))
            if end:
                yield work(held.slice(0, end), runs[:end])
                held = held.slice(end)
        if held is not None and held.num_rows:
            yield work(held, number(held))

    reachable(df.sparkSession)
    dealt = df.repartition(group, "low", "high").sortWithinPartitions(group, "low", "high")
    return dealt.mapInArrow(run, schema)


def _surviving(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``u, v``: a spanning forest of the pairs left after pruning, tile by tile."""
    needed = least_matches(threshold, tolerance)

    def work(table: pa.Table, runs: np.ndarray) -> pa.RecordBatch:
        tids = table.column("tid").to_numpy()
        part = table.column("part").to_numpy()
        mixed = table.column("low").to_numpy() != table.column("high").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype="<u4").reshape(len(tids), -1)
        left, right, first, shift = [], [], np.arange(len(tids)), 0
        while len(first):
            shift += 1
            first = first[first < len(tids) - shift]
            first = first[runs[first] == runs[first + shift]]
            a = first[~mixed[first] | (part[first] != part[first + shift])]
            b = a + shift
            matches = np.zeros(len(a), dtype=np.int64)
            for step, least in enumerate(needed):
                columns = slice(step * STEP, (step + 1) * STEP)
                matches += (sig[a, columns] == sig[b, columns]).sum(axis=1)
                stay = matches >= least
                a, b, matches = a[stay], b[stay], matches[stay]
            left.append(a)
            right.append(b)
        names, at = np.unique(tids, return_inverse=True)
        a, b = (at[np.concatenate(x)] if x else np.zeros(0, dtype=np.int64) for x in (left, right))
        roots = local_roots(len(names), a, b)
        moved = roots != np.arange(len(names))
        return pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[roots[moved]])], names=["u", "v"])

    return over_runs(members, "bucket", work, "u bigint, v bigint")


def shared_grams(sets: list[np.ndarray], at_once: int = 4096) -> np.ndarray:
    """The number of common elements of every two of some sorted sets, by products of slices of their incidence matrix."""
    sizes = np.array([len(s) for s in sets])
    names, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    # Elements of one set only add nothing to the pairs.
    common = np.flatnonzero(np.bincount(column, minlength=len(names)) > 1)
    place = np.full(len(names), -1)
    place[common] = np.arange(len(common))
    column = place[column]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)))
    for start in range(0, len(common), at_once):
        lo, hi = np.searchsorted(column, [start, start + at_once])
        block = np.zeros((len(sets), min(at_once, len(common) - start)), dtype=np.float32)
        block[row[lo:hi], column[lo:hi] - start] = 1
        total += block @ block.T
    total[np.arange(len(sets)), np.arange(len(sets))] = sizes
    return total.astype(np.int64)


def _verified(members: DataFrame, threshold: float) -> DataFrame:
    """``tid, texts, copies, to``: links of each text in a tile (texts, and documents with them) and forest edges."""

    def work(table: pa.Table, runs: np.ndarray) -> pa.RecordBatch:
        tids, part, copies = (table.column(c).to_numpy() for c in ("tid", "part", "copies"))
        mixed = table.column("low").to_numpy() != table.column("high").to_numpy()
        raw = table.column("set").to_pylist()
        out: list[list[np.ndarray]] = [[], [], [], []]
        edges = np.flatnonzero(np.diff(runs)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(runs)], strict=True):
            if hi - lo < 2:
                continue
            sets = [np.frombuffer(r, dtype="<u8") for r in raw[lo:hi]]
            both = shared_grams(sets)
            size = np.diag(both)
            links = both / np.maximum(1, size[:, None] + size[None, :] - both) >= threshold
            np.fill_diagonal(links, False)
            if mixed[lo]:
                links &= part[lo:hi, None] != part[None, lo:hi]
            roots = local_roots(hi - lo, *np.nonzero(np.triu(links)))
            for kept, values in zip(out, (tids[lo:hi], links.sum(axis=1), links @ copies[lo:hi], tids[lo:hi][roots]), strict=True):
                kept.append(values)
        columns = [pa.array(np.concatenate(x) if x else np.zeros(0, dtype=np.int64), pa.int64()) for x in out]
        return pa.RecordBatch.from_arrays(columns, names=["tid", "texts", "copies", "to"])

    return over_runs(members, "cluster", work, "tid bigint, texts bigint, copies bigint, to bigint")


def _gram_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``tid, set`` of the texts in ``wanted`` (``tid, doc_id, key``), from the documents that stand for them."""
    asked = wanted.select(F.col("doc_id").alias("_doc"), "tid", F.col("key").alias("_key"))
    # Few texts are asked for in a small table, too many to broadcast in a large one: the plan is the same for both.
    texts = docs.join(asked.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_doc"))).select("tid", "_key", "text")

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tids, sets = [], []
        for tid, key, text in zip(*(batch.column(i) for i in range(3)), strict=True):
            words = words_of(text.as_py())
            # Another document may have the same id.
            if text_key(words) == key.as_py():
                tids.append(tid.as_py())
                sets.append(shingles(words, width).astype("<u8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(tids, pa.int64()), pa.array(sets, pa.binary())], names=["tid", "set"])

    return _over_texts(texts, each, "tid bigint, set binary")


def near_duplicates(
    docs: DataFrame,
    threshold: float = 0.8,
    width: int = 5,
    tolerance: float = TOLERANCE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, n_text_links, kept``.

    ``n_links`` counts the other documents whose sets of ``width``-word shingles have a Jaccard similarity of
    ``threshold`` or more, copies included; ``n_text_links`` the different texts among them. ``class_id`` is the least
    id reachable by links. One row of each class is ``kept``: the first read of those with that id.

    Texts of fewer words than ``width`` have one shingle, all their words. Documents without words (null or empty)
    link with nothing, are their own class and ``kept``. Null ids come last in their class; a class of null ids alone
    has a null class id. Repeated rows are linked like other copies. Columns other than the two named are ignored. An
    empty table gives an empty result.
    """
    return linked_rows(docs, threshold, width, tolerance, key, text).drop("text_hash")


def first_of_each(docs: DataFrame, threshold: float = 0.8, width: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one document of each class does: the one with the least id.

    Rows that repeat id and text stay once. All columns are kept.
    """
    rows = linked_rows(docs, threshold, width, TOLERANCE, key, text)
    judged = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"), F.bool_or("kept").alias("kept")).filter("kept")
    judged = written(judged.drop("kept"), "join-kept")
    # Rows travel as one struct, so that their column names clash with nothing.
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("of"), F.xxhash64(F.col(text).cast("string")).alias("hash"))
    stay = rows.join(judged, F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")))
    once = stay.filter(F.col("times") == 1)
    if not judged.filter(F.col("times") > 1).isEmpty():
        once = once.unionByName(stay.filter(F.col("times") > 1).dropDuplicates(["doc_id", "text_hash"]))
    return once.select("row.*")


def linked_rows(
    docs: DataFrame,
    threshold: float,
    width: int,
    tolerance: float,
    key: str,
    text: str,
) -> DataFrame:
    """The rows of ``near_duplicates`` with ``text_hash``, the hash of the text as it stands."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = written(_signatures(rows, width), "join-signatures")
    # One row per text; its document with the least id stands for it.
    counted = signed.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    counted = written(counted.withColumn("tid", F.monotonically_increasing_id()), "join-texts")
    sigs = signed.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), "sig").filter(F.col("_key").isNotNull())
    texts = written(
        counted.join(sigs, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc"))).select("tid", "sig"), "join-texts-signed"
    )
    entries = written(_band_keys(texts).distinct(), "join-bands")
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    members = tiles(entries.join(sizes, "bucket"), F.col("_n")).drop("_n")
    # Documents repeated with their id stand for a text several times.
    repeated = _repeats(texts)
    unique = texts.dropDuplicates(["tid"]) if repeated else texts
    left = written(_surviving(members.join(unique, "tid"), threshold, tolerance), "join-survivors")
    clusters = components(left).select(F.col("node").alias("tid"), F.col("root").alias("cluster"))
    clustered = written(clusters.join(counted, "tid"), "join-clusters")
    cluster_sizes = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
    sets = _gram_sets(rows, clustered, width)
    heavy = tiles(clustered.select("tid", "cluster", "copies").join(cluster_sizes, "cluster"), F.col("_n")).drop("_n")
    single = sets.dropDuplicates(["tid"]) if repeated else sets
    checked = written(_verified(heavy.hint("merge").join(single, "tid"), threshold), "join-links")
    links = checked.groupBy("tid").agg(F.sum("texts").alias("_texts"), F.sum("copies").alias("_copies"))
    classes = components(checked.select(F.col("tid").alias("u"), F.col("to").alias("v"))).withColumnRenamed("node", "tid")
    named = counted.join(classes, "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    about = (
        named.join(least, "root")
        .join(links, "tid", "left")
        .select(
            F.col("key").alias("_key"),
            "root",
            "class_id",
            (F.coalesce("_copies", F.lit(0)) + F.col("copies") - 1).alias("_links"),
            F.coalesce("_texts", F.lit(0)).alias("_text_links"),
        )
    )
    told = signed.select("doc_id", "text_hash", "key", "place").join(about, F.col("key") == F.col("_key"), "left")
    told = written(
        told.select(
            "doc_id",
            F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("_text_links", F.lit(0)).cast("bigint").alias("n_text_links"),
            "text_hash",
            "place",
            "root",
        ),
        "join-rows",
    )
    # Several rows may have a class's least id, as it may be repeated or null.
    standing = told.filter(F.col("root").isNotNull() & F.col("doc_id").eqNullSafe(F.col("class_id")))
    first = standing.groupBy("root").agg(F.min("place").alias("_first")).select("_first")
    return told.join(first, F.col("place") == F.col("_first"), "left").select(
        "doc_id", "class_id", "n_links", "n_text_links", "text_hash", (F.col("root").isNull() | F.col("_first").isNotNull()).alias("kept")
    )


def _repeats(texts: DataFrame) -> bool:
    """Whether a text stands in several rows."""
    total, different = texts.agg(F.count(F.lit(1)), F.count_distinct("tid")).first()
    return total != different
