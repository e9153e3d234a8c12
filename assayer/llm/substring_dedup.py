"""Removal of passages that an earlier document already holds, by super-k-mer partitioning.

A window is ``WIDTH`` consecutive words. Its minimiser is the least hash of ``GRAM`` consecutive words in it. Consecutive
windows that share a minimiser travel as one packed string, a super-k-mer, to the bucket of the minimiser; equal windows
have equal minimisers and so meet there. In the bucket windows are sorted by hash, equal hashes are compared word for
word, and each window learns the least document that holds it. What has to go comes back to its document as places.

Super-k-mers of one bucket and chunk of input are compressed together, as consecutive ones overlap in twelve words. Two
things are found beforehand, each at most ``2 * HOT_PARTS`` and so small enough to send everywhere: minimisers with so
large a share of all windows that their bucket would grow with the input, whose windows travel singly to buckets of their
own, and such windows, of which a chunk sends one with its least document. Their occurrences are settled where they stand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from assayer.llm.common import reachable, written

WIDTH, GRAM = 13, 2
#: A minimiser or window with 1 / HOT_PARTS of all windows is hot.
HOT_PARTS = 2_000
#: Bytes of text looked at together, bytes whose super-k-mers are compressed together, and words hashed at a time.
SLICE_BYTES, CHUNK_BYTES, BLOCK_WORDS = 1 << 20, 16 << 20, 1 << 17
#: Bytes of super-k-mers meant for one bucket; they are about three times the text.
BUCKET_BYTES = 16 << 20
#: A null id counts as greater than any other.
NULL_ID = (1 << 63) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(0, 1 << 62, dtype=np.uint64)) * 2 + 1


_BYTE_BASE, _WORD_BASE, _LENGTH, _SECOND = (_odd(seed) for seed in (11, 12, 13, 14))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2 ** 64, as many as were asked for so far."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """The polynomial hash of ``values[start:end]`` for each pair, from one running sum."""
    up, down = powers.of(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def normal(text: bytes) -> bytes:
    """The words of a text with one blank between them."""
    if not text:
        return text
    raw = np.frombuffer(text, dtype=np.uint8)
    space = _SPACE[raw]
    keep = ~space
    keep[1:] |= ~space[:-1]
    return np.where(space, np.uint8(0x20), raw)[keep].tobytes().strip(b" ")


@dataclass
class Words:
    """The words of some normal texts, put together with a newline after each."""

    buffer: bytes
    starts: np.ndarray
    ends: np.ndarray
    #: Which text a word is of, and the number of each text's first word.
    text: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        buffer = b"\n".join([*texts, b""])
        raw = np.frombuffer(buffer, dtype=np.uint8)
        space = (raw == 0x20) | (raw == 0x0A)
        before, after = np.concatenate(([True], space[:-1])), np.concatenate((space[1:], [True]))
        starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        text = np.searchsorted(offsets, starts, side="right") - 1
        return cls(buffer, starts, ends, text, np.searchsorted(text, np.arange(len(texts))))

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``at, window, minimiser`` of all windows: the number of the first word and two hashes, a block at a time."""
        n = len(self.starts)
        for a in range(0, n - WIDTH + 1, BLOCK_WORDS):
            b = min(n, a + BLOCK_WORDS + WIDTH - 1)
            base, starts, ends = self.starts[a], self.starts[a:b], self.ends[a:b]
            raw = np.frombuffer(self.buffer, dtype=np.uint8)[base : ends[-1]].astype(np.uint64) + np.uint64(1)
            words = _mixed(_rolling(raw, starts - base, ends - base, _BYTES) + (ends - starts).astype(np.uint64) * np.uint64(_LENGTH))
            places = np.arange(b - a - WIDTH + 1)
            window = _mixed(_rolling(words, places, places + WIDTH, _WORDS))
            grams = _mixed(words[:-1] * np.uint64(_SECOND) + words[1:])
            inside = self.text[a : b - WIDTH + 1] == self.text[a + WIDTH - 1 : b]
            yield places[inside] + a, window[inside], _sliding_least(grams, WIDTH - GRAM + 1)[inside]

    def phrase(self, at: int, windows: int = 1) -> bytes:
        """The words of so many consecutive windows."""
        return self.buffer[self.starts[at] : self.ends[at + windows + WIDTH - 2]]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    span = 1
    while 2 * span <= width:
        values, span = np.minimum(values[:-span], values[span:]), 2 * span
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``known`` ones."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[Words, list[tuple]]]:
    """Consecutive texts of about ``limit`` bytes together, or a longer one alone, with the other columns of their rows."""
    texts, rows, held = [], [], 0
    for batch in batches:
        others = [column.to_pylist() for column in batch.columns[1:]]
        for cell, *row in zip(batch.column(0), *others, strict=True):
            text = normal((cell.as_py() or "").encode("utf-8", "surrogatepass"))
            if texts and held + len(text) > limit:
                yield Words.of(texts), rows
                texts, rows, held = [], [], 0
            texts.append(text)
            rows.append(tuple(row))
            held += len(text)
    if texts:
        yield Words.of(texts), rows


# ---- what is hot ----


def _tallies(docs: DataFrame) -> DataFrame:
    """``kind, key, n``: frequent minimisers (m) and windows (w) of each slice, and the number of all windows (a) and bytes (b).

    A key with 1 / HOT_PARTS of all windows has this share in some slice, so none is missed that a slice does not name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in _slices(batches):
            found = list(words.windows())
            if not found:
                continue
            kinds, keys, counts = ["a", "b"], [0, 0], [sum(len(at) for at, _, _ in found), len(words.buffer)]
            for kind, column in (("w", 1), ("m", 2)):
                values, n = np.unique(np.concatenate([f[column] for f in found]), return_counts=True)
                often = n * HOT_PARTS >= counts[0]
                kinds += [kind] * int(often.sum())
                keys += values[often].astype(np.int64).tolist()
                counts += n[often].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["kind", "key", "n"])

    return docs.select("text").mapInArrow(run, "kind string, key bigint, n bigint")


@dataclass(frozen=True)
class Plan:
    """The number of buckets, and the hot minimisers and windows, sorted."""

    buckets: int
    minimisers: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    windows: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))


def plan_of(docs: DataFrame) -> Plan:
    """Counts over all texts, once. What slices name adds up to all windows at most, so few keys pass the limit."""
    counts = written(_tallies(docs).groupBy("kind", "key").agg(F.sum("n").alias("n")), "passage-tallies")
    totals = {r["kind"]: r["n"] for r in counts.filter("kind IN ('a', 'b')").collect()}
    hot: dict[str, list[int]] = {"m": [], "w": []}
    # Half the limit: a key may have escaped the slices where it is less frequent. At most 2 * HOT_PARTS of each kind.
    least = max(3.0, totals.get("a", 0) / (2 * HOT_PARTS))
    for r in counts.filter(F.col("kind").isin("m", "w") & (F.col("n") >= least)).collect():
        hot[r["kind"]].append(r["key"])
    sets = [np.sort(np.array(hot[kind], dtype=np.int64).view(np.uint64)) for kind in ("m", "w")]
    return Plan(1 + 3 * totals.get("b", 0) // BUCKET_BYTES, *sets)


# ---- super-k-mers ----

_META = np.dtype([("id", "<i8"), ("tag", "<i8"), ("at", "<i4")])


def _pieces(words: Words, rows: list[tuple], plan: Plan) -> Iterator[tuple[bool, int, bytes, int, int, int]]:
    """``hot, bucket, phrase, id, tag, at`` of all super-k-mers; ``at`` is the window's place in its text."""
    for at, window, least in words.windows():
        if not len(at):
            continue
        hot, single = _among(window, plan.windows), _among(least, plan.minimisers)
        key = np.where(hot | single, window, least)
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1) | single[1:] | hot[1:] | hot[:-1]
        first = np.flatnonzero(fresh)
        sizes = np.diff(np.append(first, len(at)))
        text = words.text[at[first]]
        places = at[first] - words.first[text]
        buckets = (key[first] % np.uint64(plan.buckets)).astype(np.int64)
        columns = (hot[first], buckets, words.starts[at[first]], words.ends[at[first] + sizes + WIDTH - 2], text, places)
        for is_hot, bucket, start, end, t, place in zip(*[c.tolist() for c in columns], strict=True):
            doc, tag = rows[t]
            yield is_hot, bucket, words.buffer[start:end], NULL_ID if doc is None else doc, tag, place


def _packed(docs: DataFrame, plan: Plan) -> DataFrame:
    """``bucket, hot, phrases, meta``: the super-k-mers of a chunk of input that go to one bucket, compressed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        held: dict[tuple[bool, int], tuple[list[bytes], list[tuple]]] = {}
        once: dict[bytes, tuple[int, int]] = {}
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for phrase, (bucket, doc) in once.items():
                phrases, meta = held.setdefault((True, bucket), ([], []))
                phrases.append(phrase)
                meta.append((doc, 0, 0))
            for (is_hot, bucket), (phrases, meta) in held.items():
                columns = [
                    pa.array([bucket], pa.int64()),
                    pa.array([is_hot], pa.bool_()),
                    pa.array([squeeze(b"\n".join(phrases))], pa.binary()),
                    pa.array([squeeze(np.concatenate([np.array([m[k] for m in meta], dtype=_META[k]).view(np.uint8) for k in range(3)]))], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "hot", "phrases", "meta"])
            held.clear()
            once.clear()

        for words, rows in _slices(batches):
            for is_hot, bucket, phrase, doc, tag, place in _pieces(words, rows, plan):
                if is_hot:
                    known = once.get(phrase)
                    once[phrase] = (bucket, doc if known is None else min(doc, known[1]))
                    continue
                phrases, meta = held.setdefault((False, bucket), ([], []))
                phrases.append(phrase)
                meta.append((doc, tag, place))
            size += len(words.buffer)
            if size >= CHUNK_BYTES:
                yield from flushed()
                size = 0
        yield from flushed()

    return docs.select("text", "id", "tag").mapInArrow(run, "bucket bigint, hot boolean, phrases binary, meta binary")


def _least_ids(words: Words, at: np.ndarray, window: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each window of a bucket the least id among equal ones: sorted by hash, then compared by their words."""
    order = np.argsort(window)
    sorted_ids, hashes = ids[order], window[order]
    start = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    count = np.diff(np.append(start, len(order)))
    low, high = np.minimum.reduceat(sorted_ids, start), np.maximum.reduceat(sorted_ids, start)
    least = np.repeat(low, count)
    # Where only one document holds a hash, nothing can have to go.
    shared = low != high
    for s, n in zip(start[shared].tolist(), count[shared].tolist(), strict=True):
        phrases = [words.phrase(w) for w in at[order[s : s + n]].tolist()]
        if any(p != phrases[0] for p in phrases):
            own: dict[bytes, int] = {}
            for phrase, doc in zip(phrases, sorted_ids[s : s + n].tolist(), strict=True):
                own[phrase] = min(doc, own.get(phrase, doc))
            least[s : s + n] = [own[p] for p in phrases]
    smallest = np.empty_like(least)
    smallest[order] = least
    return smallest


def _found(packed: DataFrame) -> DataFrame:
    """``id, tag, at, n``: runs of windows to be covered; and ``phrase, id`` of hot windows with their least document."""

    def settle(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        phrases, metas, hot = [], [], []
        for is_hot, packed_phrases, packed_meta in group:
            new = expand(packed_phrases).split(b"\n")
            raw = expand(packed_meta)
            meta = np.empty(len(new), dtype=_META)
            for name, offset in (("id", 0), ("tag", 8), ("at", 16)):
                meta[name] = np.frombuffer(raw, dtype=_META[name], count=len(new), offset=offset * len(new))
            phrases += new
            metas.append(meta)
            hot.append(np.full(len(new), is_hot))
        meta, hot = np.concatenate(metas), np.concatenate(hot)
        words = Words.of(phrases)
        at, window = (np.concatenate(parts) for parts in zip(*[(a, w) for a, w, _ in words.windows()], strict=True))
        piece = words.text[at]
        smallest = _least_ids(words, at, window, meta["id"][piece])
        gone = (smallest < meta["id"][piece]) & ~hot[piece]
        place = meta["at"][piece] + (at - words.first[piece])
        # Consecutive windows of a piece go back as one run.
        index = np.flatnonzero(gone)
        fresh = np.ones(len(index), dtype=bool)
        fresh[1:] = (piece[index][1:] != piece[index][:-1]) | (at[index][1:] != at[index][:-1] + 1)
        first = np.flatnonzero(fresh)
        runs = meta[piece[index[first]]] if len(first) else meta[:0]
        sizes = np.diff(np.append(first, len(index)))
        yield _rows_out(runs["id"], runs["tag"], place[index[first]], sizes, None)
        tops = {phrases[p]: int(smallest[w]) for w, p in enumerate(piece.tolist()) if hot[p]} if hot.any() else {}
        if tops:
            zero = np.zeros(len(tops), dtype=np.int64)
            yield _rows_out(np.array(list(tops.values()), dtype=np.int64), zero, zero, zero, list(tops))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, group = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                here, *rest = (column[row].as_py() for column in batch.columns)
                if here != bucket:
                    if group:
                        yield from settle(group)
                    bucket, group = here, []
                group.append(tuple(rest))
        if group:
            yield from settle(group)

    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "id bigint, tag bigint, at bigint, n bigint, phrase binary")


def _rows_out(ids, tags, places, sizes, phrases) -> pa.RecordBatch:
    columns = [pa.array(np.asarray(c, dtype=np.int64), pa.int64()) for c in (ids, tags, places, sizes)]
    phrase = pa.nulls(len(ids), pa.binary()) if phrases is None else pa.array(phrases, pa.binary())
    return pa.RecordBatch.from_arrays([*columns, phrase], names=["id", "tag", "at", "n", "phrase"])


# ---- back at the documents ----


def _covered(words: Words, text: int, runs: list | None, count: int) -> np.ndarray:
    """Which words of a text lie under the given runs of windows."""
    edges = np.zeros(count + 1, dtype=np.int64)
    for run in runs or ():
        edges[run["at"]] += 1
        edges[run["at"] + run["n"] + WIDTH - 1] -= 1
    return np.cumsum(edges[:-1]) > 0


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, text_left``, the words left with one blank between them.

    A word goes when a window over it also starts in a document with a smaller id; windows are judged on the input.
    Rows that share an id do not remove each other's words. A null id counts as greater than any other. A null text is
    empty, one without a full window stays as it is. Columns other than the two named are ignored. An empty table gives
    an empty result.
    """
    reachable(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(content.alias("text"), F.col(key).cast("bigint").alias("id"), F.xxhash64(content).alias("tag"), F.col(key).alias("doc_id"))
    plan = plan_of(rows)
    found = written(_found(_packed(rows, plan)), "passages")
    # At most 2 * HOT_PARTS phrases, and the hash collisions among them.
    hot: dict[bytes, int] = {bytes(r["phrase"]): r["id"] for r in found.filter("phrase IS NOT NULL").select("phrase", "id").collect()} if len(plan.windows) else {}
    runs = (
        found.filter("phrase IS NULL")
        .groupBy(F.col("id").alias("_id"), F.col("tag").alias("_tag"))
        .agg(F.collect_set(F.struct("at", "n")).alias("runs"))
    )
    known_id = F.coalesce(F.col("id"), F.lit(NULL_ID))
    joined = rows.join(runs.hint("merge"), (known_id == F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")
    hot_windows, id_type = plan.windows, to_arrow_type(docs.schema[key].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, others in _slices(batches):
            counts = np.diff(np.append(words.first, len(words.starts)))
            gone = np.concatenate([_covered(words, t, row[2], int(counts[t])) for t, row in enumerate(others)])
            if hot:
                for at, window, _ in words.windows():
                    for w in at[_among(window, hot_windows)].tolist():
                        doc = others[words.text[w]][0]
                        if hot.get(words.phrase(w), NULL_ID) < (NULL_ID if doc is None else doc):
                            gone[w : w + WIDTH] = True
            left = [_rest(words, int(first), int(n), gone) for first, n in zip(words.first, counts, strict=True)]
            removed = [int(gone[f : f + n].sum()) for f, n in zip(words.first.tolist(), counts.tolist(), strict=True)]
            columns = [pa.array([r[1] for r in others], id_type), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "text_left"])

    return joined.select("text", "id", "doc_id", "runs").mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, text_left string")


def _rest(words: Words, first: int, n: int, gone: np.ndarray) -> str:
    """The words of a text that are left, taken in runs."""
    kept = np.flatnonzero(np.diff(np.concatenate(([0], (~gone[first : first + n]).astype(np.int8), [0]))))
    parts = [words.buffer[words.starts[first + a] : words.ends[first + b - 1]] for a, b in zip(kept[::2].tolist(), kept[1::2].tolist(), strict=True)]
    return b" ".join(parts).decode("utf-8", "surrogatepass")


def passage_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of :func:`without_repeats`."""
    left = without_repeats(docs)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text_left", 256).alias("kept_sha256"))
