"""Token counts by rank-synchronous array merging of byte-pair encodings.

Pre-tokens of a batch are held as one ragged array of symbols. In every round each sequence merges all places of its
lowest-ranked pair at once (left to right where they overlap), which is what merging one pair at a time comes to, since
a merge can only make pairs of higher rank. Sequences without a pair left leave the array; their symbols are counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from assayer.llm.common import arrow_map

#: The split of text into pre-tokens that belongs to the byte-level vocabulary (fixed value).
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that all versions of Unicode in use class alike. Texts with others are split by the library itself.
PLAIN = regex.compile(r"[\u0000-\u0557\u2010-\u2027\u3000-\u30ff\u4e00-\u9fff\uac00-\ud7a3]*")
#: Counts a worker remembers. Beyond it, it starts anew: a bound on memory, not on the input.
REMEMBERED = 300_000
#: Characters whose pre-tokens are held at a time (one text more at most).
CHUNK = 2_000_000
NEVER = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(shifted)) for b in range(256)]


class RankMerger:
    """Counts tokens with the vocabulary and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.width = max(vocab.values()) + 1
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], dtype=np.int64)
        # Where a pair is listed twice, the later rank holds, as in the library's table.
        last = {int(k): i for i, k in enumerate(keys)}
        ranks = np.array(sorted(last.values()), dtype=np.int64)
        order = np.argsort(keys[ranks])
        self.keys, self.ranks = keys[ranks][order], ranks[order]
        self.products = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NEVER)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each byte string."""
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        counts = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        ranks = np.full(len(symbols), NEVER)  # of the pair that starts at each symbol
        if len(symbols) > 1:
            inside = owner[:-1] == owner[1:]
            ranks[:-1] = np.where(inside, self.rank(symbols[:-1], symbols[1:]), NEVER)
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            sizes = np.diff(np.append(starts, len(owner)))
            lowest = np.minimum.reduceat(ranks, starts)
            going = lowest != NEVER
            counts[owner[starts[~going]]] = sizes[~going]
            if not going.all():
                stay = np.repeat(going, sizes)
                symbols, owner, ranks = symbols[stay], owner[stay], ranks[stay]
                lowest, sizes = lowest[going], sizes[going]
                if not len(symbols):
                    break
            hit = ranks == np.repeat(lowest, sizes)
            place = np.arange(len(hit))
            # Of overlapping places (a run of one symbol) every other one is merged, from the left.
            first = hit & ~np.concatenate(([False], hit[:-1]))
            taken = np.flatnonzero(hit & ((place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0))
            symbols[taken] = self.products[ranks[taken]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[taken + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
            here = moved[taken]
            changed = np.unique(np.concatenate((here, here[here > 0] - 1)))
            ranks[changed] = NEVER
            changed = changed[changed < len(symbols) - 1]
            changed = changed[owner[changed] == owner[changed + 1]]
            ranks[changed] = self.rank(symbols[changed], symbols[changed + 1])
        return counts


class TextCounter:
    """Tokens of whole texts: special strings count one each, pre-tokens are counted once per batch and remembered."""

    def __init__(self, path: str):
        self.merger = RankMerger(path)
        self.pre_token = regex.compile(PRE_TOKEN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.merger.special, key=len, reverse=True))) or r"(?!)")
        self.known: dict[str, int] = {}
        self.library = ByteLevel(add_prefix_space=False)
        self.of_symbol = {c: b for b, c in enumerate(byte_symbols())}

    def _by_library(self, text: str) -> list[str]:
        shown = [piece for piece, _ in self.library.pre_tokenize_str(text)]
        return [bytes([self.of_symbol[c] for c in piece]).decode() for piece in shown]

    def _pieces(self, text: str) -> tuple[list[str], int]:
        found = self.pre_token.findall if PLAIN.fullmatch(text) else self._by_library
        if not self.special.search(text):
            return found(text), 0
        parts = self.special.split(text)
        return [piece for part in parts for piece in found(part)], len(parts) - 1

    def _learn(self, texts: list[list[str]]) -> None:
        new = {piece for pieces in texts for piece in pieces} - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = {piece for pieces in texts for piece in pieces}
        if new:
            ordered = list(new)
            counts = self.merger.count([p.encode("utf-8", "surrogatepass") for p in ordered])
            self.known.update(zip(ordered, counts.tolist(), strict=True))

    def counts(self, texts: Iterable[str]) -> Iterator[int]:
        held: list[tuple[list[str], int]] = []
        size = 0
        for text in texts:
            held.append(self._pieces(text))
            size += len(text)
            if size >= CHUNK:
                yield from self._flush(held)
                held, size = [], 0
        yield from self._flush(held)

    def _flush(self, held: list[tuple[list[str], int]]) -> list[int]:
        self._learn([pieces for pieces, _ in held])
        return [sum(map(self.known.__getitem__, pieces)) + special for pieces, special in held]


@lru_cache(maxsize=2)
def counter(path: str) -> TextCounter:
    """One per worker process and file."""
    return TextCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    ``tokenizer`` names a byte-level BPE file that every executor can read. No begin, end or added tokens are counted;
    special strings inside a text count one token each, as the tokenizer library has it by default.

    A null text counts as empty, with 0 tokens. Repeated rows are counted each. Columns other than the two named are
    ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("_text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        tokens = np.fromiter(counter(tokenizer).counts(texts), dtype=np.int64, count=len(texts))
        n_bytes = np.array([len(t.encode()) for t in texts], dtype=np.int64)
        columns = [batch.column(0), pa.array(n_bytes), pa.array(tokens), pa.array(tokens > limit)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return arrow_map(rows, each, schema)
