"""Wavelet matrix: a sequence of token ids as succinct bit-planes with rank and select.

Plane by plane, from the highest bit, the ids are split stably into those with a 0 bit, in front, and those with a 1
bit. A plane is a bit vector with running counts every ``BLOCK`` bits; with its number of zeros that is enough to
follow any position or range down the planes and back up.

The bytes are: a header (magic, number of ids, planes, zeros of each plane), then each plane's bits and running counts,
one zstandard frame per plane, with the frames' lengths in the header.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WVM1"
#: Bits between two running counts.
BLOCK = 4096
#: Set bits of each byte value.
ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)


class WaveletMatrix:
    def __init__(self, size: int, zeros: list[int], planes: list[np.ndarray], counts: list[np.ndarray]):
        self.size, self.zeros, self.planes, self.counts = size, zeros, planes, counts

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        """Of any ids up to 32 bits; with as many planes as the largest needs, one at least."""
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        row = ids.astype(np.uint16 if width <= 16 else np.uint32)
        zeros, planes, counts = [], [], []
        for shift in range(width - 1, -1, -1):
            bits = (row & row.dtype.type(1 << shift)) != 0
            packed = np.packbits(bits)
            planes.append(packed)
            counts.append(_running(packed))
            # Places first, then their ids: a mask as an index is several times slower.
            front = row.take(np.flatnonzero(~bits))
            zeros.append(len(front))
            row = np.concatenate((front, row.take(np.flatnonzero(bits))))
        return cls(len(ids), zeros, planes, counts)

    def to_bytes(self) -> bytes:
        pack = zstandard.ZstdCompressor(level=1)
        frames = [pack.compress(p.tobytes() + c.astype("<u4").tobytes()) for p, c in zip(self.planes, self.counts, strict=True)]
        width = len(self.planes)
        head = struct.pack(f"<4sQI{width}Q{width}Q", MAGIC, self.size, width, *self.zeros, *map(len, frames))
        return head + b"".join(frames)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        magic, size, width = struct.unpack_from("<4sQI", data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        numbers = struct.unpack_from(f"<{2 * width}Q", data, 16)
        at, unpack, planes, counts = 16 + 16 * width, zstandard.ZstdDecompressor(), [], []
        for length in numbers[width:]:
            raw = unpack.decompress(data[at : at + length])
            bits = (size + 7) // 8
            planes.append(np.frombuffer(raw, dtype=np.uint8, count=bits))
            counts.append(np.frombuffer(raw, dtype="<u4", offset=bits).astype(np.int64))
            at += length
        return cls(size, list(numbers[:width]), planes, counts)

    def _ones(self, plane: int, end: int) -> int:
        """Set bits of a plane before ``end``."""
        block = end // BLOCK
        bits, total = self.planes[plane], int(self.counts[plane][block])
        start, whole = block * BLOCK // 8, end // 8
        total += int(ONES[bits[start:whole]].sum())
        return total + int(ONES[bits[whole] >> (8 - end % 8)]) if end % 8 else total

    def _bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][at // 8] >> (7 - at % 8)) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        token = 0
        for plane, zeros in enumerate(self.zeros):
            bit = self._bit(plane, at)
            ones = self._ones(plane, at)
            at = zeros + ones if bit else at - ones
            token = token << 1 | bit
        return token

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` within [start, end) lie below the last plane."""
        width = len(self.zeros)
        if token < 0 or token >> width:
            return 0, 0
        for plane, zeros in enumerate(self.zeros):
            before, until = self._ones(plane, start), self._ones(plane, end)
            if token >> (width - 1 - plane) & 1:
                start, end = zeros + before, zeros + until
            else:
                start, end = start - before, end - until
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of ``token`` in [start, end)."""
        first, last = self._range(token, start, self.size if end is None else end)
        return last - first

    def select(self, token: int, nth: int) -> int:
        """The position of the occurrence number ``nth``, from 0."""
        first, last = self._range(token, 0, self.size)
        if not 0 <= nth < last - first:
            raise IndexError(nth)
        at = first + nth
        for plane in range(len(self.zeros) - 1, -1, -1):
            zeros = self.zeros[plane]
            at = self._place(plane, 1, at - zeros) if at >= zeros else self._place(plane, 0, at)
        return at

    def _place(self, plane: int, bit: int, nth: int) -> int:
        """The position of set (or unset) bit number ``nth`` of a plane: a search over running counts, then one block."""
        counts = self.counts[plane]
        if not bit:
            counts = np.arange(len(counts)) * BLOCK - counts
        block = int(np.searchsorted(counts, nth, side="right")) - 1
        start = block * BLOCK // 8
        bits = np.unpackbits(self.planes[plane][start : start + BLOCK // 8])[: self.size - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(bits == bit)[nth - int(counts[block])])

    def positions(self, token: int) -> list[int]:
        return [self.select(token, i) for i in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids, from the last plane up: there a plane's zeros and ones go back to their places."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        row = np.zeros(self.size, dtype=kind)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            bits = np.unpackbits(plane, count=self.size).astype(bool)
            up = np.empty_like(row)
            up[np.flatnonzero(~bits)] = row[:zeros]
            up[np.flatnonzero(bits)] = row[zeros:] | kind(1 << level)
            row = up
        return row.astype("<u4")


def _running(packed: np.ndarray) -> np.ndarray:
    """Set bits before each block."""
    per_block = BLOCK // 8
    padded = np.zeros((len(packed) // per_block + 1) * per_block, dtype=np.uint8)
    padded[: len(packed)] = packed
    totals = np.bitwise_count(padded.reshape(-1, per_block)).sum(axis=1, dtype=np.int64)
    return np.concatenate(([0], np.cumsum(totals)))[:-1]
