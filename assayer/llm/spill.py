"""A priority queue that spills: the message store of time-forward processing within one task."""

from __future__ import annotations

import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator
from typing import Any

#: Entries held in memory before a sorted run is written.
HELD = 200_000
#: Entries of a run that are read back at a time.
BLOCK = 2_000


class SpillingQueue:
    """``(label, payload)`` entries, least label first; entries of one label come in the order they were put in.

    At most ``held`` entries are in memory. Beyond that all of them are sorted and written as one run to an unnamed file
    in the folder Spark itself spills to; it is gone with the task, and a task that runs again writes its own.
    """

    def __init__(self, held: int = HELD) -> None:
        self.held, self.put_in, self.runs = held, 0, 0
        self._heap: list[tuple[Any, int, Any]] = []
        #: The first entry of every run, with the rest of the run behind it.
        self._heads: list[tuple[Any, int, Any, Iterator]] = []

    def push(self, label: Any, payload: Any) -> None:
        heapq.heappush(self._heap, (label, self.put_in, payload))
        self.put_in += 1
        if len(self._heap) > self.held:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        self._heap.sort()
        for at in range(0, len(self._heap), BLOCK):
            pickle.dump(self._heap[at : at + BLOCK], file)
        file.seek(0)
        self._heap, self.runs = [], self.runs + 1
        self._advance(_entries(file))

    def _advance(self, run: Iterator) -> None:
        for label, number, payload in run:
            heapq.heappush(self._heads, (label, number, payload, run))
            return

    def _first(self) -> list | None:
        """The part that holds the least entry."""
        if not self._heads or self._heap and self._heap[0][:2] < self._heads[0][:2]:
            return self._heap or None
        return self._heads

    def take(self, label: Any) -> list[Any]:
        """Removes and returns the payloads of ``label``, which no waiting entry may be less than."""
        found = []
        while (part := self._first()) and part[0][0] == label:
            entry = heapq.heappop(part)
            found.append(entry[2])
            if part is self._heads:
                self._advance(entry[3])
        if part and part[0][0] < label:
            raise ValueError(f"an entry for {part[0][0]!r} was never taken before {label!r}")
        return found

    def next_label(self) -> Any:
        """The least label, or None where nothing waits."""
        part = self._first()
        return part[0][0] if part else None


def _entries(file) -> Iterator[tuple[Any, int, Any]]:
    with file:
        while True:
            try:
                block = pickle.load(file)
            except EOFError:
                return
            yield from block
