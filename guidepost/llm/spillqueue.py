"""A priority queue whose memory is bounded."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from itertools import chain, islice
from tempfile import TemporaryFile

MOST_IN_MEMORY = 1 << 18
MOST_RUNS = 64
BLOCK = 4096


def _written(items: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted items, kept in a file without a name that goes with this process."""
    file = TemporaryFile()
    while block := list(islice(items, BLOCK)):
        pickle.dump(block, file)
    end = file.tell()
    file.seek(0)

    def read() -> Iterator[tuple]:
        with file:
            while file.tell() < end:
                yield from pickle.load(file)

    return read()


class SpillingQueue:
    """Items come out in ascending order; beyond ``limit`` those in memory become a sorted run.

    Runs are scratch of one task, as those of Spark's own sorts: nothing reads them
    afterwards, and a task that is lost writes its own anew. Beyond ``MOST_RUNS`` they are merged.
    """

    def __init__(self, limit: int = MOST_IN_MEMORY):
        self.limit = limit
        self.heap: list[tuple] = []
        self.runs: list[tuple[tuple, int, Iterator[tuple]]] = []
        self.spilled = 0

    def _add_run(self, items: Iterator[tuple]) -> None:
        run = _written(items)
        self.spilled += 1
        heapq.heappush(self.runs, (next(run), self.spilled, run))

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.limit:
            self.heap.sort()
            full, self.heap = self.heap, []
            self._add_run(iter(full))
            if len(self.runs) > MOST_RUNS:
                whole, self.runs = self.runs, []
                self._add_run(heapq.merge(*(chain([head], rest) for head, _, rest in whole)))
        heapq.heappush(self.heap, item)

    def least(self) -> tuple | None:
        """The next item, or None."""
        if not self.runs:
            return self.heap[0] if self.heap else None
        if not self.heap:
            return self.runs[0][0]
        return min(self.heap[0], self.runs[0][0])

    def pop(self) -> tuple:
        if self.heap and (not self.runs or self.heap[0] <= self.runs[0][0]):
            return heapq.heappop(self.heap)
        head, number, rest = self.runs[0]
        following = next(rest, None)
        if following is None:
            heapq.heappop(self.runs)
        else:
            heapq.heapreplace(self.runs, (following, number, rest))
        return head
