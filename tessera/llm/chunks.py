"""Token ids of many texts by way of their distinct space-separated chunks.

Token boundaries of the tokenizers used here never fall inside a chunk's
neighbour, so each distinct chunk is encoded once per task process and texts are
put together from the chunks' ids with array operations.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from itertools import compress, repeat

import numpy as np

#: Distinct chunks a task process remembers; beyond it those seldom met are forgotten (a matter of speed only).
MEMO_CHUNKS = 200_000


class Ragged:
    """Growing list of integer runs in one flat array."""

    def __init__(self):
        self.flat, self.starts, self.n, self.used = np.empty(1 << 16, np.int32), np.zeros(1 << 12, np.int64), 0, 0
        self.uses = np.zeros(1 << 12, np.int32)

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        while self.n + len(lengths) + 1 > len(self.starts):
            self.starts = np.concatenate((self.starts, np.empty_like(self.starts)))
            self.uses = np.concatenate((self.uses, np.zeros_like(self.uses)))
        self.flat[self.used:self.used + len(flat)] = flat
        self.starts[self.n + 1:self.n + 1 + len(lengths)] = self.used + np.cumsum(lengths)
        self.n, self.used = self.n + len(lengths), self.used + len(flat)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs ``rows`` one after another, and their lengths; ``uses`` counts the calls that took a run."""
        self.uses[rows] += 1
        lengths = self.starts[rows + 1] - self.starts[rows]
        return self.flat[spread(self.starts[rows], lengths)], lengths


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all members of the runs given by ``starts`` and ``lengths``."""
    total = int(lengths.sum())
    out = np.ones(total, np.int64)
    full = lengths > 0
    s, n = starts[full], lengths[full]
    if not len(s):
        return out
    at = np.concatenate(([0], np.cumsum(n)[:-1]))
    out[at] = s
    out[at[1:]] -= s[:-1] + n[:-1] - 1
    return np.cumsum(out)


class Memo(dict):
    """chunk -> row of ``ids``; unknown chunks get the next row and wait in ``new`` until :meth:`learn`."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        super().__init__()
        self.encode, self.new, self.ids = encode, [], Ragged()

    def __missing__(self, chunk: str) -> int:
        row = self[chunk] = len(self)
        self.new.append(chunk)
        return row

    def rows(self, chunks: list[str]) -> np.ndarray:
        """The row of every chunk; the unknown ones are found first and numbered together."""
        rows = np.fromiter(map(self.get, chunks, repeat(-1)), np.int64, len(chunks))
        at = rows < 0
        if at.any():
            unknown = list(compress(chunks, at.tolist()))
            new = list(dict.fromkeys(unknown))
            self.update(zip(new, range(len(self), len(self) + len(new))))
            self.new += new
            rows[at] = np.fromiter(map(self.__getitem__, unknown), np.int64, len(unknown))
        return rows

    def learn(self) -> None:
        if self.new:
            self.ids.extend(*self.encode(self.new))
            self.new = []

    def forget(self, limit: int = MEMO_CHUNKS) -> None:
        """Above ``limit`` chunks keep those that were taken more than once, the most taken half of it at most.

        What is kept keeps half of its count, so that it stays if it is met again before the next time.
        """
        if len(self) > limit:
            uses = self.ids.uses[:len(self)]
            rows = np.flatnonzero(uses > 1)
            if len(rows) > limit // 2:
                rows = np.sort(rows[np.argpartition(-uses[rows], limit // 2)[:limit // 2]])
            chunks, ids, left = list(self), Ragged(), (uses[rows] + 1) // 2
            ids.extend(*self.ids.take(rows))
            ids.uses[:len(rows)] = left
            self.clear()
            self.update((chunks[row], i) for i, row in enumerate(rows.tolist()))
            self.ids = ids


_HELD: list = []


def resident(same: Callable[[object], bool], make: Callable[[], object]):
    """The one thing with a memory of chunks that a task process keeps: what it holds, if that is the ``same``, or else what ``make`` gives.

    A process serves stage after stage, and would in the end hold the memories of all their operators.
    """
    if not (_HELD and same(_HELD[0])):
        _HELD.clear()
        gc.collect()  # a memory and its encoder refer to each other
        _HELD.append(make())
    return _HELD[0]


def per_text(lengths: np.ndarray, chunks_per_text: np.ndarray) -> np.ndarray:
    """Ids of each text from the ids of each of its chunks."""
    ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(chunks_per_text)]
    return np.diff(np.concatenate(([0], ends)))
