"""Packing of token sequences by the online sum-of-squares rule.

Documents are met one by one. Full windows are cut off a long document first; what is left (fewer ids than a window
holds) is placed whole into the fill level that minimises the sum over levels of the squared
number of windows partially filled to that level. The counts lie in a level array: moving one
window from level ``h`` to ``h + s`` changes the sum by ``2 (N[h + s] - N[h]) + 2``, filling it up by ``1 - 2 N[h]``,
and opening a window by ``2 N[s] + 1``. Ties go to the fullest window, and of windows
at one level to the one that came there last.

A task packs the rows of its own input partition, so nothing is shuffled and no window spans tasks. When the
windows that are still open hold more than ``HELD`` ids, and at the end of the rows, they are closed: the fullest
windows are topped up with ids cut off the emptiest, and the last window is split into lengths that are powers of two.
So only the documents of open windows are cut, and no sequence needs padding: every one is full or a power of two.

Edge cases: a null or empty text is the end id alone. Rows without an id, and rows with
equal ids, are packed as documents of their own. Very long texts are packed whole. Other columns are ignored. An empty table
gives an empty result. Which documents share a window depends on how the input is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, documents
from tessera.llm.token_file import default_path, encoder

WINDOW, END_ID = 4096, 2
#: Ids in open windows that a task holds before it closes them.
HELD = 8 << 20
#: Sequences of one input partition are numbered from a multiple of this.
STRIDE = 1 << 36
#: Rows encoded at a time, and the characters of their texts.
ROWS, CHARS = 256, 4 << 20
PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


class Piece:
    """Consecutive ids of a document."""

    __slots__ = ("doc_id", "start", "ids", "total")

    def __init__(self, doc_id, start, ids, total):
        self.doc_id, self.start, self.ids, self.total = doc_id, start, ids, total

    def split(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[:n], self.total),
                Piece(self.doc_id, self.start + n, self.ids[n:], self.total))


class Levels:
    """Partially filled windows by fill level."""

    def __init__(self, window: int):
        self.window, self.count, self.open, self.held = window, np.zeros(window + 1, np.int64), {}, 0

    def best(self, size: int) -> int:
        """Level of the window that ``size`` ids go to; 0 opens a new one."""
        n, last = self.count, self.window - size
        levels = np.flatnonzero(n[1:last + 1]) + 1
        if not len(levels):
            return 0
        change = 2 * (n[levels + size] - n[levels]) + 2  # n[window] is 0 throughout
        if levels[-1] == last:
            change[-1] -= 1
        i = len(levels) - 1 - int(change[::-1].argmin())
        return int(levels[i]) if change[i] <= 2 * n[size] + 1 else 0

    def place(self, piece: Piece) -> list[Piece] | None:
        """The pieces of the window if ``piece`` fills it up."""
        size = len(piece.ids)
        at = self.best(size)
        held = self._take(at) if at else []
        held.append(piece)
        if at + size == self.window:
            return held
        self._put(at + size, held)
        return None

    def _take(self, level: int) -> list[Piece]:
        self.count[level] -= 1
        self.held -= level
        return self.open[level].pop()

    def _put(self, level: int, pieces: list[Piece]) -> None:
        self.count[level] += 1
        self.held += level
        self.open.setdefault(level, []).append(pieces)

    def close(self) -> Iterator[list[Piece]]:
        """All open windows: the emptiest are cut up to fill the fullest, the last is split into powers of two."""
        work = [(level, pieces) for level in np.flatnonzero(self.count).tolist() for pieces in self.open[level]]
        self.__init__(self.window)
        spare, room = [], 0  # pieces to be cut, last first, and their ids
        at = 0
        while at < len(work):
            level, pieces = work.pop()
            gap = self.window - level
            while room < gap and at < len(work):
                room += work[at][0]
                spare += reversed(work[at][1])
                at += 1
            if room < gap:
                yield from _powers([*pieces, *reversed(spare)], level + room)
                return
            yield [*pieces, *_cut(spare, gap)]
            room -= gap
        if room:
            yield from _powers(spare[::-1], room)


def _cut(spare: list[Piece], n: int) -> list[Piece]:
    """``n`` ids off the end of the stack ``spare``."""
    out = []
    while n:
        piece = spare.pop()
        if len(piece.ids) > n:
            piece, rest = piece.split(n)
            spare.append(rest)
        out.append(piece)
        n -= len(piece.ids)
    return out


def _powers(pieces: list[Piece], size: int) -> Iterator[list[Piece]]:
    spare = pieces[::-1]
    for bit in reversed(range(size.bit_length())):
        if size >> bit & 1:
            yield _cut(spare, 1 << bit)


def packed(docs: Iterator[tuple[int | None, np.ndarray]], window: int, held: int) -> Iterator[list[Piece]]:
    """The sequences of documents given as ids, in the order in which they get full."""
    levels = Levels(window)
    for doc_id, ids in docs:
        whole = len(ids) - len(ids) % window
        for at in range(0, whole, window):
            yield [Piece(doc_id, at, ids[at:at + window], len(ids))]
        if whole < len(ids):
            full = levels.place(Piece(doc_id, whole, ids[whole:].copy(), len(ids)))
            if full:
                yield full
            if levels.held > held:
                yield from levels.close()
    yield from levels.close()


def _encoded(it: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[int | None, np.ndarray]]:
    e = encoder(path)
    for b in it:
        at = 0
        while at < b.num_rows:
            texts, size = [], 0
            while at + len(texts) < b.num_rows and len(texts) < ROWS and size < CHARS:
                texts.append(b.column(1)[at + len(texts)].as_py())
                size += len(texts[-1] or "")
            ids, n = e.encode(texts)
            ends = np.cumsum(n)
            flat = np.insert(ids, ends, end_id).astype("<u4")
            stops = (ends + np.arange(1, len(n) + 1)).tolist()
            for doc_id, a, z in zip(b.column(0).slice(at, len(texts)).to_pylist(), [0, *stops], stops):
                yield doc_id, flat[a:z]
            at += len(texts)


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID, held: int = HELD) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``: one row per piece of a document.

    ``start`` is the piece's place among its document's ids, ``offset`` its place in its sequence, and ``ids`` are little-endian
    unsigned 32-bit integers. ``sequence_id`` grows within an input partition in the order of closing.
    """
    path = path or default_path()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, size = TaskContext.get().partitionId() * STRIDE, [], 0
        for sequence in packed(_encoded(it, path, end_id), window, held):
            offset = 0
            for p in sequence:
                rows.append((p.doc_id, p.start, len(p.ids), p.total, number, offset, p.ids.tobytes()))
                offset += len(p.ids)
            number, size = number + 1, size + offset
            if size >= 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(sequence_id, n_tokens, n_padding, ids)``: the ids of every sequence; ``n_padding`` is what a batch of ``window`` would add."""
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p"))
    power = F.bit_count("n_tokens") == 1
    return whole.select("sequence_id", "n_tokens", F.when(power, 0).otherwise(window - F.col("n_tokens")).alias("n_padding"),
                        F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def query(spark, sf_dir):
    pieces = pack(documents(spark, sf_dir).select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
