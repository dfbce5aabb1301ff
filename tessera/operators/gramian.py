"""Correlated pairs among very many columns (inventory 42, 44).

The columns are cut into blocks. Every task keeps, for one block of columns, the sums over its rows that the
pairwise-complete correlations with all later blocks need (counts, sums, squares and products), emits them line by
line, and the lines of one pair of blocks are added up as a sorted stream. Blocks stay on the executors: the driver sees
one mean and deviation per column and, of the pairs, only those above the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: Columns of a block. A task holds ``6 * BLOCK * columns`` numbers.
BLOCK = 128
_LINE = "a int, line int, b int, sums binary"


def _rows(b: pa.RecordBatch, p: int) -> np.ndarray:
    x = b.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return x.reshape(b.num_rows, p)


def _moments(values: DataFrame, p: int) -> tuple[np.ndarray, ...]:
    """Count, mean, sample deviation and number of infinite values of every column; one row reaches the driver."""
    def merge(old, new):
        if old is None:
            return new
        n, m, s, inf = old
        k, mk, sk, infk = new
        total = np.maximum(n + k, 1)
        return n + k, m + (mk - m) * k / total, s + sk + (mk - m) ** 2 * n * k / total, inf + infk

    def out(state) -> Iterator[pa.RecordBatch]:
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(state).tobytes()], pa.binary())], ["m"])

    def per_task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in it:
            x = _rows(b, p)
            inf, seen = np.isinf(x), np.isfinite(x)
            n = seen.sum(axis=0).astype(np.float64)
            m = np.where(seen, x, 0.0).sum(axis=0) / np.maximum(n, 1)
            state = merge(state, (n, m, (np.where(seen, x - m, 0.0) ** 2).sum(axis=0), inf.sum(axis=0).astype(np.float64)))
        yield from out(state)

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in it:
            for raw in b.column(0).to_pylist():
                state = merge(state, tuple(np.frombuffer(raw).reshape(4, p)))
        yield from out(state)

    # a few numbers per column from every task, added up in a stream
    row = values.mapInArrow(per_task, "m binary").repartition(1).mapInArrow(add, "m binary").first()
    n, m, s, inf = np.frombuffer(bytes(row["m"])).reshape(4, p) if row else np.zeros((4, p))
    return n, m, np.sqrt(s / np.maximum(n - 1, 1)), inf


def _sums(p: int, block: int, a: int, mean: np.ndarray, dev: np.ndarray):
    """The sums of block ``a`` with itself and all later blocks, over the rows of a task."""
    later = range(a, -(-p // block))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in it:
            x = (_rows(b, p)[:, a * block:] - mean[a * block:]) / dev[a * block:]
            has = np.isfinite(x)
            x, has = np.where(has, x, 0.0), has.astype(np.float64)
            square, own = x * x, slice(0, block)
            if held is None:
                held = np.zeros((6, min(block, x.shape[1]), x.shape[1]))
            for i, (left, right) in enumerate([(x, x), (has, has), (x, has), (has, x), (square, has), (has, square)]):
                held[i] += left[:, own].T @ right
        if held is not None:
            for j in later:
                part = held[:, :, (j - a) * block:(j - a + 1) * block]
                lines = part.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a] * lines, pa.int32()), pa.array(range(lines), pa.int32()), pa.array([j] * lines, pa.int32()),
                     pa.array([np.ascontiguousarray(part[:, r]).tobytes() for r in range(lines)], pa.binary())], ["a", "line", "b", "sums"])

    return run


def correlations(sums: np.ndarray) -> np.ndarray:
    """Pearson correlations from (products, counts, sums of x, sums of y, squares of x, squares of y); NaN where undefined."""
    xy, n, sx, sy, sxx, syy = sums
    k = np.maximum(n, 1)
    vx, vy = sxx - sx * sx / k, syy - sy * sy / k
    flat = (n < 2) | (vx <= 1e-12 * np.maximum(sxx, 1.0)) | (vy <= 1e-12 * np.maximum(syy, 1.0))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(flat, np.nan, (xy - sx * sy / k) / np.sqrt(vx * vy))


def correlated_pairs(df: DataFrame, cols: list[str], threshold: float, block: int = BLOCK) -> DataFrame:
    """``(col_a, col_b, pos_a, pos_b, corr)`` of the column pairs with ``|corr| > threshold``, ``pos_a < pos_b``.

    Correlations are taken over the rows that have both columns. A pair with a constant column or with an infinite value in
    one of its columns has none. NaN is missing.
    """
    spark, p = df.sparkSession, len(cols)
    schema = "col_a string, col_b string, pos_a int, pos_b int, corr double"
    if p < 2:
        return spark.createDataFrame([], schema)
    # read once for each block of columns: as one array, not through the plan of the wide row
    values = cut_lineage(df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("x")))
    n, mean, dev, inf = _moments(values, p)
    dev = np.where(dev > 0, dev, 1.0)
    usable = (n >= 2) & (inf == 0)

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None

        def done():
            a, line, b = now
            at = a * block + line
            corr = correlations(held)
            other = np.arange(b * block, b * block + len(corr))
            with np.errstate(invalid="ignore"):
                keep = (other > at) & usable[other] & usable[at] & (np.abs(corr) > threshold)
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cols[at]] * int(keep.sum())), pa.array([cols[i] for i in other[keep]]), pa.array([at] * int(keep.sum()), pa.int32()),
                     pa.array(other[keep], pa.int32()), pa.array(corr[keep])], ["col_a", "col_b", "pos_a", "pos_b", "corr"])

        for batch in it:
            for a, line, b, raw in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(raw).reshape(6, -1)
                if (a, line, b) == now:
                    held = held + part
                else:
                    if now is not None:
                        yield from done()
                    now, held = (a, line, b), part
        if now is not None:
            yield from done()

    lines = None
    for a in range(-(-p // block)):
        part = values.mapInArrow(_sums(p, block, a, mean, dev), _LINE)
        lines = part if lines is None else lines.unionByName(part)
    return lines.repartition("a", "line", "b").sortWithinPartitions("a", "line", "b").mapInArrow(add, schema)
