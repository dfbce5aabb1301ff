"""Nearest neighbours by a block matrix join over int8 product tiles.

Vectors are quantised to int8 with one scale each; the length of what
quantisation left over is kept as its error. A tile multiplies a block of queries
with a block of candidates in integers, and by the triangle inequality the true distance
lies within the two errors of the tile's. A pair whose lower bound is not above
the query's ``k``-th smallest upper bound (or its heap's worst) survives; survivors are recomputed
in double precision on the original vectors and kept in a heap per query. The result is
exact: no neighbour is lost to quantisation.

Candidates are dealt by a hash of their id into groups of bounded bytes, one group in a
task's memory at a time; the query set streams past each group in blocks. Each
group returns ``k`` rows a query, and a window with a group limit takes the ``k`` best.

Edge cases: vectors null, empty, zero, or holding null or non-finite components take no part. Vectors are
compared with those of their own length only. Of rows with one ``vec_id`` the smallest vector
counts. Ties go to the smaller ``vec_id``. With fewer candidates than ``k``, all are
returned. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import batches, stored

K, EVERY = 10, 100
#: Bytes of the candidates of one group, candidates and queries of one tile, and of a group at least.
GROUP_BYTES, TILE, QUERY_ROWS, LEAST_GROUP = 64 << 20, 8_192, 1_000, 4_096
#: Integer products of this many components stay exact in single precision (127 * 127 * 1024 < 2 ** 24).
EXACT_DIMS = 1_024
#: Room for rounding in the bounds, as a share of the distances involved.
SLACK = 1e-6


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows (as exact single floats), scales, squared lengths of the scaled rows, and errors."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    q = np.rint(x / scale[:, None])
    return q.astype(np.float32), scale, (q * q).sum(axis=1) * scale * scale, np.sqrt(((x - q * scale[:, None]) ** 2).sum(axis=1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` and ``b``."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, i:i + EXACT_DIMS] @ b[:, i:i + EXACT_DIMS].T
    return out


def distances(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, components added in order."""
    return np.sqrt(np.cumsum((rows - q) ** 2, axis=1)[:, -1])


def search(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, c_coded, k: int) -> Iterator[tuple[int, int, float]]:
    """The ``k`` nearest candidates (other than itself) of every query: ``(query, candidate, distance)``."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]  # negated, so the worst is first
    qq, qs, qn, qe = quantise(q)
    for at in range(0, len(c_ids), TILE):
        part = slice(at, at + TILE)
        cq, cs, cn, ce = (x[part] for x in c_coded)
        square = qn[:, None] + cn - 2.0 * products(qq, cq) * qs[:, None] * cs
        room = SLACK * (np.sqrt(qn)[:, None] + np.sqrt(cn)) + qe[:, None] + ce
        near = np.sqrt(np.maximum(square, 0.0))
        ids = c_ids[part]
        near[q_ids[:, None] == ids] = np.inf
        most = near + room
        n = min(k, most.shape[1])
        limit = np.partition(most, n - 1, axis=1)[:, n - 1] if n == k else np.full(len(q_ids), np.inf)
        worst = np.array([-h[0][0] if len(h) == k else np.inf for h in heaps])
        survive = (near - room <= np.minimum(limit, worst)[:, None]) & np.isfinite(near)
        for i in np.flatnonzero(survive.any(axis=1)):
            j = np.flatnonzero(survive[i])
            heap = heaps[i]
            for d, v in zip(distances(q[i], c[at + j]).tolist(), ids[j].tolist()):
                if len(heap) < k:
                    heapq.heappush(heap, (-d, -v))
                elif (-d, -v) > heap[0]:
                    heapq.heapreplace(heap, (-d, -v))
    for i, heap in zip(q_ids.tolist(), heaps):
        for d, v in heap:
            yield i, -v, -d


def _groups(k: int):
    """Rows sorted by (dim, part, asks): the candidates of a part first, then all queries in blocks."""
    def matrix(rows: list[pa.RecordBatch], dim: int) -> tuple[np.ndarray, np.ndarray]:
        ids = np.concatenate([r.column(3).to_numpy(zero_copy_only=False) for r in rows])
        flat = np.concatenate([r.column(4).flatten().to_numpy(zero_copy_only=False) for r in rows])
        return ids, flat.reshape(-1, dim).astype(np.float64)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready = None, [], None
        for b in it:
            dim, part, asks = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero((np.diff(dim) != 0) | (np.diff(part) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                rows, group = b.slice(lo, hi - lo), (int(dim[lo]), int(part[lo]))
                if group != now:
                    now, held, ready = group, [], None
                if not asks[lo]:
                    held.append(rows)
                elif held:
                    if ready is None:
                        c_ids, c = matrix(held, now[0])
                        ready = c_ids, c, quantise(c)
                    found = list(search(*matrix([rows], now[0]), *ready, k))
                    if found:
                        q, v, d = zip(*found)
                        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(d)],
                                                         ["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, asks: Column, k: int = K, vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest other vectors of those for which ``asks`` holds."""
    spark = vectors.sparkSession
    one = stored(vectors.where(usable(F.col(vector)) & F.col("vec_id").isNotNull())
                 .groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(vector).alias("v"))
                 .withColumn("dim", F.size("v")).withColumn("asks", asks), "ann-vectors")
    sizes = one.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).where("q > 0")
    wide = 8 if isinstance(vectors.schema[vector].dataType.elementType, T.DoubleType) else 4
    slots = spark.sparkContext.defaultParallelism
    rows = F.greatest(F.lit(1), F.least(F.floor(F.lit(GROUP_BYTES // wide) / F.col("dim")),
                                        F.greatest(F.lit(LEAST_GROUP), F.ceil(F.col("n") / slots))))
    sizes = stored(sizes.select("dim", F.ceil(F.col("n") / rows).cast("int").alias("parts")), "ann-sizes")
    # one row for each length of vectors
    dealt = one.join(F.broadcast(sizes), "dim") if sizes.count() <= 10_000 else one.join(sizes, "dim")
    candidates = dealt.select("dim", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"),
                              F.lit(False).alias("q"), "vec_id", "v")
    queries = dealt.where("asks").select("dim", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                                         F.lit(True).alias("q"), "vec_id", "v")
    batches(spark, QUERY_ROWS)
    found = (candidates.unionByName(queries).repartition("dim", "part").sortWithinPartitions("dim", "part", "q", "vec_id")
             .mapInArrow(_groups(k), "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    v = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return nearest(v.select("vec_id", "embedding"), F.col("vec_id") % EVERY == 0)


SQL = """
WITH good AS (
  SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
  GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(q.v, c.v)])) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
