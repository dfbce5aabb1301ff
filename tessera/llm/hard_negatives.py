"""Hard negatives of anchors by a secondary-sort shuffle of packed pair scores.

Rows are scored against the anchors in tiles of integer products. A pair becomes a key of 24 bytes, ``(anchor, descending
score, id)`` in big-endian words whose byte order is the wanted order, with a mark telling whether the
labels agree. ``repartitionAndSortWithinPartitions`` sends the pairs of an anchor to one partition, sorted. There
an iterator goes down the scores: the first ``positives`` rows of the anchor's label each open a window, and every other
row that follows is emitted for each window that its score lies in, until the window has ``negatives`` rows. Nothing is
held of an anchor but its open windows and the first rows of the present score (of smaller id than a positive of that score, whose
window holds them if the score is 0 or ``high`` is 100).

Before the shuffle each tile leaves out pairs that cannot count (a combiner; nothing is lost): of the anchor's own label all
but the best ``positives`` met so far in the group, and, if L is the score of the last of these, rows of other labels below
``low`` % of L, and those below ``high`` % of L but for the first ``negatives`` of them. For the anchor's
positives score at least L, every window that reaches below ``high`` % of L begins above it.

Candidates are dealt by a hash of their id into groups of bounded bytes; the anchors stream past each group in blocks.

Edge cases: rows with a null id, label, or vector, or with a null or non-finite component take no part. Rows are compared with those of
their own vector length only. Of rows with one id the smallest ``(vector, label)`` counts. Ties go to the smaller id. With
fewer positives or negatives than wanted, all are returned; a positive with a score below 0 has an empty window. Zero vectors
score 0. Other columns are ignored. An empty table gives an empty result. A score that no 64-bit integer holds is an error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, stored

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
EVERY, FLIPPED, LABELS = 100, 7, 10
#: Vector components are counted in units of one 256th.
SCALE = 256
#: Bytes of a group's candidates, rows of one tile, anchors scored at once, rows of a batch, and rows of a group at least.
GROUP_BYTES, TILE, ANCHORS, ROWS, LEAST_GROUP = 32 << 20, 8_192, 256, 1_000, 4_096
_SIGN = np.uint64(1 << 63)
_KEY = struct.Struct(">QQQ")
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def integers(flat: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of every component, as whole doubles."""
    return np.floor(flat.astype(np.float64) * scale)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` and ``b``."""
    most = max(np.abs(a).max(initial=0), 1.0) * max(np.abs(b).max(initial=0), 1.0) * max(a.shape[1], 1)
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    out = [[sum(map(int.__mul__, map(int, row), other)) for other in whole] for row in a]
    if any(abs(x) >= 1 << 63 for row in out for x in row):
        raise OverflowError("an inner product does not fit into 64 bits")
    return np.array(out, np.int64).reshape(len(a), len(b))


def pack_keys(anchor: np.ndarray, score: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Rows of three big-endian words: byte order is the order of (anchor, descending score, id)."""
    key = np.empty((len(score), 3), ">u8")
    key[:, 0] = anchor.astype(np.int64).view(np.uint64) ^ _SIGN
    key[:, 1] = ~(score.astype(np.int64).view(np.uint64) ^ _SIGN)
    key[:, 2] = other.astype(np.int64).view(np.uint64) ^ _SIGN
    return key


def unpack_key(key: bytes) -> tuple[int, int, int]:
    a, s, o = _KEY.unpack(key)
    return a - (1 << 63), (1 << 63) - 1 - s, o - (1 << 63)


class Tile:
    """The pairs of a block of anchors that can count, tile by tile of one group."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, positives: int, negatives: int, low: int, high: int):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.positives, self.negatives, self.low, self.high = positives, negatives, low, high
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)  # scores and ids, best first

    def _positives(self, i: int, score: np.ndarray, ids: np.ndarray) -> int:
        """Take in rows of the anchor's label; the score that every positive reaches."""
        if len(score) > self.positives:  # ties at the edge stay until they are sorted
            edge = np.partition(score, len(score) - self.positives)[len(score) - self.positives]
            score, ids = score[score >= edge], ids[score >= edge]
        s, o = np.concatenate((self.best[i][0], score)), np.concatenate((self.best[i][1], ids))
        order = np.lexsort((o, -s))[:self.positives]
        self.best[i] = s[order], o[order]
        return max(int(s[order[-1]]), 0) if len(order) == self.positives else 0

    def negatives_of(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
        """Packed keys of the rows of other labels that can count; ``ids`` ascend."""
        score = scores(self.rows, rows)
        for i, anchor in enumerate(self.ids.tolist()):
            s, same = score[i], labels == self.labels[i]
            own = np.flatnonzero(same & (ids != anchor))
            least = self._positives(i, s[own], ids[own])
            can = np.flatnonzero(~same & (s >= -(-self.low * least // 100)))
            edge = -(-self.high * least // 100)  # the first score not below ``high`` %
            above = s[can] >= edge
            below = can[~above]
            if len(below) > self.negatives:
                kth = np.partition(s[below], len(below) - self.negatives)[len(below) - self.negatives]
                below = below[s[below] >= kth]
                below = below[np.argsort(-s[below], kind="stable")[:self.negatives]]
            keep = np.concatenate((can[above], below))
            if len(keep):
                yield pack_keys(np.full(len(keep), anchor), s[keep], ids[keep])

    def positive_keys(self) -> Iterator[np.ndarray]:
        for anchor, (s, o) in zip(self.ids.tolist(), self.best):
            if len(s):
                yield pack_keys(np.full(len(s), anchor), s, o)


def _batch(keys: list[np.ndarray], same: bool) -> Iterator[pa.RecordBatch]:
    if keys:
        k = np.concatenate(keys).astype(">u8", copy=False)  # concatenating turns words to the machine's order
        offsets = pa.py_buffer(np.arange(len(k) + 1, dtype=np.int32) * _KEY.size)
        yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(k), [None, offsets, pa.py_buffer(k.tobytes())]),
                                          pa.array(np.full(len(k), same))], ["key", "same"])


def _pairs(scale: int, limits: tuple[int, int, int, int]):
    """Rows sorted by (dim, part, asks, vec_id): the candidates of a group first, then all anchors in blocks."""
    def matrix(rows: list[pa.RecordBatch], dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, labels = (np.concatenate([r.column(i).to_numpy(zero_copy_only=False) for r in rows]) for i in (3, 4))
        flat = np.concatenate([r.column(5).flatten().to_numpy(zero_copy_only=False) for r in rows])
        return ids, labels, integers(flat, scale).reshape(len(ids), dim)

    def score(group, block):
        for at in range(0, len(block[0]), ANCHORS):
            tile = Tile(*(x[at:at + ANCHORS] for x in block), *limits)
            for t in range(0, len(group[0]), TILE):
                yield from _batch(list(tile.negatives_of(*(x[t:t + TILE] for x in group))), False)
            yield from _batch(list(tile.positive_keys()), True)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready = None, [], None
        for b in it:
            dim, part, asks = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero((np.diff(dim) != 0) | (np.diff(part) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if lo == hi:
                    continue
                rows, group = b.slice(lo, hi - lo), (int(dim[lo]), int(part[lo]))
                if group != now:
                    now, held, ready = group, [], None
                if not asks[lo]:
                    held.append(rows)
                elif held:
                    ready = ready or matrix(held, now[0])
                    yield from score(ready, matrix([rows], now[0]))

    return run


class Window:
    """What one positive still takes."""

    __slots__ = ("id", "score", "left")

    def __init__(self, positive: int, score: int, left: int):
        self.id, self.score, self.left = positive, score, left


def walk(pairs, positives: int, negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Result rows from sorted ``(key, same)`` pairs, one anchor after another."""
    now, windows, met, level, tied = None, [], 0, None, []

    def offer(w: Window, other: int, score: int):
        if w.left and low * w.score <= 100 * score <= high * w.score:
            w.left -= 1
            return now, w.id, negatives - w.left, other, w.score, score
        return None

    for key, same in pairs:
        anchor, score, other = unpack_key(key)
        if anchor != now:
            now, windows, met, level, tied = anchor, [], 0, None, []
        if score != level:
            level, tied = score, []
        if same:
            if met < positives:
                met += 1
                windows.append(Window(other, score, negatives))
                yield from filter(None, (offer(windows[-1], t, score) for t in tied))
        else:
            yield from filter(None, (offer(w, other, score) for w in windows))
            if len(tied) < negatives:
                tied.append(other)


def mine(vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, scale: int = SCALE, vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of the rows for which ``anchors`` holds.

    Scores are inner products of the vectors' components in whole 1/``scale``. A negative's score lies between ``low`` % and ``high`` %
    (at most 100) of its positive's.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("the percentages must ascend within 0 to 100")
    spark = vectors.sparkSession
    one = stored(vectors.where(usable(F.col(vector)) & F.col("vec_id").isNotNull() & F.col(label).isNotNull())
                 .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
                 .agg(F.min(F.struct(F.col(vector).alias("v"), F.col(label).cast("long").alias("label"))).alias("r"))
                 .select("vec_id", F.col("r.label").alias("label"), F.col("r.v").alias("v"))
                 .withColumn("dim", F.size("v")).withColumn("asks", anchors), "negatives-vectors")
    slots = spark.sparkContext.defaultParallelism
    sizes = one.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).where("q > 0")
    rows = F.greatest(F.lit(1), F.least(F.floor(F.lit(GROUP_BYTES // 8) / F.greatest("dim", F.lit(1))),
                                        F.greatest(F.lit(LEAST_GROUP), F.ceil(F.col("n") / slots))))
    sizes = stored(sizes.select("dim", F.ceil(F.col("n") / rows).cast("int").alias("parts")), "negatives-sizes")
    # one row for each length of vectors
    dealt = one.join(F.broadcast(sizes), "dim") if sizes.count() <= 10_000 else one.join(sizes, "dim")
    candidates = dealt.select("dim", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"),
                              F.lit(False).alias("q"), "vec_id", "label", "v")
    asked = dealt.where("asks").select("dim", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                                       F.lit(True).alias("q"), "vec_id", "label", "v")
    batches(spark, ROWS)
    pairs = (candidates.unionByName(asked).repartition("dim", "part").sortWithinPartitions("dim", "part", "q", "vec_id")
             .mapInArrow(_pairs(scale, (positives, negatives, low, high)), "key binary, same boolean"))
    found = (pairs.rdd.map(lambda r: (bytes(r[0]), r[1]))
             .repartitionAndSortWithinPartitions(int(spark.conf.get("spark.sql.shuffle.partitions")), lambda key: zlib.crc32(key[:8]))
             .mapPartitions(lambda it: walk(it, positives, negatives, low, high)))
    return spark.createDataFrame(found, RESULT, verifySchema=False)


def query(spark, sf_dir):
    v = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    label = F.when(F.col("vec_id") % FLIPPED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return mine(v.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % EVERY == 0)


SQL = """
WITH good AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.v, o.v)]) AS BIGINT) AS score
  FROM good a JOIN good o ON a.vec_id <> o.vec_id AND len(a.v) = len(o.v) WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
