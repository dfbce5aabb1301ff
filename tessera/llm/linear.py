"""Hashed n-gram indicators and linear models on a bounded sample of labelled documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.chunks import Memo, spread
from tessera.llm.common import arrow_map, batches, stored

#: Labelled documents a model is fitted on at most (about), and the tasks that read them.
SAMPLE_DOCS, SAMPLE_TASKS = 4_000, 8
#: Bits of a hashed n-gram, and the lengths of the character n-grams inside a word and its two ends.
HASH_BITS, GRAMS = 22, (4, 5)
_UINT = np.uint64
_STEP = 0x9E3779B97F4A7C15


def labelled_sample(docs: DataFrame, labels: DataFrame, among: Column, columns: list[str], limit: int = SAMPLE_DOCS) -> DataFrame:
    """About ``limit`` rows ``(doc_id, text, *columns)`` of the labelled documents, picked by a hash of their id; a stored table.

    An id with several labels counts once, with the largest value of each label; of several rows with one id the smallest
    ``(text, ...)`` counts. So the rows are the same in every run. Texts of any length take part; those that are null do not.
    """
    known = labels.where(among & F.col("doc_id").isNotNull())
    own = [c for c in known.columns if c != "doc_id"]
    known = known.groupBy("doc_id").agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in own])
    share = min(1.0, limit / max(known.count(), 1))
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    rows = (docs.drop(*own).join(picked, "doc_id").where(F.col("text").isNotNull()).select("doc_id", "text", *columns)
            .repartition(SAMPLE_TASKS, "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", *columns)).alias("row"))
            .select("doc_id", "row.*"))
    return stored(rows, "sample")


def distinct(keys: np.ndarray) -> np.ndarray:
    """``keys`` in ascending order, each once. ``np.unique`` would put all of them into a table of nodes, which takes longer and more memory."""
    keys = np.sort(keys)
    keep = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=keep[1:])
    return keys[keep]


def mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> _UINT(29)
    h *= _UINT(0xBF58476D1CE4E5B9)
    h ^= h >> _UINT(32)
    return h


def word_grams(words: list[str], sizes: tuple[int, ...] = GRAMS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's character n-grams (its ends marked) and of the word itself, and how many each word has."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(_UINT)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    found, owners = [], []
    for n in sizes:
        if len(codes) < n:
            continue
        h, power = np.zeros(len(codes) - n + 1, _UINT), _UINT(1)
        for j in range(n):
            h += codes[j:len(codes) - n + 1 + j] * power
            power = _UINT(int(power) * _STEP & (1 << 64) - 1)
        inside = owner[:len(h)] == owner[n - 1:]
        found.append(mixed(h[inside] + _UINT(n)))
        owners.append(owner[:len(h)][inside])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(codes)) - starts[owner]
    powers = np.full(int(lengths.max()), _STEP, _UINT)
    powers[0] = 1
    found.append(mixed(np.add.reduceat(codes * np.cumprod(powers, dtype=_UINT)[place], starts)))
    owners.append(np.arange(len(words)))
    all_owners = np.concatenate(owners)
    order = np.argsort(all_owners, kind="stable")
    buckets = (np.concatenate(found)[order] >> _UINT(64 - HASH_BITS)).astype(np.int64)
    return buckets, np.bincount(all_owners, minlength=len(words))


class Indicators:
    """Which of the chosen buckets each text has; ``extra`` may add features of the order of its words.

    ``chosen`` is None while features are still being counted: all buckets are then features.
    """

    def __init__(self, split: Callable[[str], list[str]], chosen: np.ndarray | None,
                 extra: Callable[[np.ndarray], list[int]] | None = None, n_extra: int = 0):
        self.split, self.chosen, self.extra, self.n_extra = split, chosen, extra, n_extra
        self.n_grams = 1 << HASH_BITS if chosen is None else len(chosen)
        self.size = self.n_grams + n_extra
        self.memo, self.place = Memo(self._words), None

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        buckets, n = word_grams(words)
        if self.chosen is None:
            return buckets, n
        if self.place is None:  # of each bucket, as many as HASH_BITS tell apart
            self.place = np.full(1 << HASH_BITS, -1, np.int32)
            self.place[self.chosen] = np.arange(len(self.chosen))
        at = self.place[buckets]
        hit = at >= 0
        return at[hit], np.bincount(np.repeat(np.arange(len(n)), n)[hit], minlength=len(n))

    def of(self, texts: list[str | None], step: int = 200) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (text, feature), each once, in order; ``step`` texts at a time, so that little is held beside the pairs."""
        parts = [(i, *self._of(texts[i:i + step])) for i in range(0, len(texts), step)] or [(0, *self._of([]))]
        return np.concatenate([i + doc for i, doc, _ in parts]), np.concatenate([feature for *_, feature in parts])

    def _of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        words, counts = [], []
        for t in texts:
            w = self.split(t) if t else []
            if self.extra is None:
                w = list(set(w))
            words += w
            counts.append(len(w))
        rows = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        self.memo.learn()
        doc = np.repeat(np.arange(len(texts)), counts)
        if self.extra is not None:
            more, at = [], np.concatenate(([0], np.cumsum(counts)))
            for i in range(len(texts)):
                more += [i * self.size + self.n_grams + k for k in self.extra(rows[at[i]:at[i + 1]])]
            both = distinct(doc * (len(self.memo) + 1) + rows)
            doc, rows = both // (len(self.memo) + 1), both % (len(self.memo) + 1)
        flat, n = self.memo.ids.take(rows)
        pairs = np.repeat(doc, n) * self.size + flat
        if self.extra is not None:
            pairs = np.concatenate((pairs, np.array(more, np.int64)))
        pairs = distinct(pairs)
        self.memo.forget()
        return pairs // self.size, pairs % self.size


def class_counts(find: Indicators, texts: list[str], classes: np.ndarray, step: int = 200) -> np.ndarray:
    """For every feature, the texts that have it, by column of ``classes`` (a 0/1 matrix)."""
    out = np.zeros((classes.shape[1], find.size), np.int32 if len(texts) >= 1 << 16 else np.uint16)
    for i in range(0, len(texts), step):
        doc, feature = find.of(texts[i:i + step])
        for c in range(classes.shape[1]):
            at, n = np.unique(feature[classes[i + doc, c] > 0], return_counts=True)
            out[c, at] += n.astype(out.dtype)
    return out


def gram_counts(rows: DataFrame, split: Callable[[str], list[str]], mark: Column, least: int) -> tuple[np.ndarray, ...]:
    """Buckets of n-grams that at least ``least`` texts of a sample have, ascending; how many marked texts and how many of all have them.

    Counted in the sample's tasks and summed by Spark: the driver gets one row per bucket (2^``HASH_BITS`` at most), no text.
    """
    batches(rows.sparkSession)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = Indicators(split, None), np.zeros((2, 1 << HASH_BITS), np.int32)
        for b in it:
            marked = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            total += class_counts(find, b.column(0).to_pylist(), np.column_stack((marked, np.ones(len(marked)))))
        at = np.flatnonzero(total[1])
        for i in range(0, len(at), 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (part, *total[:, part])], ["bucket", "marked", "texts"])

    found = (rows.select("text", mark.alias("mark")).mapInArrow(count, "bucket int, marked int, texts int")
             .groupBy("bucket").agg(F.sum("marked").alias("marked"), F.sum("texts").alias("texts"))
             .where(F.col("texts") >= least).toArrow())
    bucket, marked, texts = (found.column(c).to_numpy().astype(np.int64) for c in ("bucket", "marked", "texts"))
    order = np.argsort(bucket)
    return bucket[order], marked[order], texts[order]


def sample_rows(rows: DataFrame, label: Column, find: Callable[[], Indicators]) -> tuple[list[int], Rows, np.ndarray]:
    """Ids of a sample in ascending order, which features each text has, and the label (0 or 1).

    Features are found in the sample's tasks; the driver gets the chosen features of each text, not the text.
    """
    schema = T.StructType([rows.schema["doc_id"], T.StructField("label", T.BooleanType()),
                           T.StructField("features", T.ArrayType(T.IntegerType()))])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        doc, feature = find().of(b.column(2).to_pylist())
        ends = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(ends, feature.astype(np.int32))],
                                          schema.names)

    got = arrow_map(rows.select("doc_id", F.coalesce(label, F.lit(False)).alias("label"), "text"), run, schema).toArrow()
    size = find().size
    if not got.num_rows:
        return [], Rows(np.empty(0, np.int32), np.empty(0, np.int32), 0, size), np.zeros(0)
    ids, lists = got.column("doc_id").to_numpy(), got.column("features").combine_chunks()
    order = np.argsort(ids)
    starts, ends = lists.offsets.to_numpy()[:-1], lists.offsets.to_numpy()[1:]
    lengths = (ends - starts)[order].astype(np.int64)
    features = lists.values.to_numpy()[spread(starts[order].astype(np.int64), lengths)]
    y = got.column("label").to_numpy().astype(float)[order]
    return ids[order].tolist(), Rows(np.repeat(np.arange(len(ids), dtype=np.int32), lengths), features, len(ids), size), y


class Rows:
    """Sparse 0/1 rows."""

    def __init__(self, doc: np.ndarray, feature: np.ndarray, n: int, size: int):
        self.doc, self.feature, self.n, self.size = doc, feature, n, size

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, w[self.feature], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.feature, r[self.doc], self.size)

    def take(self, rows: np.ndarray) -> Rows:
        """The rows for which the mask ``rows`` holds, renumbered."""
        keep = rows[self.doc]
        return Rows((np.cumsum(rows) - 1)[self.doc[keep]], self.feature[keep], int(rows.sum()), self.size)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: Rows, dense: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Weights of the sparse features, the dense columns and the bias, by L-BFGS on the ridge-penalised log loss."""
    m = dense.shape[1]

    def loss(w):
        z = x.dot(w[:x.size]) + (dense * w[x.size:x.size + m]).sum(axis=1) + w[-1]
        r = sigmoid(z) - y
        value = np.logaddexp(0, z).sum() - (y * z).sum() + 0.5 * ridge * (w[:-1] ** 2).sum()
        return value, np.concatenate((x.back(r), (dense * r[:, None]).sum(axis=0), [r.sum()])) + ridge * np.append(w[:-1], 0.0)

    w = np.zeros(x.size + m + 1)
    value, g = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, used = g.copy(), []
        for s, t in reversed(past):
            a = s @ d / (t @ s)
            used.append(a)
            d -= a * t
        if past:
            s, t = past[-1]
            d *= s @ t / (t @ t)
        for (s, t), a in zip(past, reversed(used)):
            d += (a - t @ d / (t @ s)) * s
        size = 1.0 if past else 1.0 / max(1.0, np.abs(g).max())
        while True:
            new = w - size * d
            new_value, new_g = loss(new)
            if new_value <= value - 1e-4 * size * (g @ d) or size < 1e-8:
                break
            size /= 2
        s, t = new - w, new_g - g
        if value - new_value < 1e-6 * max(1.0, abs(value)):
            w = new if new_value < value else w
            break
        if s @ t > 1e-12:
            past = [*past[-6:], (s, t)]
        w, value, g = new, new_value, new_g
    return w


def folds_of(ids: list[int], k: int) -> np.ndarray:
    """A fold for each id, from its hash."""
    h = mixed((np.array(ids, np.int64).view(_UINT) + _UINT(1)) * _UINT(_STEP))
    return (h >> _UINT(40)).astype(np.int64) % k
