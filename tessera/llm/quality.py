"""Quality classifier: support vectors on naive Bayes features.

Indicators of n-grams (character n-grams inside words, words, and runs in the sequence that
tells words met before from new ones) are scaled by their class log-count ratio, rows are brought to length one, and a
linear hinge-loss model is fitted by dual coordinate descent. Margins of left-out folds give
the sigmoid that turns a margin into a probability of label 1.

Training uses a bounded sample (``linear.SAMPLE_DOCS``) of the labelled rows that are not held out, texts of any length;
every document is scored over its whole text. Labels, language, source and id are no inputs.

Edge cases: a null or empty text has the bias alone. With one class only, the score is the (smoothed)
rate of label 1, with none 0.5. Null labels are not learned from. A null id is held out. Repeated rows are scored
alike; other columns pass through (``score`` is replaced). An empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import linear
from tessera.llm.chunks import resident
from tessera.llm.common import arrow_map, documents

CUT, FOLDS, COST, EPOCHS = 0.3, 3, 1.0, 8
#: N-grams of the model at most, and the texts one must be in.
FEATURES, LEAST_TEXTS = 60_000, 3
#: Lengths of runs of words met before, and of one word repeated, that are features.
MET_RUNS, SAME_RUNS = (2, 4, 8, 12, 16, 24, 32, 48, 64), (1, 2, 4, 8)
N_RUNS = len(MET_RUNS) + len(SAME_RUNS)


def words(text: str) -> list[str]:
    return text.split()


def runs(rows: np.ndarray) -> list[int]:
    """Which run features a sequence of words has."""
    met, last, met_run, same_run, most_met, most_same = set(), None, 0, 0, 0, 0
    for r in rows.tolist():
        if r in met:
            met_run += 1
            if r == last:
                same_run += 1
                if same_run > most_same:
                    most_same = same_run
            else:
                same_run = 0
            if met_run > most_met:
                most_met = met_run
        else:
            met.add(r)
            met_run = same_run = 0
        last = r
    return [i for i, n in enumerate(MET_RUNS) if most_met >= n] + [len(MET_RUNS) + i for i, n in enumerate(SAME_RUNS) if most_same >= n]


@dataclasses.dataclass(frozen=True, eq=False)
class Model:
    chosen: np.ndarray  # sorted buckets
    ratio: np.ndarray  # log-count ratio of each feature
    weights: np.ndarray  # of the scaled, normalised features
    bias: float
    slope: float  # of the sigmoid
    shift: float

    @functools.cached_property
    def find(self) -> linear.Indicators:
        return linear.Indicators(words, self.chosen, runs, N_RUNS)

    def __reduce__(self):
        return Model, tuple(getattr(self, f.name) for f in dataclasses.fields(self))

    def predict(self, texts: list[str | None]) -> np.ndarray:
        doc, feature = self.find.of(texts)
        top = np.bincount(doc, (self.weights * self.ratio)[feature], len(texts))
        length = np.sqrt(np.bincount(doc, (self.ratio ** 2)[feature], len(texts)))
        margin = top / np.where(length > 0, length, 1.0) + self.bias
        return linear.sigmoid(self.slope * margin + self.shift)


def log_count_ratio(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    p, q = pos + 1.0, neg + 1.0
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float = COST,
                 epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge-loss model, one dual variable at a time."""
    w, b, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            g = y[i] * (w[at] @ v + b) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[at] += step * v
                b += step
                most = max(most, abs(step))
            alpha[i] = new
        if most < 1e-3:
            break
    return w, b


def fit_sigmoid(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the probability of label 1 (targets smoothed by the class sizes)."""
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    p = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    a = np.column_stack((margin, np.ones(len(margin))))
    for _ in range(steps):
        s = linear.sigmoid(a @ p)
        g = a.T @ (s - t)
        h = (a * (s * (1 - s))[:, None]).T @ a + 1e-6 * np.eye(2)
        d = np.linalg.solve(h, g)
        p = p - d / max(1.0, np.abs(d).max() / 4)
        if np.abs(d).max() < 1e-8:
            break
    return float(p[0]), float(p[1])


def choose(bucket: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    """The n-grams that tell most: their ratio, weighed by the texts that have them."""
    weight = np.abs(log_count_ratio(pos, neg)) * np.sqrt(pos.astype(float) + neg)
    return np.sort(bucket[np.argsort(-weight, kind="stable")[:FEATURES]])


def fit(sample: DataFrame, folds: int = FOLDS) -> Model:
    """The model of a sample ``(doc_id, text, quality)`` with one row per id."""
    good = F.col("quality") == 1
    bucket, pos, seen = linear.gram_counts(sample, words, F.coalesce(good, F.lit(False)), LEAST_TEXTS)
    chosen = choose(bucket, pos, seen - pos)
    ids, x, y = linear.sample_rows(sample, good, lambda: linear.Indicators(words, chosen, runs, N_RUNS))
    n1 = float(y.sum())
    empty = np.empty(0, np.int64)
    if n1 in (0.0, float(len(y))):
        rate = (n1 + 0.5) / (len(y) + 1)
        return Model(empty, np.zeros(N_RUNS), np.zeros(N_RUNS), 0.0, 0.0, float(np.log(rate / (1 - rate))))
    cuts = np.searchsorted(x.doc, np.arange(len(ids) + 1))
    parts = [x.feature[a:b] for a, b in zip(cuts, cuts[1:])]
    sign = np.where(y == 1, 1.0, -1.0)

    def train(mask: np.ndarray):
        keep = x.take(mask)
        pos = np.bincount(keep.feature, y[mask][keep.doc], x.size)
        ratio = log_count_ratio(pos, np.bincount(keep.feature, minlength=x.size) - pos)
        rows = [scaled(parts[i], ratio) for i in np.flatnonzero(mask)]
        return ratio, *dual_descent(rows, sign[mask], x.size)

    def scaled(at, ratio):
        v = ratio[at]
        return at, v / (np.sqrt(v @ v) or 1.0)

    fold, margin = linear.folds_of(ids, folds), np.zeros(len(ids))
    for f in range(folds):
        out = fold == f
        if out.any() and not out.all():
            ratio, w, b = train(~out)
            for i in np.flatnonzero(out):
                at, v = scaled(parts[i], ratio)
                margin[i] = w[at] @ v + b
    slope, shift = fit_sigmoid(margin, y)
    ratio, w, b = train(np.ones(len(ids), bool))
    return Model(chosen, ratio, w, float(b), slope, shift)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(linear.labelled_sample(docs.select("doc_id", "text"), labels.select("doc_id", "quality"),
                                      F.col("quality").isNotNull() & ~held_out(F.col("doc_id")), ["quality"]))


def _resident(model: Model) -> Model:
    """The same model as the last task of this process had, with its word memory, if its weights are equal."""
    return resident(lambda held: isinstance(held, Model) and np.array_equal(held.weights, model.weights)
                    and np.array_equal(held.chosen, model.chosen), lambda: model)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1."""
    docs = docs.drop("score")
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(_resident(model).predict(b.column(at).to_pylist()))],
                                          [*b.schema.names, "score"])

    return arrow_map(docs, run, schema)


def query(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    # the text stays behind: only the id and the score leave the task
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= CUT).cast("int").alias("predicted"))
