"""Toxicity by a classifier chain.

The chain predicts one category after another, then toxicity as such. With one toxicity label, the categories are found in
the text of the toxic sample: its documents are grouped by the n-grams that mark toxic text (spherical k-means), so a
category is a kind of toxic wording; nothing but texts and the label is used. Each link is a logistic model of n-gram
indicators and of the probabilities of all links before it; in training those are out-of-fold predictions, so
a later link sees earlier probabilities as they are on unseen text.

Links are fitted on a bounded sample of labelled documents (``SAMPLE_DOCS``, texts of any length), on n-grams that mark toxic
text clearly more often than chance. Every document is then scored over its whole text.

Edge cases: a null or empty text has no n-gram and gets the links' base rates. Without toxic or without
clean labelled documents, a link returns its constant rate; so does a category that no document falls to. A toxic document
without a marked n-gram is of no category and teaches the last link only. Labels with nulls are not
learned from. Repeated rows are scored alike. Other columns pass through (``toxicity`` and ``categories`` are replaced). An empty table
gives an empty result.
"""

from __future__ import annotations

import dataclasses
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import linear
from tessera.llm.chunks import resident
from tessera.llm.common import arrow_map, documents

#: Categories of the chain's first links, the larger ones first; the last link is toxicity as such.
CATEGORIES = 4
FOLDS, THRESHOLD, RIDGE = 3, 0.5, 0.3
#: Labelled documents the chain is fitted on at most (about).
SAMPLE_DOCS = 6_000
#: N-grams of the chain at most, the texts one must be in, and how far (in standard errors) above chance it must be.
FEATURES, LEAST_TEXTS, LEAST_Z = 4_000, 3, 4.0


def words(text: str) -> list[str]:
    return text.lower().split()


@dataclasses.dataclass(frozen=True, eq=False)
class Chain:
    names: tuple[str, ...]
    chosen: np.ndarray  # sorted buckets
    weights: np.ndarray  # of each link: buckets
    earlier: np.ndarray  # of each link: earlier links' probabilities
    bias: np.ndarray

    @functools.cached_property
    def find(self) -> linear.Indicators:
        return linear.Indicators(words, self.chosen)

    def __reduce__(self):
        return Chain, (self.names, self.chosen, self.weights, self.earlier, self.bias)

    def predict(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities, one column for each link."""
        doc, feature = self.find.of(texts)
        out = np.zeros((len(texts), len(self.names)))
        for j in range(len(self.names)):
            z = np.bincount(doc, self.weights[j][feature], len(texts)) + (out[:, :j] * self.earlier[j, :j]).sum(axis=1) + self.bias[j]
            out[:, j] = linear.sigmoid(z)
        return out


def _choose(count: np.ndarray, total: np.ndarray, n: int, all_n: int) -> np.ndarray:
    """Buckets clearly more frequent in a category's texts (``count`` of ``n``) than in all (``total`` of ``all_n``)."""
    seen = np.flatnonzero(count >= LEAST_TEXTS)
    expected = total[seen] * (n / max(all_n, 1))
    z = (count[seen] - expected) / np.sqrt(np.maximum(expected * (1 - n / max(all_n, 1)), 1e-9))
    best = np.argsort(-z, kind="stable")[:FEATURES]
    return seen[best[z[best] >= LEAST_Z]]


def group_texts(x: linear.Rows, k: int, tries: int = 5, rounds: int = 25, seed: int = 7) -> np.ndarray:
    """A group from 0 to ``k`` - 1 for each row of ``x``, the largest group first; -1 for a row without features.

    Spherical k-means on rows of unit length, rarer features weighing more, from seeded starts that lie far apart.
    """
    seen = np.bincount(x.feature, minlength=x.size)
    v = np.log1p(x.n / np.maximum(seen, 1))[x.feature]
    length = np.sqrt(np.bincount(x.doc, v * v, x.n))
    v = v / length[x.doc] if len(v) else v
    has = np.flatnonzero(length > 0)
    best, group = -1.0, np.full(x.n, -1)
    if not len(has):
        return group
    rng = np.random.default_rng(seed)

    def near(centre: np.ndarray) -> np.ndarray:
        return np.bincount(x.doc, v * centre[x.feature], x.n)

    def row(i: int) -> np.ndarray:
        mine = x.doc == i
        return np.bincount(x.feature[mine], v[mine], x.size)

    for _ in range(tries):
        like = near(row(rng.choice(has)))[:, None]
        while like.shape[1] < k:
            far = np.clip(1 - like[has].max(axis=1), 0, None) ** 2
            if far.sum() < 1e-12:
                break
            like = np.column_stack((like, near(row(rng.choice(has, p=far / far.sum())))))
        for _ in range(rounds):
            of = like.argmax(axis=1)
            centres = [np.bincount(x.feature[of[x.doc] == j], v[of[x.doc] == j], x.size) for j in range(like.shape[1])]
            new = np.column_stack([near(c / (np.sqrt(c @ c) or 1.0)) for c in centres])
            same = (new.argmax(axis=1) == of).all()
            like = new
            if same:
                break
        fit = like[has].max(axis=1).sum()
        if fit > best + 1e-9:
            best, group = fit, np.where(length > 0, like.argmax(axis=1), -1)
    sizes = np.bincount(group[has], minlength=k)
    rank = np.empty(k, np.int64)
    rank[np.argsort(-sizes, kind="stable")] = np.arange(k)
    return np.where(group >= 0, rank[group], -1)


def fit_chain(sample: DataFrame, categories: int = CATEGORIES, folds: int = FOLDS) -> Chain:
    """The chain of a sample ``(doc_id, text, toxic)`` with one row per id."""
    names = tuple(f"category_{i + 1}" for i in range(categories)) + ("toxic",)
    marked = F.coalesce(F.col("toxic") == 1, F.lit(False))
    n_all, n_toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.count_if(marked), F.lit(0))).first()
    bucket, count, total = linear.gram_counts(sample, words, marked, LEAST_TEXTS)
    chosen = np.sort(bucket[_choose(count, total, n_toxic, n_all)])
    ids, x, y = linear.sample_rows(sample, marked, lambda: linear.Indicators(words, chosen))
    toxic = y > 0
    kind = np.full(len(ids), -1)
    kind[toxic] = group_texts(x.take(toxic), categories)
    y = np.column_stack([kind == j for j in range(categories)] + [toxic]).astype(float).reshape(len(ids), len(names))
    fold = linear.folds_of(ids, folds)
    weights, earlier, bias = np.zeros((len(names), len(chosen))), np.zeros((len(names), len(names))), np.zeros(len(names))
    unseen = np.zeros((len(ids), len(names)))
    for j in range(len(names)):
        n, k = len(ids), y[:, j].sum()
        if k == 0 or k == n:  # nothing to tell apart: the (smoothed) rate
            rate = (k + 0.5) / (n + 1)
            bias[j], unseen[:, j] = np.log(rate / (1 - rate)), rate
            continue
        for f in range(folds):
            out = fold == f
            if not out.any() or out.all():
                continue
            w = linear.fit_logistic(x.take(~out), unseen[~out, :j], y[~out, j], RIDGE)
            unseen[out, j] = linear.sigmoid(x.take(out).dot(w[:x.size]) + (unseen[out, :j] * w[x.size:-1]).sum(axis=1) + w[-1])
        w = linear.fit_logistic(x, unseen[:, :j], y[:, j], RIDGE)
        weights[j], earlier[j, :j], bias[j] = w[:x.size], w[x.size:-1], w[-1]
    return Chain(names, chosen, weights, earlier, bias)


def train(docs: DataFrame, labels: DataFrame) -> Chain:
    return fit_chain(linear.labelled_sample(docs, labels.select("doc_id", "toxic"), F.col("toxic").isNotNull(), ["toxic"],
                                            SAMPLE_DOCS))


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with ``toxicity`` (the last link's probability) and ``categories`` (every link's, in order)."""
    docs = docs.drop("toxicity", "categories")
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType()),
                           T.StructField("categories", T.ArrayType(T.DoubleType()))])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        p = _resident(chain).predict(b.column(at).to_pylist())
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(p[:, -1]), pa.array(list(p), pa.list_(pa.float64()))],
                                          [*b.schema.names, "toxicity", "categories"])

    return arrow_map(docs, run, schema)


def _resident(chain: Chain) -> Chain:
    """The same chain as the last task of this process had, with its word memory, if its weights are equal."""
    return resident(lambda held: isinstance(held, Chain) and np.array_equal(held.weights, chain.weights)
                    and np.array_equal(held.chosen, chain.chosen), lambda: chain)


def labels_of(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    chain = train(docs, labels_of(spark, sf_dir))
    scored = score(docs.select("doc_id", "text"), chain)
    return scored.select("doc_id", F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
                         *[F.col("categories")[i].alias(n) for i, n in enumerate(chain.names[:-1])])


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those whose toxicity reaches ``threshold``."""
    scored = score(docs.select("text", F.struct("*").alias("_row")), train(docs, labels))
    return scored.where(F.col("toxicity") < threshold).select("_row.*")
