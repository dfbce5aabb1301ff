"""Models, cross-validation, tuning, stacking and scoring on pyspark.ml
(inventory 61, 64-70, 79, 80).

Training data is prepared once (indexers, one-hot, assembler fitted on the
training rows), persisted, and reused by every fit; each fit is a
distributed ``pyspark.ml`` job. Folds come from ``kfold_assign`` (stratified,
reproducible), so CV is a filter on the fold column, not a resample.
"""

from __future__ import annotations

import functools
import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, OneVsRestModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import permute
from tessera.operators.metrics import accuracy as acc_metric
from tessera.operators.metrics import rmse_r2
from tessera.operators.split import kfold_assign
from tessera.session import ROWS_PER_TRAINING_TASK, persist_sized, persisted

FAIL_SCORE = -9999.0
#: Labelled rows that a model search is fitted on at most (about).
FIT_ROWS = 1_000_000
#: Rows of a partition of a frame that many settings are fitted on side by side.
TUNING_ROWS = 500_000
#: Independent fits that run at the same time.
PARALLEL_FITS = 8


def feature_stages(numeric: list[str], categorical: list[str]) -> list:
    """Indexing/encoding/assembly stages producing ``features`` (no label stage, so a
    fitted model scores rows that carry no target)."""
    stages = []
    oh = []
    if categorical:
        ix = [f"{c}__ix" for c in categorical]
        oh = [f"{c}__oh" for c in categorical]
        stages += [StringIndexer(inputCols=categorical, outputCols=ix, handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=ix, outputCols=oh, dropLast=True, handleInvalid="keep")]
    stages.append(VectorAssembler(inputCols=list(numeric) + oh, outputCol="features", handleInvalid="keep"))
    return stages


def with_label(df: DataFrame, target: str, problem_type: str, labels: list[str] | None = None):
    """Add ``label``: class index (alphabetical labels) or the numeric target. Returns (df, labels)."""
    if problem_type != "classification":
        return df.withColumn("label", F.col(target).cast("double")), []
    tgt = F.col(target).cast("string")
    if labels is None:
        m = StringIndexer(inputCol="__t", outputCol="label", stringOrderType="alphabetAsc").fit(
            df.select(tgt.alias("__t")))
        labels = list(m.labels)
    idx = F.array_position(F.array(*[F.lit(x) for x in labels]), tgt) - 1
    return df.withColumn("label", F.when(idx >= 0, idx.cast("double"))).where(F.col("label").isNotNull()), labels


def prepare(df: DataFrame, numeric, categorical, label, problem_type):
    """Fit the feature stages and return (prepared frame, fitted feature model)."""
    d, _labels = with_label(df, label, problem_type)
    fm = Pipeline(stages=feature_stages(numeric, categorical)).fit(d)
    return fm.transform(d), fm


def model_catalog(problem_type: str, seed: int = 42, trees: int = 100, rounds: int = 100,
                  tree_memory_mb: int = 128, classes: int = 2,
                  early_stop: str | None = None) -> dict:
    """Estimators per problem type: random forest (``trees``), gradient boosting
    (``rounds`` boosting rounds), logistic / ridge. Spark's boosting is binary, so with more
    than two ``classes`` it is wrapped one-vs-rest. ``early_stop`` names a boolean column of
    the training frame: boosting then ends when these rows stop improving, at ``rounds`` at most.

    ``tree_memory_mb`` caps the split statistics one task holds per pass
    (Spark's default is 256 MB per task, which several concurrent tasks on a
    small executor cannot afford)."""
    mem = {"maxMemoryInMB": tree_memory_mb}
    stop = {"validationIndicatorCol": early_stop} if early_stop else {}
    if problem_type == "classification":
        boost = GBTClassifier(maxIter=rounds, seed=seed, **mem, **stop)
        return {"RandomForest": RandomForestClassifier(numTrees=trees, seed=seed, **mem),
                "GradientBoosting": boost if classes <= 2 else OneVsRest(classifier=boost),
                "LogisticRegression": LogisticRegression(maxIter=1000)}
    return {"RandomForest": RandomForestRegressor(numTrees=trees, seed=seed, **mem),
            "GradientBoosting": GBTRegressor(maxIter=rounds, seed=seed, **mem, **stop),
            "Ridge": LinearRegression(regParam=1.0, elasticNetParam=0.0)}


def bounded_fit_rows(df: DataFrame, key: str, max_rows: int = FIT_ROWS, seed: int = 42) -> DataFrame:
    """``df`` if it has at most ``max_rows`` rows, else about that many, picked by a seeded hash of the key.

    The one bound of the model search: how many labelled rows it is fitted on.
    """
    n = df.count()
    if n <= max_rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 20)) < int(max_rows / n * (1 << 20)) + 1)


def _in_parallel(spark, jobs: list) -> list:
    """Results of independent fits, a bounded number at a time (each is a chain of small Spark jobs)."""
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return list(pool.map(lambda f: f(), [inheritable_thread_target(spark)(j) for j in jobs]))


def _with_params(est, params: dict):
    """A copy of ``est`` with ``params``; those of a one-vs-rest estimator go to its inner one."""
    if isinstance(est, OneVsRest):
        return OneVsRest(classifier=_with_params(est.getClassifier(), params))
    return est.copy({est.getParam(k): v for k, v in params.items()})


def _score(pred: DataFrame, problem_type: str) -> float:
    if problem_type == "classification":
        return float(acc_metric(pred, "label", "prediction").first()["accuracy"] or 0.0)
    r = rmse_r2(pred, "label", "prediction").first()["r2"]
    return float(r) if r is not None else FAIL_SCORE


def _without_early_stop(est):
    """A copy of ``est`` that runs all its rounds, if it would stop early."""
    inner = est.getClassifier() if isinstance(est, OneVsRest) else est
    if not (inner.hasParam("validationIndicatorCol") and inner.isSet("validationIndicatorCol")):
        return None
    inner = inner.copy()
    inner.clear(inner.getParam("validationIndicatorCol"))
    return OneVsRest(classifier=inner) if isinstance(est, OneVsRest) else inner


def fit_rows(est, rows: DataFrame):
    """``est`` fitted on ``rows``; without early stopping where no row is held back for it, or all are."""
    full = _without_early_stop(est)
    if full is not None:
        inner = est.getClassifier() if isinstance(est, OneVsRest) else est
        held = inner.getOrDefault("validationIndicatorCol")
        if len(rows.select(held).distinct().limit(2).collect()) < 2:
            est = full
    return est.fit(rows)


def _fold_score(est, prepared: DataFrame, problem_type: str, f: int, fold_col: str = "fold"):
    """Score on fold ``f`` of a model fitted on the others, or why the model cannot be fitted."""
    try:
        m = fit_rows(est, prepared.where(F.col(fold_col) != f))
        return _score(m.transform(prepared.where(F.col(fold_col) == f)), problem_type), None
    except (IllegalArgumentException, ValueError) as e:  # wrong for this model or these data; anything else is raised
        return FAIL_SCORE, str(e)[:200]


def cv_scores(est, prepared: DataFrame, problem_type: str, k: int, fold_col: str = "fold") -> list[float]:
    return [s for s, _ in _in_parallel(prepared.sparkSession, [functools.partial(_fold_score, est, prepared, problem_type, f, fold_col) for f in range(k)])]


def _mean_std(xs):
    m = sum(xs) / len(xs)
    return m, math.sqrt(sum((x - m) ** 2 for x in xs) / len(xs))


def _cv_all(cases: list, prepared: DataFrame, problem_type: str, k: int) -> list[dict]:
    """Mean, std (population) and failure reason of every estimator of ``cases``; all folds of all cases run together."""
    jobs = [functools.partial(_fold_score, est, prepared, problem_type, f) for est in cases for f in range(k)]
    found = _in_parallel(prepared.sparkSession, jobs)
    out = []
    for i in range(len(cases)):
        part = found[i * k:(i + 1) * k]
        m, sd = _mean_std([s for s, _ in part])
        why = next((w for _, w in part if w), None)
        out.append({"mean": FAIL_SCORE if why else m, "std": 0.0 if why else sd, "reason": why})
    return out


def cv_compare(prepared: DataFrame, problem_type: str, models: dict, k: int) -> dict:
    """Mean and std (population, as numpy) of the fold metric per model; one that cannot be fitted scores -9999, with the reason."""
    return dict(zip(models, _cv_all(list(models.values()), prepared, problem_type, k)))


# search spaces: (kind, low, high, log)
SEARCH_SPACE = {
    "RandomForest": {"numTrees": ("int", 50, 300, False), "maxDepth": ("int", 3, 20, False),
                     "minInstancesPerNode": ("int", 1, 10, False)},
    "GradientBoosting": {"maxIter": ("int", 50, 300, False), "stepSize": ("float", 0.01, 0.3, True),
                         "maxDepth": ("int", 2, 8, False), "subsamplingRate": ("float", 0.5, 1.0, False)},
    "LogisticRegression": {"regParam": ("float", 0.001, 100.0, True)},
    "Ridge": {"regParam": ("float", 0.001, 100.0, True)},
}


def sample_params(name: str, rng: random.Random) -> dict:
    out = {}
    for p, (kind, lo, hi, log) in SEARCH_SPACE.get(name, {}).items():
        if kind == "int":
            out[p] = rng.randint(lo, hi)
        elif log:
            out[p] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
        else:
            out[p] = rng.uniform(lo, hi)
    return out


def _cost(name: str, p: dict) -> float:
    """Rough cost of a fit, for cheap-first order: boosting rounds run one after another."""
    return p.get("maxIter", 0) * 10 * p.get("maxDepth", 1) + p.get("numTrees", 0) * p.get("maxDepth", 1)


def tune_top(prepared: DataFrame, problem_type: str, models: dict, baseline: dict, k: int,
             top: int = 3, trials: int = 20, seed: int = 42) -> dict:
    """Seeded random search for the ``top`` best baselines on the ``k`` folds; all trials run together, cheap ones first."""
    names = sorted(baseline, key=lambda n: baseline[n]["mean"], reverse=True)[:top]
    rng = random.Random(seed)
    cases = sorted(((n, sample_params(n, rng)) for n in names for _ in range(trials)), key=lambda c: _cost(*c))
    results = _cv_all([_with_params(models[n], p) for n, p in cases], prepared, problem_type, k)
    tuned = {}
    for (n, p), r in zip(cases, results):
        if n not in tuned or r["mean"] > tuned[n]["mean"]:
            tuned[n] = {"estimator": _with_params(models[n], p), "params": p, **r}
    return tuned


def _base_output(model, df: DataFrame, i: int, problem_type: str) -> DataFrame:
    """``df`` with the ``i``-th base's output ``s<i>``, an array: all class probabilities but the first, or the prediction."""
    out = with_probability(model.transform(df)) if problem_type == "classification" else model.transform(df)
    col = F.expr("slice(p, 2, greatest(size(p) - 1, 1))") if problem_type == "classification" else F.array("prediction")
    if problem_type == "classification":
        out = out.withColumn("p", vector_to_array("probability"))
    return out.withColumn(f"s{i}", col).drop("p", "prediction", "probability", "rawPrediction")


def _stack_vector(n: int):
    return array_to_vector(F.concat(*[F.col(f"s{i}") for i in range(n)]))


class StackedModel(Model, MLReadable, MLWritable):
    """Fitted bases and the meta model over their outputs: a pipeline stage that transforms any prepared frame without a
    join, also a stream, and is saved and loaded with the models it holds."""

    def __init__(self, bases: list | None = None, meta=None, problem_type: str = "classification"):
        super().__init__()
        self.bases, self.meta, self.problem_type = bases or [], meta, problem_type

    def _transform(self, prepared: DataFrame) -> DataFrame:
        out = prepared
        for i, b in enumerate(self.bases):
            out = _base_output(b, out, i, self.problem_type)
        # not by an assembler, which looks at a first row for the sizes: a stream has none
        out = out.withColumn("_stack", _stack_vector(len(self.bases)))
        self.meta.setFeaturesCol("_stack")
        return self.meta.transform(out).drop("_stack", *[f"s{i}" for i in range(len(self.bases))])

    def write(self):
        return _StackedWriter(self)

    @classmethod
    def read(cls):
        return _StackedReader()


class _StackedWriter(MLWriter):
    def __init__(self, instance: StackedModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, {"bases": len(m.bases), "problem_type": m.problem_type})
        for i, b in enumerate([*m.bases, m.meta]):
            b.write().save(f"{path}/model-{i}")


class _StackedReader(MLReader):
    def load(self, path: str) -> StackedModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        models = [DefaultParamsReader.loadParamsInstance(f"{path}/model-{i}", self.sparkSession) for i in range(meta["bases"] + 1)]
        out = StackedModel(models[:-1], models[-1], meta["problem_type"])
        out._resetUid(meta["uid"])
        return out


def stacking(prepared: DataFrame, problem_type: str, bases: dict, k: int, key: str = "_src_idx") -> dict:
    """Stack the base estimators: their out-of-fold outputs feed a logistic/linear meta model.

    For each fold the bases are fitted on the other folds and applied to it one
    after another (they read the same features, so nothing is joined); the meta model is
    scored with the same folds. ``fit`` gives the model that predicts: bases and meta
    model fitted on all rows.
    """
    names = list(bases)
    fitted = _in_parallel(prepared.sparkSession, [functools.partial(bases[n].fit, prepared.where(F.col("fold") != f)) for f in range(k) for n in names])
    oof = None
    for f in range(k):
        part = prepared.where(F.col("fold") == f)
        for i in range(len(names)):
            part = _base_output(fitted[f * len(names) + i], part, i, problem_type)
        part = part.select(key, "label", "fold", *[f"s{i}" for i in range(len(names))])
        oof = part if oof is None else oof.unionByName(part)
    oof = oof.withColumn("features", _stack_vector(len(names))).persist()
    meta = LogisticRegression(maxIter=1000) if problem_type == "classification" else LinearRegression(regParam=1.0)
    m, sd = _mean_std(cv_scores(meta, oof, problem_type, k))

    def fit() -> StackedModel:
        whole = _in_parallel(prepared.sparkSession, [functools.partial(bases[n].fit, prepared) for n in names])
        return StackedModel(whole, meta.fit(oof), problem_type)
    return {"mean": m, "std": sd, "bases": names, "meta": meta, "fit": fit, "release": oof.unpersist}


def with_probability(out: DataFrame) -> DataFrame:
    """``out`` with a ``probability`` vector; a model that gives raw scores only (one-vs-rest) gets their softmax."""
    if "probability" in out.columns:
        return out
    raw = vector_to_array("rawPrediction")
    e = F.transform(raw, lambda x: F.exp(x - F.array_max(raw)))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return out.withColumn("probability", array_to_vector(F.transform(e, lambda x: x / total)))


def search(prepared: DataFrame, problem_type: str, models: dict, k: int = 5, trials: int = 20, seed: int = 42) -> dict:
    """Baselines, the tuned top three and their stack, and the best of them refitted on all rows of ``prepared``."""
    base = cv_compare(prepared, problem_type, models, k)
    tuned = tune_top(prepared, problem_type, models, base, k, trials=trials, seed=seed)
    usable = {n: v["estimator"] for n, v in tuned.items() if not v["reason"]}
    stack = stacking(prepared, problem_type, usable, k)
    best = max(tuned, key=lambda n: tuned[n]["mean"])
    if stack["mean"] > tuned[best]["mean"]:
        name, model = "Stacking", stack["fit"]()
    else:
        name, model = f"{best}_Tuned", tuned[best]["estimator"].fit(prepared)
    stack["release"]()
    return {"baseline": base, "tuned": tuned, "stack": stack, "name": name, "model": model}


def refit(found: dict, prepared: DataFrame, problem_type: str, k: int):
    """The winner of a :func:`search` fitted anew on all rows of ``prepared`` (which carry folds, for a stack)."""
    usable = {n: v["estimator"] for n, v in found["tuned"].items() if not v["reason"]}
    if found["name"] != "Stacking":
        return usable[found["name"].removesuffix("_Tuned")].fit(prepared)
    stack = stacking(prepared, problem_type, usable, k)
    try:
        return stack["fit"]()
    finally:
        stack["release"]()


def key_share(key: str, seed: int):
    """A number in [0, 1) for each key, the same on every engine: the first 32 bits of a hash."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("double") / float(1 << 32)


def tune_halving(prepared: DataFrame, problem_type: str, name: str, estimator, k: int, trials: int = 20, eta: int = 3,
                 seed: int = 42, key: str = "_src_idx") -> dict:
    """Successive halving of ``trials`` seeded random settings of one model.

    In each rung the remaining settings are scored by ``k``-fold cross-validation on a share of the rows, and the
    best one in ``eta`` stays. Shares are nested (a row belongs to a share by a hash of its key) and grow ``eta``-fold up
    to all rows in the last rung. Ties go to the earlier trial. Returns ``schedule``, a list of ``(model, rung, trial, params, share,
    mean, std, kept)`` rows, and the winner's ``estimator``, ``params``, ``mean`` and ``std`` (of the last rung).
    """
    rng = random.Random(seed)
    left = [(i, sample_params(name, rng)) for i in range(trials)]
    rungs, n = 1, trials
    while n > 1:
        n, rungs = -(-n // eta), rungs + 1
    schedule, scores = [], {}
    for rung in range(rungs):
        share = float(eta) ** (rung - rungs + 1)
        # a step of an optimiser sends something from each partition to the driver: no more of them than the rung's rows need
        whole = rung == rungs - 1
        part = prepared if whole else persist_sized(prepared.where(key_share(key, seed) < share), TUNING_ROWS, keep_slots=False)
        try:
            results = _cv_all([_with_params(estimator, p) for _, p in left], part, problem_type, k)
        finally:
            if not whole:
                part.unpersist()
        scores = {i: r for (i, _), r in zip(left, results)}
        best = sorted(left, key=lambda t: (-scores[t[0]]["mean"], t[0]))
        stay = {i for i, _ in best[:-(-len(left) // eta)]} if rung < rungs - 1 else {best[0][0]}
        schedule += [(name, rung, i, json.dumps(p, sort_keys=True), share, scores[i]["mean"], scores[i]["std"], i in stay) for i, p in left]
        left = [t for t in left if t[0] in stay]
    (i, params), = left
    return {"schedule": schedule, "estimator": _with_params(estimator, params), "params": params, **scores[i]}


SCHEDULE = "model string, rung int, trial int, params string, share double, mean double, std double, kept boolean"


def model_ranking(spark, baseline: dict, tuned: dict, stack: dict | None = None) -> DataFrame:
    """All CV means: baselines, ``<name>_Tuned`` and Stacking; best = max over tuned rows."""
    rows = [(n, float(v["mean"]), float(v["std"]), False) for n, v in baseline.items()]
    rows += [(f"{n}_Tuned", float(v["mean"]), float(v["std"]), True) for n, v in tuned.items()]
    if stack:
        rows.append(("Stacking", float(stack["mean"]), float(stack["std"]), True))
    df = spark.createDataFrame(rows, "model string, mean double, std double, tuned boolean")
    return df.orderBy(F.desc("mean"), "model")


@dataclass
class ModelBundle:
    """Fitted feature stages + estimator, with the metadata the reference pickled."""
    model: PipelineModel
    target: str
    problem_type: str
    name: str
    numeric: list
    categorical: list
    labels: list = field(default_factory=list)
    test_score: float | None = None
    params: dict = field(default_factory=dict)

    def meta(self) -> dict:
        return {"target": self.target, "problem_type": self.problem_type, "name": self.name,
                "numeric": self.numeric, "categorical": self.categorical, "labels": self.labels,
                "test_score": self.test_score, "params": self.params}


def fit_bundle(train: DataFrame, numeric, categorical, target, problem_type, estimator, name="model",
               params=None) -> ModelBundle:
    d, labels = with_label(train, target, problem_type)
    # fitting reads the input several times (metadata, split candidates, training)
    dd = persist_sized(d)
    try:
        pm = Pipeline(stages=feature_stages(numeric, categorical) + [estimator]).fit(dd)
    finally:
        dd.unpersist()
    return ModelBundle(pm, target, problem_type, name, list(numeric), list(categorical), labels,
                       params=params or {})


def predict_all(bundle: ModelBundle, df: DataFrame) -> DataFrame:
    """Every input row plus ``prediction`` (original label value, as double when numeric),
    ``prediction_label`` (string), ``prediction_proba`` (probability of the winning class,
    4 digits) and ``proba_1`` (probability of class index 1).

    The model is applied row-wise to the frame itself, so each prediction stays
    attached to its own row key; nothing is aligned by position.
    """
    out = bundle.model.transform(df)
    if bundle.problem_type == "classification":
        out = with_probability(out)
    keep = [F.col(f"`{c}`") for c in df.columns]
    if bundle.problem_type == "classification":
        lab = F.element_at(F.array(*[F.lit(x) for x in bundle.labels]), F.col("prediction").cast("int") + 1)
        probs = vector_to_array(F.col("probability"))
        return out.select(*keep,
                          F.when(lab.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), lab.cast("double")).alias("prediction"),
                          lab.alias("prediction_label"),
                          F.round(F.array_max(probs), 4).alias("prediction_proba"),
                          (F.element_at(probs, 2) if len(bundle.labels) > 1 else F.lit(None)).alias("proba_1"))
    return out.select(*keep, F.col("prediction"))


def score_rows(bundle: ModelBundle, spark, rows: list[dict]) -> DataFrame:
    """Score a handful of given rows; a feature that a row does not have is 0 (a category: unknown)."""
    cols = bundle.numeric + bundle.categorical
    recs = [{**{c: (0.0 if r.get(c) is None else float(r[c])) for c in bundle.numeric},
             **{c: (None if r.get(c) is None else str(r[c])) for c in bundle.categorical}} for r in rows]
    schema = ", ".join([f"`{c}` double" for c in bundle.numeric] + [f"`{c}` string" for c in bundle.categorical])
    return predict_all(bundle, spark.createDataFrame([tuple(r[c] for c in cols) for r in recs], schema))


def feature_names(prepared: DataFrame) -> list[str]:
    """Names of the places of the ``features`` vector, in order (empty if the column carries none)."""
    attrs = prepared.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    return [name for _, name in sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)]


def _own_importance(est) -> list[float]:
    """A model's own importance of each feature: of trees, or of absolute coefficients; one-vs-rest models are averaged."""
    if isinstance(est, OneVsRestModel):
        each = [_own_importance(m) for m in est.models]
        return [sum(v) / len(each) for v in zip(*each)]
    if hasattr(est, "featureImportances"):
        return [float(v) for v in est.featureImportances.toArray()]
    if hasattr(est, "coefficientMatrix"):
        rows = est.coefficientMatrix.toArray()
        return [float(sum(abs(r[j]) for r in rows)) for j in range(len(rows[0]))]
    return [abs(float(v)) for v in est.coefficients.toArray()] if hasattr(est, "coefficients") else []


def feature_importance_topn(bundle: ModelBundle, prepared: DataFrame, n: int = 15, key: str = "_src_idx") -> DataFrame:
    """(feature, importance) top ``n``: the model's own importances of encoded features; for a model without any (a
    stack) the permutation importances of its input columns over the rows of ``prepared``."""
    spark = prepared.sparkSession
    own = _own_importance(bundle.model.stages[-1])
    if not own:
        return permutation_importance(bundle, prepared, key).select("feature", "importance").orderBy(
            F.desc("importance"), "feature").limit(n)
    names = dict(enumerate(feature_names(prepared)))
    rows = [(names.get(i, f"f{i}"), v) for i, v in enumerate(own)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature").limit(n)


def permutation_importance(bundle: ModelBundle, df: DataFrame, key: str = "_src_idx", seed: int = 42) -> DataFrame:
    """``(feature, importance, score, permuted)`` of every input column of any model.

    ``score`` is the accuracy (or R2) on the rows of ``df``, ``permuted`` the same with the column permuted, and ``importance``
    their difference. Every row is scored once as it is and once for each column, in one pass over blocks
    of rows (``permute``), and the scores are one grouped aggregate.
    """
    cols = bundle.numeric + bundle.categorical
    d, _ = with_label(df, bundle.target, bundle.problem_type, bundle.labels or None)
    n = d.count()
    turn = permute.offsets(random.Random(seed), len(cols))
    base = permute.blocked(d.select(key, "label", *[F.col(f"`{c}`") for c in cols]), key, ["label", *cols], seed, n)
    rows = base.select("r", F.posexplode("r").alias("place", "row")).select(
        "row", F.struct(*[permute.neighbour(F.col("r"), F.col("place"), F.lit(o))[f"c{i + 1}"].alias(f"c{i + 1}") for i, o in enumerate(turn)]).alias("other"))
    copies = rows.select("row", "other", F.explode(F.sequence(F.lit(0), F.lit(len(cols)))).alias("_copy"))
    copies = copies.select("_copy", F.col("row.c0").alias("label"), *[
        F.when(F.col("_copy") == i, F.col(f"other.c{i}")).otherwise(F.col(f"row.c{i}")).alias(c) for i, c in enumerate(cols, 1)])
    out = bundle.model.transform(copies)
    y, p = F.col("label"), F.col("prediction")
    score = F.avg((y == p).cast("double")) if bundle.problem_type == "classification" else \
        1 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))
    # one row per column
    scores = {r["_copy"]: r["score"] for r in out.groupBy("_copy").agg(score.alias("score")).collect()}
    found = [(c, scores[0] - scores[i], scores[0], scores[i]) if scores.get(0) is not None and scores.get(i) is not None else (c, None, None, None)
             for i, c in enumerate(cols, 1)]
    return df.sparkSession.createDataFrame(found, "feature string, importance double, score double, permuted double")


def binomial_tail(hits: int, rounds: int) -> tuple[float, float]:
    """P(at least ``hits``) and P(at most ``hits``) of ``rounds`` fair coin tosses."""
    ways = [math.comb(rounds, i) for i in range(rounds + 1)]
    return sum(ways[hits:]) / 2 ** rounds, sum(ways[:hits + 1]) / 2 ** rounds


def boruta_decision(hits: int, rounds: int, tests: int, alpha: float = 0.05) -> str:
    """``confirmed`` or ``rejected`` when the hits are too many or too few for chance, else ``tentative``.

    The binomial tail is multiplied by ``tests``, the looks that the whole run may take (features times rounds)."""
    more, fewer = binomial_tail(hits, rounds)
    return "confirmed" if more * tests < alpha else "rejected" if fewer * tests < alpha else "tentative"


def boruta_select(src: DataFrame, numeric: list[str], label: str, key: str = "_src_idx", rounds: int = 20, trees: int = 100,
                  seed: int = 42, tree_memory_mb: int = 128, categorical: list[str] | None = None, alpha: float = 0.05) -> DataFrame:
    """Shadow-feature selection over the encoded columns: ``(feature, hits, rounds, decision, selected)``.

    In a round every remaining feature gets a shadow, its own column permuted; a feature scores a hit when its
    random-forest importance beats every shadow's. After each round a binomial test, corrected for all features and rounds,
    confirms or rejects; a rejected feature leaves, a confirmed one stays but is tested no more, and the run ends when none is
    tentative or after ``rounds``. ``rounds`` of the result are those in which a feature was tested.

    Rows are put into blocks once (one shuffle); a round's shadows are turned within their blocks (``permute``). Blocks and a
    round's rows are kept on disk only and once: the executors' memory is left to the forest, which holds its own rows.
    """
    spark = src.sparkSession
    labelled, _ = with_label(src, label, "classification")
    fm = Pipeline(stages=feature_stages(numeric, categorical or [])).fit(labelled)
    coded = fm.transform(labelled)
    names = feature_names(coded)
    n = labelled.count()
    rows = coded.select(key, "label", vector_to_array("features").alias("x"))
    if not names:
        names = [f"f{i}" for i in range(len(rows.first()["x"]))] if n else []
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    records = spark.conf.get(size)
    spark.conf.set(size, "4")  # a block is one record
    tasks = -(-n // ROWS_PER_TRAINING_TASK)
    base = permute.packed(permute.blocked(rows, key, ["label", "x"], seed, n, tasks=tasks)).persist(StorageLevel.DISK_ONLY)
    hits, met, state = [0] * len(names), [0] * len(names), ["tentative"] * len(names)
    rng = random.Random(seed)
    try:
        base.count()
        have = base.rdd.getNumPartitions()
        tasks = max(tasks, min(have, spark.sparkContext.defaultParallelism))
        dealt = base.coalesce(tasks) if tasks < have else base
        for r in range(rounds if n else 0):
            active = [i for i, s in enumerate(state) if s != "rejected"]
            if not any(state[i] == "tentative" for i in active):
                break
            turn = permute.offsets(rng, len(active))
            d = permute.with_shadows(dealt, active, turn).select("label", array_to_vector("x").alias("features"))
            # the forest reads its input a few times before it holds rows of its own
            d = d.persist(StorageLevel.DISK_ONLY)
            try:
                rf = RandomForestClassifier(numTrees=trees, seed=seed + r, labelCol="label", maxMemoryInMB=tree_memory_mb).fit(d)
            finally:
                d.unpersist()
            won = _beats_shadows(rf.featureImportances.toArray(), len(active))
            for i, w in zip(active, won):
                if state[i] == "tentative":
                    hits[i], met[i] = hits[i] + w, met[i] + 1
                    state[i] = boruta_decision(hits[i], met[i], len(names) * rounds, alpha)
    finally:
        base.unpersist()
        spark.conf.set(size, records)
    found = [(name, hits[i], met[i], state[i], state[i] == "confirmed") for i, name in enumerate(names)]
    return spark.createDataFrame(found, "feature string, hits int, rounds int, decision string, selected boolean")


def _beats_shadows(importance, n: int) -> list[bool]:
    """For each of the first ``n`` importances whether it is above all the others (the shadows')."""
    most = max(importance[n:]) if len(importance) > n else 0.0
    return [bool(v > most) for v in importance[:n]]


def save_bundle(bundle: ModelBundle, path: str) -> None:
    bundle.model.write().overwrite().save(f"{path}/model")
    spark = bundle.model.stages[0].sparkSession if hasattr(bundle.model.stages[0], "sparkSession") else None
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(bundle.meta()),)], "meta string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/meta")


def load_bundle(spark, path: str) -> ModelBundle:
    pm = PipelineModel.load(f"{path}/model")
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    return ModelBundle(pm, meta["target"], meta["problem_type"], meta["name"], meta["numeric"],
                       meta["categorical"], meta["labels"], meta["test_score"], meta["params"])
