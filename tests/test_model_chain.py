"""Feature selection, permutation importance, the stack as a stage, halving and refits."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import models, permute, split
from tessera.plans.catalog_ml import scratch
from tessera.streaming import start_scoring_stream


@pytest.fixture(scope="module")
def planted(spark):
    """``a`` and ``cat`` decide the class, ``b`` does by half, ``n1`` and ``n2`` are noise."""
    h = lambda i: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1_000)) / 1_000
    late = ((h(1) + F.when(F.col("id") % 3 == 0, 0.4).otherwise(0.0) + h(2) * 0.3) > 0.75).cast("int")
    return spark.range(1_200).select(F.col("id").alias("_src_idx"), h(1).alias("a"), h(2).alias("b"), h(3).alias("n1"), h(4).alias("n2"),
                                     F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("cat"), late.alias("late")).cache()


def test_blocks_are_permutations(spark):
    import random
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    blocks = permute.blocked(df, "k", ["k", "v"], 1, 500, rows=60)
    o1, o2 = permute.offsets(random.Random(3), 2)
    rows = blocks.select("block", "r", F.posexplode("r").alias("place", "row")).select(
        "block", F.col("row.c0").alias("k"), permute.neighbour(F.col("r"), F.col("place"), F.lit(o1))["c1"].alias("v1"),
        permute.neighbour(F.col("r"), F.col("place"), F.lit(o2))["c1"].alias("v2"), F.size("r").alias("n")).collect()
    assert len({r.block for r in rows}) == 9 and sorted(r.k for r in rows) == list(range(500))
    assert sorted(r.v1 for r in rows) == sorted(r.v2 for r in rows) == list(range(0, 1000, 2))
    assert not any(r.v1 == 2 * r.k or r.v2 == 2 * r.k for r in rows if r.n > 1) and sum(r.v1 == r.v2 for r in rows) < 250


def test_boruta_tells_planted_columns_from_noise(planted):
    out = {r.feature: r for r in models.boruta_select(planted, ["a", "b", "n1", "n2"], "late", rounds=14, trees=15, categorical=["cat"]).collect()}
    assert list(out) == ["a", "b", "n1", "n2", "cat__oh_x", "cat__oh_y", "cat__oh___unknown"]
    assert out["cat__oh___unknown"].decision == "rejected"  # the place of categories not seen, always 0
    assert out["a"].selected and (out["cat__oh_x"].selected or out["cat__oh_y"].selected)
    assert not out["n1"].selected and not out["n2"].selected
    for r in out.values():  # the decision follows from the hits and rounds
        more = sum(math.comb(r.rounds, i) for i in range(r.hits, r.rounds + 1)) / 2 ** r.rounds
        fewer = sum(math.comb(r.rounds, i) for i in range(r.hits + 1)) / 2 ** r.rounds
        want = "confirmed" if more * 7 * 14 < 0.05 else "rejected" if fewer * 7 * 14 < 0.05 else "tentative"
        assert r.decision == want and r.selected == (want == "confirmed")


def test_binomial_decisions():
    assert models.binomial_tail(2, 2) == (0.25, 1.0) and models.binomial_tail(0, 3) == (1.0, 0.125)
    assert models.boruta_decision(20, 20, 100) == "confirmed" and models.boruta_decision(0, 20, 100) == "rejected"
    assert models.boruta_decision(10, 20, 1) == "tentative" and models.boruta_decision(0, 0, 1) == "tentative"


@pytest.fixture(scope="module")
def stacked(planted):
    """A stack fitted on the planted rows, as a bundle."""
    numeric, categorical = ["a", "b", "n1"], ["cat"]
    d, labels = models.with_label(split.kfold_assign(planted, "_src_idx", 2, "late"), "late", "classification")
    fm = models.Pipeline(stages=models.feature_stages(numeric, categorical)).fit(d)
    prepared = fm.transform(d).select("_src_idx", "features", "label", "fold").cache()
    cat = models.model_catalog("classification", 42, trees=8)
    st = models.stacking(prepared, "classification", {k: cat[k] for k in ("RandomForest", "LogisticRegression")}, 2)
    model = models.PipelineModel([*fm.stages, st["fit"]()])
    st["release"]()
    return models.ModelBundle(model, "late", "classification", "Stacking", numeric, categorical, labels)


def test_a_stack_is_saved_loaded_applied_and_streamed(spark, planted, stacked):
    want = models.predict_all(stacked, planted).select("_src_idx", "prediction", "proba_1").orderBy("_src_idx").collect()
    assert sum(r.prediction == d.late for r, d in zip(want, planted.orderBy("_src_idx").collect())) > 1_050
    path = scratch(spark)
    models.save_bundle(stacked, path)
    loaded = models.load_bundle(spark, path)
    assert isinstance(loaded.model.stages[-1], models.StackedModel) and loaded.model.stages[-1].uid == stacked.model.stages[-1].uid
    assert models.predict_all(loaded, planted).select("_src_idx", "prediction", "proba_1").orderBy("_src_idx").collect() == want
    planted.repartition(3).write.parquet(f"{path}/in")
    start_scoring_stream(spark, loaded, f"{path}/in", planted.schema, f"{path}/out", f"{path}/ckpt").awaitTermination()
    assert spark.read.parquet(f"{path}/out").select("_src_idx", "prediction", "proba_1").orderBy("_src_idx").collect() == want


def test_importance_of_any_model(spark, planted, stacked):
    out = {r.feature: r for r in models.permutation_importance(stacked, planted).collect()}
    assert set(out) == {"a", "b", "n1", "cat"} and out["a"].importance > 0.2 > 0.05 > abs(out["n1"].importance)
    assert all(abs(r.score - r.permuted - r.importance) < 1e-12 for r in out.values())
    top = models.feature_importance_topn(stacked, stacked.model.transform(planted), 2).collect()
    assert top[0].feature == "a" and len(top) == 2
    three = planted.withColumn("y", F.concat(F.lit("c"), F.floor(F.col("a") * 3)))
    gbt = models.model_catalog("classification", rounds=3, classes=3)["GradientBoosting"]
    b = models.fit_bundle(three, ["a", "n1"], [], "y", "classification", gbt)
    got = models.feature_importance_topn(b, b.model.transform(three), 5).collect()
    assert [r.feature for r in got] == ["a", "n1"] and got[0].importance > 0.8
    ridge = models.fit_bundle(planted, ["a", "b"], [], "b", "regression", models.model_catalog("regression")["Ridge"])
    assert {r.feature: r.importance > 0.1 for r in models.permutation_importance(ridge, planted).collect()} == {"a": False, "b": True}


def test_halving_keeps_the_best_and_ends_on_all_rows(planted):
    d = split.kfold_assign(planted, "_src_idx", 2, "late")
    prepared, _ = models.prepare(d, ["a", "b", "n1"], ["cat"], "late", "classification")
    prepared = prepared.select("_src_idx", "features", "label", "fold").cache()
    est = models.model_catalog("classification")["LogisticRegression"]
    found = models.tune_halving(prepared, "classification", "LogisticRegression", est, 2, trials=5, eta=2)
    rungs = {}
    for _, rung, trial, _, share, mean, _, kept in found["schedule"]:
        rungs.setdefault(rung, []).append((mean, -trial, kept, share))
    assert [len(rungs[r]) for r in sorted(rungs)] == [5, 3, 2, 1] and [rungs[r][0][3] for r in sorted(rungs)] == [0.125, 0.25, 0.5, 1.0]
    for rows in rungs.values():
        assert min((m, t) for m, t, kept, _ in rows if kept) >= max([(m, t) for m, t, kept, _ in rows if not kept], default=(-9e9, 0))
    assert found["mean"] == rungs[max(rungs)][0][0] > 0.8
    share = models.key_share("_src_idx", 42)
    inner = prepared.where(share < 0.25)
    assert inner.where(share < 0.125).count() == prepared.where(share < 0.125).count() and 200 < inner.count() < 400


def test_boosting_without_held_back_rows_runs_all_rounds(planted):
    est = models.model_catalog("classification", rounds=2, early_stop="held_back")["GradientBoosting"]
    d = split.kfold_assign(planted.limit(90), "_src_idx", 2, "late").withColumn("held_back", F.lit(False))
    prepared, _ = models.prepare(d, ["a", "b"], [], "late", "classification")
    out = models.cv_compare(prepared, "classification", {"GradientBoosting": est}, 2)["GradientBoosting"]
    assert out["reason"] is None and out["mean"] > 0.5
