"""Rows-only operators: invariants for models, scoring, streaming and file round trips."""

import math
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators import metrics, models, split
from tessera.plans.facts import ORDER_NUMERIC, order_frame
from tessera.session import checkpoint_dir
from tessera.sources import files
from tessera.streaming import start_scoring_stream

CAT = ["o_orderpriority", "o_orderstatus", "c_mktsegment", "r_name"]


def scratch(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/tests/{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def frame(spark, sf_small):
    return order_frame(spark, sf_small)


@pytest.fixture(scope="module")
def bundle(frame):
    est = models.model_catalog("classification", 42, trees=10)["RandomForest"]
    return models.fit_bundle(frame, ORDER_NUMERIC, CAT, "late", "classification", est, "RandomForest")


def test_predict_all_keeps_every_row(frame, bundle):
    out = models.predict_all(bundle, frame)
    n = frame.count()
    assert out.count() == n and out.select("_src_idx").distinct().count() == n
    r = out.agg(F.min("prediction_proba").alias("lo"), F.max("prediction_proba").alias("hi"),
                F.count_if(~F.col("prediction").isin(0.0, 1.0)).alias("bad")).first()
    assert 0.5 <= r["lo"] <= r["hi"] <= 1.0 and r["bad"] == 0
    assert dict(out.dtypes)["late"] == "int"


def test_metric_recomputed_matches_evaluator(frame, bundle):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    d, _ = models.with_label(frame, "late", "classification", bundle.labels)
    pred = bundle.model.transform(d)
    ev = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(pred)
    ours = metrics.accuracy(pred, "label", "prediction").first()["accuracy"]
    assert math.isclose(ev, ours, rel_tol=1e-12)


def test_save_load_and_score_rows(spark, frame, bundle):
    path = scratch(spark)
    models.save_bundle(bundle, path)
    b2 = models.load_bundle(spark, path)
    a = models.predict_all(bundle, frame).orderBy("_src_idx").select("prediction", "prediction_proba").collect()
    b = models.predict_all(b2, frame).orderBy("_src_idx").select("prediction", "prediction_proba").collect()
    assert a == b
    rows = [{"o_totalprice": 1000.0, "n_lines": 3, "o_orderpriority": "1-URGENT"}, {"c_acctbal": 5.0}]
    s = models.score_rows(b2, spark, rows).collect()
    assert len(s) == 2 and all(r["prediction"] in (0.0, 1.0) for r in s)
    # a missing number scores as 0
    zeros = {**{c: 0.0 for c in ORDER_NUMERIC}, "c_acctbal": 5.0}
    z = models.score_rows(b2, spark, [zeros]).first()
    assert (z["prediction"], z["proba_1"]) == (s[1]["prediction"], s[1]["proba_1"])


def test_stream_scoring_equals_batch(spark, frame, bundle):
    base = scratch(spark)
    frame.write.parquet(f"{base}/in")
    q = start_scoring_stream(spark, bundle, f"{base}/in", frame.schema, f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{base}/out").select("_src_idx", "prediction").orderBy("_src_idx").collect()
    exp = models.predict_all(bundle, frame).select("_src_idx", "prediction").orderBy("_src_idx").collect()
    assert got == exp


def test_cv_and_stacking_small(frame):
    f = split.kfold_assign(frame, "_src_idx", 2, "late")
    prepared, _ = models.prepare(f, ORDER_NUMERIC, CAT, "late", "classification")
    cat = models.model_catalog("classification", 42, trees=5, rounds=3)
    res = models.cv_compare(prepared, "classification", cat, 2)
    assert set(res) == set(cat) and all(0.0 <= v["mean"] <= 1.0 for v in res.values())
    st = models.stacking(prepared, "classification", {k: cat[k] for k in ("RandomForest", "LogisticRegression")}, 2)
    assert 0.0 <= st["mean"] <= 1.0
    out = st["fit"]().transform(prepared)
    assert out.count() == prepared.count() and out.where("prediction in (0, 1)").count() == out.count()
    st["release"]()


def test_search_finds_and_refits_the_best(frame):
    f = split.kfold_assign(frame, "_src_idx", 2, "late")
    prepared, _ = models.prepare(f, ORDER_NUMERIC, CAT, "late", "classification")
    cat = {"LogisticRegression": models.model_catalog("classification")["LogisticRegression"]}
    found = models.search(prepared, "classification", cat, 2, trials=2)
    best = max(found["tuned"]["LogisticRegression"]["mean"], found["stack"]["mean"])
    assert found["name"] in ("Stacking", "LogisticRegression_Tuned") and 0 <= best <= 1
    assert found["model"].transform(prepared).where("prediction is null").count() == 0


def test_three_classes(spark):
    df = spark.createDataFrame([(i, float(i % 30), ["a", "b", "c"][i % 30 // 10]) for i in range(300)], "_src_idx long, x double, y string")
    cat = models.model_catalog("classification", trees=5, rounds=3, classes=3)
    for est in (cat["GradientBoosting"], cat["RandomForest"]):
        b = models.fit_bundle(df, ["x"], [], "y", "classification", est)
        out = models.predict_all(b, df)
        assert out.where("prediction_label = y").count() >= 290
        assert out.where("prediction_proba between 0.33 and 1").count() == 300
    f = split.kfold_assign(df, "_src_idx", 2, "y")
    prepared, _ = models.prepare(f, ["x"], [], "y", "classification")
    st = models.stacking(prepared, "classification", {k: cat[k] for k in ("GradientBoosting", "RandomForest")}, 2)
    assert st["mean"] >= 0.9
    st["release"]()


def test_failures_that_are_not_the_models_are_raised(spark):
    from pyspark.ml.functions import array_to_vector
    bad = (spark.range(20).select(F.col("id").alias("_src_idx"), (F.col("id") % 2).cast("int").alias("fold"))
           .withColumn("features", array_to_vector(F.array(F.col("_src_idx").cast("double"))))
           .withColumn("label", F.expr("if(_src_idx >= 0, cast(raise_error('lost') as double), 1.0)")))
    with pytest.raises(Exception, match="lost"):
        models.cv_compare(bad, "classification", {"RandomForest": models.model_catalog("classification", trees=2)["RandomForest"]}, 2)


def test_boruta_rows(frame):
    out = models.boruta_select(frame, ORDER_NUMERIC[:3], "late", rounds=2, trees=5).collect()
    assert [r["feature"] for r in out] == ORDER_NUMERIC[:3] and all(0 <= r["hits"] <= 2 for r in out)


def test_csv_encodings(spark):
    base = scratch(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/latin.csv", "wb") as fh:
        fh.write("Nome Cliente,Valor (R$)\nJoão,1.5\nAçaí,2.5\n".encode("latin-1"))
    assert files.detect_encoding(spark, f"{base}/latin.csv") == "latin-1"
    df = files.read_csv_multi_encoding(spark, f"{base}/latin.csv")
    assert df.columns == ["nome_cliente", "valor_r"]
    assert sorted(r["nome_cliente"] for r in df.collect()) == ["Açaí", "João"]
    with open(f"{local}/utf8.csv", "wb") as fh:
        fh.write("a,b\nçã,1\n".encode("utf-8"))
    assert files.detect_encoding(spark, f"{base}/utf8.csv") == "utf-8"
    with open(f"{local}/zquotes.csv", "wb") as fh:
        fh.write(b'name,n\n"say ""hi"", then",1\n"two\nlines",2\n')
    got = files.read_csv_multi_encoding(spark, f"{base}/zquotes.csv", multi_line=True).collect()
    assert [tuple(r) for r in got] == [('say "hi", then', 1), ("two\nlines", 2)]
    assert files.pick_csv_in_folder(spark, base).endswith("latin.csv")


def test_layers_are_versioned(spark, frame):
    base = scratch(spark)
    p1 = files.write_layer(frame, base, "silver")
    p2 = files.write_layer(files.read_layer(spark, base, "silver").limit(5), base, "silver")
    assert p1.endswith("v=1") and p2.endswith("v=2")
    assert files.read_layer(spark, base, "silver").count() == 5
    assert files.layer_exists(spark, base, "silver") and not files.layer_exists(spark, base, "gold")
    files.write_config(spark, {"target_col": "late", "insights": ["a"]}, f"{base}/cfg")
    assert files.read_config(spark, f"{base}/cfg") == {"target_col": "late", "insights": ["a"]}


def test_regression_catalog(frame):
    f = split.kfold_assign(frame, "_src_idx", 2)
    prepared, _ = models.prepare(f, ["n_lines", "sum_qty", "sum_price"], ["o_orderpriority"], "o_totalprice",
                                 "regression")
    cat = models.model_catalog("regression", 42, trees=5, rounds=3)
    res = models.cv_compare(prepared, "regression", cat, 2)
    assert set(res) == {"RandomForest", "GradientBoosting", "Ridge"}
    assert all(v["mean"] > models.FAIL_SCORE for v in res.values())
    b = models.fit_bundle(frame, ["n_lines", "sum_qty", "sum_price"], ["o_orderpriority"], "o_totalprice",
                          "regression", cat["Ridge"], "Ridge")
    out = models.predict_all(b, frame)
    assert out.count() == frame.count() and dict(out.dtypes)["prediction"] == "double"
