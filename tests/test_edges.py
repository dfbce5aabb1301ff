"""Hand-made edge frames (FIXTURES.md): nulls, constants, ties, empty, one row."""

import datetime
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions.names import standardize_names
from tessera.functions.quantile import exact_quantiles, mode_table
from tessera.functions.safe import safe_corr, sample_skew
from tessera.operators import assoc, features, groups, hypothesis, impute, metrics, profile, select, split


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(1, None, 5.0, "a", 1.0, 0.0), (2, None, 5.0, "b", 2.0, 0.0), (3, None, 5.0, "b", 4.0, 1.0),
            (4, None, 5.0, "a", 9.0, 0.0), (5, None, 5.0, None, None, 1.0)]
    return spark.createDataFrame(rows, "_src_idx long, all_null double, const double, cat string, x double, y double")


def test_standardize_names_collisions():
    assert standardize_names([" Order Id ", "order_id", "Width (cm)", "a$b"]) == ["order_id", "order_id_2", "width_cm", "ab"]


def test_id_like_substring_rule():
    assert assoc.id_like_columns(["width", "order_id", "target"], "target") == ["width", "order_id"]
    assert assoc.id_like_columns(["width", "order_id"], None, strict=True) == ["order_id"]


def test_skew_matches_pandas(edge):
    r = edge.agg(sample_skew("x").alias("s"), sample_skew("const").alias("c"), sample_skew("all_null").alias("n")).first()
    assert math.isclose(r["s"], pd.Series([1.0, 2.0, 4.0, 9.0]).skew(), rel_tol=1e-12)
    assert r["c"] == 0.0 and r["n"] is None


def test_safe_corr_constant_is_null(edge):
    r = edge.agg(safe_corr("x", "const").alias("c"), safe_corr("x", "y").alias("xy")).first()
    assert r["c"] is None
    pdf = edge.select("x", "y").toPandas()
    assert math.isclose(r["xy"], pdf["x"].corr(pdf["y"]), rel_tol=1e-12)


def test_correlation_matrix_paths_agree(spark, edge):
    full = assoc.correlation_matrix(edge, ["x", "y", "const"], full=True).collect()
    d = {(r.col_a, r.col_b): r.corr for r in full}
    assert d[("x", "const")] is None and d[("const", "const")] is None and d[("x", "x")] == 1.0
    nonull = edge.where(F.col("x").isNotNull())
    a = {(r.col_a, r.col_b): r.corr for r in assoc.correlation_matrix(nonull, ["x", "y"]).collect()}
    pdf = nonull.select("x", "y").toPandas()
    assert math.isclose(a[("x", "y")], pdf["x"].corr(pdf["y"]), rel_tol=1e-12)


def test_quantiles_ties_empty_single(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (2.0,)], "v double")
    q = {r.q: r.value for r in exact_quantiles(df, ["v"], [0.0, 0.5, 0.75, 1.0], buckets=2).collect()}
    s = pd.Series([1.0, 1.0, 1.0, 2.0])
    for k, v in q.items():
        assert math.isclose(v, s.quantile(k))
    one = spark.createDataFrame([(3.5,)], "v double")
    assert exact_quantiles(one, ["v"], [0.5]).first().value == 3.5
    empty = spark.createDataFrame([], "v double")
    assert exact_quantiles(empty, ["v"], [0.5]).first().value is None


def test_quantiles_of_hot_and_wild_columns(spark):
    rng = np.random.default_rng(0)
    n = 4000
    cols = {"hot": np.where(rng.random(n) < 0.97, 7.0, rng.normal(size=n)), "wild": rng.lognormal(0, 20, n) * rng.choice([-1, 1], n),
            "ends": np.concatenate([[-np.inf, np.inf, 5e-324, 0.0, 1e308], rng.normal(size=n - 5)]), "few": rng.integers(0, 3, n) * 1.0}
    pdf = pd.DataFrame(cols)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.name, r.q): r.value for r in exact_quantiles(spark.createDataFrame(pdf), list(cols), probs, buckets=64).collect()}
    for c in cols:
        v = np.sort(pdf[c].to_numpy())
        for q in probs:
            pos = q * (n - 1)
            lo, hi = v[math.floor(pos)], v[math.ceil(pos)]
            want = lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos))
            assert got[(c, q)] == want or math.isclose(got[(c, q)], want, rel_tol=1e-12), (c, q)
    plan = spark.createDataFrame([], "name string, q double, value double")
    assert exact_quantiles(spark.createDataFrame(pdf).limit(0), ["hot"], [0.5]).schema == plan.schema


def test_quantile_buckets_duplicate_edges(spark):
    df = spark.createDataFrame([(float(v), 1.0) for v in [1, 1, 1, 1, 1, 1, 2, 3]], "x double, t double")
    edges = groups.quantile_edges(df, "x", 4)
    assert edges == sorted(set(edges))  # duplicates dropped like qcut(duplicates='drop')
    out = groups.quantile_buckets(df, "x", "t", 4).collect()
    assert sum(r["count"] for r in out) == 8


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    m = mode_table(df, ["s"]).first()
    assert m["value"] == "a" and m["freq"] == 2


def test_impute_skips_all_null_and_uses_missing(spark, edge):
    out = impute.impute_median(edge, ["all_null", "x"]).collect()
    assert all(r["all_null"] is None for r in out)
    assert [r["x"] for r in out if r["_src_idx"] == 5][0] == 3.0  # median of 1,2,4,9
    allnull = spark.createDataFrame([(1, None), (2, None)], "k long, s string")
    assert {r["s"] for r in impute.impute_mode(allnull, ["s"]).collect()} == {"MISSING"}


def test_centres_fill_from_the_nearest_cluster(spark):
    rows = [(i, 10.0 * (i % 2), 100.0 * (i % 2) + (i % 5) * 0.1, None) for i in range(200)]
    rows += [(1000, 10.0, None, None), (1001, 0.0, None, None), (1002, None, 100.0, None), (1003, None, None, None)]
    df = spark.createDataFrame(rows, "_src_idx long, a double, b double, c double")
    got = {r["_src_idx"]: r for r in impute.impute_centres(df, ["a", "b", "c"], centres=2).collect()}
    assert abs(got[1000]["b"] - 100) < 1 and abs(got[1001]["b"]) < 1 and abs(got[1002]["a"] - 10) < 0.1
    assert abs(got[1003]["a"] - 5) < 0.1 and got[1003]["c"] is None
    assert all(got[i]["a"] == 10.0 * (i % 2) for i in range(200))
    # the same rule at every size: no row count changes the method
    auto = {r["_src_idx"]: r for r in impute.impute_auto(df.drop("c"), method="mean").collect()}
    assert auto[1003]["a"] == sum(r[1] for r in rows if r[1] is not None) / 202


def test_one_hot_keeps_every_level_of_a_wide_column(spark):
    df = spark.createDataFrame([(i, f"v{i:03d}") for i in range(60)] + [(99, None)], "_src_idx long, wide string")
    out, names = features.one_hot(df, ["wide"], form="vector")
    assert names == ["wide__levels"] and "wide" not in out.columns
    v = {r["_src_idx"]: r["wide__levels"] for r in out.collect()}
    assert v[0].size == 59 and v[0].numNonzeros() == 0 and v[99].numNonzeros() == 0
    assert len({tuple(v[i].indices) for i in range(1, 60)}) == 59
    full, _ = features.one_hot_vector(df, "wide", drop_first=False)
    assert all(r["wide__levels"].numNonzeros() == (r["_src_idx"] != 99) for r in full.collect())


def test_orders_without_lines_and_null_classes_are_kept(spark, sf_oracle):
    from tessera.plans.facts import order_frame
    f = order_frame(spark, sf_oracle)
    n = spark.read.parquet(f"{sf_oracle}/orders.parquet").count()
    assert f.count() == n and f.where("n_lines = 0 and late = 0 and sum_price = 0").count() > 0
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(100)], "k long, y int")
    s = split.train_test_split(df, "k", "y")
    assert s.count() == 100 and s.where("y is null and split = 'test'").count() == 2
    assert split.kfold_assign(df, "k", 5, "y").count() == 100


def test_filter_range_skips_by_the_data_only(spark):
    df = spark.createDataFrame([(i, 7) for i in range(10)], "a int, b int")
    assert select.filter_range(df, {"a": (5, 5)}).count() == 1
    assert select.filter_range(df, {"b": (0, 1)}).count() == 10


def test_text_derived_key(spark):
    df = spark.createDataFrame([(i, f"x{i % 3}") for i in range(90)], "v int, s string")
    spec = {"id": "H", "kind": "group_mean_derived", "key": "first", "expr": "upper(s)", "target": "v"}
    got = hypothesis.run_hypotheses(df, [spec]).collect()
    assert {r["grp"] for r in got} == {"X0", "X1", "X2"} and all(r["ord"] is None for r in got)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 5.0), (float("nan"), 2.0), (4.0, 4.0)], "a double, b double")
    p = {r["column"]: r for r in profile.column_profile(df).collect()}["a"]
    assert p["null_pct"] == 25.0 and p["max"] == 4.0 and p["nunique"] == 3
    assert profile.iqr_outliers(df).count() == 0
    h = profile.histogram(df, "a", 3).collect()
    assert sum(r["count"] for r in h) == 3 and h[0]["lower"] == 1.0
    assert assoc.correlation_matrix(df).first()["corr"] == pytest.approx(np.corrcoef([1, 2, 4], [1, 5, 4])[0, 1])


def test_pairwise_correlation_matches_pandas(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)) * [1, 10, 1e6, 1, 1, 0] + [0, 5, 1e8, 0, 0, 3]
    x[rng.random(x.shape) < 0.2] = np.nan
    pdf = pd.DataFrame(x, columns=list("abcdef"))
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in "abcdef"))
    want = pdf.corr()
    for r in assoc.correlation_matrix(df).collect():
        if "f" in (r["col_a"], r["col_b"]):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(want.loc[r["col_a"], r["col_b"]], abs=1e-8)


def test_null_time_belongs_to_no_side(spark):
    df = spark.createDataFrame([(i, None if i == 3 else datetime.datetime(2020, 1, 1 + i)) for i in range(10)], "k int, ts timestamp")
    out, _ = split.temporal_holdout(df, "ts")
    assert {r["k"]: r["split"] for r in out.collect()}[3] is None


def test_describe_covers_booleans_and_times(spark):
    df = spark.createDataFrame([(True, datetime.date(2020, 1, 1), datetime.datetime(2020, 1, 1))] * 2
                               + [(False, datetime.date(2020, 1, 2), None)], "b boolean, d date, t timestamp")
    d = {r["column"]: r for r in profile.describe_all(df).collect()}
    assert (d["b"]["unique"], d["b"]["top"], d["b"]["freq"]) == (2, "true", 2)
    assert d["d"]["top"] == "2020-01-01" and d["t"]["count"] == 2


def test_many_classes_in_a_report(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("a"), (F.col("id") % 1499).cast("string").alias("p"))
    rep = metrics.classification_report(df, "a", "p")
    assert rep.count() == 1503
    assert metrics.confusion_matrix(df.limit(20), "a", "p").count() == 400


def test_one_hot_drop_first_and_null_row(spark, edge):
    out, names = features.one_hot(edge.select("_src_idx", "cat"), ["cat"])
    assert names == ["cat_b"]
    r = {x["_src_idx"]: x["cat_b"] for x in out.collect()}
    assert r[5] == 0 and r[2] == 1 and r[1] == 0


def test_problem_type_rules(spark):
    df = spark.createDataFrame([(i % 3, float(i), str(i % 2)) for i in range(100)], "few long, cont double, s string")
    t = {r["column"]: r["problem_type"] for r in features.detect_problem_type(df, ["few", "cont", "s"]).collect()}
    assert t == {"few": "classification", "cont": "regression", "s": "classification"}


def test_split_stratified_sizes(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(1000)], "k long, y boolean")
    s = split.train_test_split(df, "k", "y", 0.2).groupBy("y", "split").count().collect()
    d = {(r["y"], r["split"]): r["count"] for r in s}
    assert d[(True, "test")] == round(334 * 0.2) and d[(False, "test")] == round(666 * 0.2)
    f = split.kfold_assign(df, "k", 5, "y").groupBy("y", "fold").count().collect()
    for cls in (True, False):
        sizes = [r["count"] for r in f if r["y"] == cls]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    again = split.kfold_assign(df, "k", 5, "y").orderBy("k").collect()
    assert again == split.kfold_assign(df, "k", 5, "y").orderBy("k").collect()


def test_classification_report_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 0.0), (0.0, 0.0)], "a double, p double")
    rep = {r["label"]: r for r in metrics.classification_report(df, "a", "p").collect()}
    assert rep["1.0"]["precision"] == 0.0 and rep["1.0"]["recall"] == 0.0 and rep["1.0"]["f1"] == 0.0
    assert rep["accuracy"]["precision"] == 0.5
    cm = metrics.confusion_matrix(df, "a", "p").collect()
    assert len(cm) == 4 and sum(r["count"] for r in cm) == 4


def test_kpis_empty_input(spark):
    df = spark.createDataFrame([], "prediction double, prediction_proba double")
    k = groups.prediction_kpis(df).first()
    assert k["rows"] == 0 and k["positive_pct"] == 0.0


def test_histogram_constant_column(spark, edge):
    h = profile.histogram(edge, "const", 10).collect()
    assert len(h) == 10 and [r["count"] for r in h if r["bin"] == 0] == [5]


def test_filter_in_pushdown_and_empty(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    assert select.filter_in(li, "l_linenumber", []).count() == li.count()
    f = select.filter_in(li, "l_linenumber", ["1", "2.0"])
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(l_linenumber" in plan


def test_redundant_rule_earlier_dropped_still_counts(spark):
    pdf = pd.DataFrame({"a": np.arange(50.0), "b": np.arange(50.0) * 2 + 1, "c": np.arange(50.0) ** 1.01})
    df = spark.createDataFrame(pdf)
    red = [r["column"] for r in assoc.redundant_columns(df, ["a", "b", "c"]).collect()]
    assert red == ["b", "c"]
