"""Exact neighbour imputation against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import impute, knn

SCHEMA = "_src_idx long, a double, b double, c double, d double, t string"


def brute(rows, k, p=4):
    """Rows with every hole filled, or the column mean where nothing is shared."""
    x = [[None if v is None or math.isnan(v) else v for v in r[1:1 + p]] for r in rows]
    means = [np.mean([r[j] for r in x if r[j] is not None]) if any(r[j] is not None for r in x) else None for j in range(p)]
    out = {}
    for r, a in zip(rows, x):
        full = list(a)
        for c in range(p):
            if a[c] is None and means[c] is not None:
                near = []
                for q, d in zip(rows, x):
                    shared = [j for j in range(p) if a[j] is not None and d[j] is not None]
                    if d[c] is not None and shared:
                        total = 0.0
                        for j in shared:
                            total += (a[j] - d[j]) * (a[j] - d[j])
                        near.append((p / len(shared) * total, q[0], d[c]))
                near = sorted(near)[:k]
                full[c] = np.mean([v for _, _, v in near]) if near else means[c]
        out[r[0]] = full
    return out


def holes(n, seed, coarse):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.choice([0.0, 1.0, 2.0, 5.0]) if coarse else rng.gauss(0, 1) + 4 * (i % 5) for _ in range(4)]
        rows.append((i * 3, *[None if rng.random() < 0.15 else x for x in v], "t"))
    return rows


def check(df, want, **kw):
    got = {r[0]: r for r in impute.impute_knn(df, **kw).collect()}
    assert set(got) == set(want)
    for i, full in want.items():
        for g, w in zip(got[i][1:5], full):
            assert g == pytest.approx(w, abs=1e-9) if w is not None else g is None


@pytest.mark.parametrize("coarse,k", [(False, 5), (True, 5), (True, 1), (False, 400)])
def test_equals_brute_force_over_many_cells(spark, monkeypatch, coarse, k):
    monkeypatch.setattr(knn, "CELL_ROWS", 10)
    monkeypatch.setattr(knn, "PATTERNS", 3)  # most patterns share cells
    monkeypatch.setattr(knn, "PART_ROWS", 4)
    monkeypatch.setattr(knn, "TILE", 3)
    monkeypatch.setattr(knn, "BLOCK", 7)
    rows = holes(300, 1, coarse)
    check(spark.createDataFrame(rows, SCHEMA).repartition(4), brute(rows, k), k=k)


def test_edge_rows(spark):
    nan = float("nan")
    rows = [(1, 1.0, 2.0, nan, None, "x"), (2, None, None, None, None, "x"), (3, 1.5, nan, 7.0, None, None), (4, None, 2.5, None, None, "y"),
            (5, None, None, 9.0, None, "y"), (6, 100.0, 2.0, 8.0, None, "y")]
    check(spark.createDataFrame(rows, SCHEMA), brute(rows, 2), k=2)
    empty = spark.createDataFrame([], SCHEMA)
    assert impute.impute_knn(empty).count() == 0
    full = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 4.0, "x")], SCHEMA)
    assert impute.impute_knn(full).collect() == full.collect()
    no_key = spark.createDataFrame([(None, None, 2.0, 3.0, 4.0, "x"), (1, 3.0, 2.0, 3.0, 4.0, "x"), (2, 5.0, 2.0, 3.0, 4.0, "x")], SCHEMA)
    assert sorted(r.a for r in impute.impute_knn(no_key).collect()) == [3.0, 4.0, 5.0]


def test_a_hot_value_keeps_few_donors_and_text_keys_work(spark):
    rows = [(f"k{i:04d}", 1.0, 1.0 if i % 2 else None) for i in range(600)] + [("zz", None, 1.0), ("zy", 2.0, 3.0)]
    out = {r[0]: r for r in impute.impute_knn(spark.createDataFrame(rows, "id string, a double, b double").repartition(3), key="id").collect()}
    assert out["zz"].a == 1.0 and out["k0000"].b == 1.0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(0)
    donors = np.concatenate([rng.normal(c * 20, 1, (50, 3)) for c in range(6)])
    cells = knn.Cells([{"cell": c, "rows": 50, **{f"n{j}": 50 for j in range(3)},
                        **{f"lo{j}": donors[c * 50:c * 50 + 50, j].min() for j in range(3)},
                        **{f"hi{j}": donors[c * 50:c * 50 + 50, j].max() for j in range(3)}} for c in range(6)], 3)
    row = np.array([np.nan, 40.0, 41.0])
    dist = (3 / 2) * ((donors[:, 1:] - row[1:]) ** 2).sum(axis=1)
    assert (cells.bounds(row) <= dist.reshape(6, 50).min(axis=1)).all()
    assert cells.homes(row, 5).tolist() == [2]
    assert cells.routes(row, np.array([np.sort(dist)[4], np.nan, np.nan]), 5).tolist() == []
    assert cells.routes(row, np.array([np.inf, np.nan, np.nan]), 5).tolist() == [0, 1, 3, 4, 5]


def test_plan_has_no_cross_join(spark):
    df = spark.createDataFrame(holes(50, 2, False), SCHEMA)
    plan = impute.impute_knn(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_nan_is_missing_in_every_method(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None), (4, 5.0)], "_src_idx long, v double")
    for out in (impute.impute_median(df, ["v"]), impute.impute_mean(df, ["v"]), impute.impute_centres(df, ["v"], centres=2),
                impute.impute_knn(df), impute.impute_auto(df, method="knn"), impute.impute_auto(df)):
        got = {r["_src_idx"]: r["v"] for r in out.select("_src_idx", "v").collect()}
        assert got == {1: 1.0, 2: 3.0, 3: 3.0, 4: 5.0}
    only = impute.impute_centres(df.where(F.col("_src_idx") == 2), ["v"])
    assert only.first()["v"] is None


def test_centres_are_one_expression_however_many(spark):
    rng = random.Random(3)
    rows = [(i, *[None if rng.random() < 0.2 else rng.gauss(0, 1) for _ in range(3)]) for i in range(400)]
    df = spark.createDataFrame(rows, "_src_idx long, a double, b double, c double")
    fit = impute.fit_centres(df, ["a", "b", "c"], 64)
    out = impute.impute_centres(df, ["a", "b", "c"], centres=64)
    # a distance per centre and column, written out, outgrew what one generated method holds
    assert out._jdf.queryExecution().analyzed().toString().count("coalesce(") < 64
    got = {r[0]: r[1:] for r in out.collect()}
    for i, *row in rows:
        z = [None if v is None else (v - m) / d for v, m, d in zip(row, fit["mean"], fit["dev"])]
        near = min(([sum((x - v) * (x - v) for x, v in zip(z, c) if x is not None), c] for c in fit["centres"]))[1]
        for j in range(3):
            want = fit["mean"][j] if all(v is None for v in row) else near[j] * fit["dev"][j] + fit["mean"][j]
            assert got[i][j] == pytest.approx(want if row[j] is None else row[j], abs=1e-9)


def test_tiles_of_a_part_are_pruned_exactly(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (4_000, 3))
    asked = rng.normal(0, 1, (50, 3))
    asked[:, 0] = np.nan
    met, whole = [], knn._nearest
    monkeypatch.setattr(knn, "_nearest", lambda a, d, k: met.append(len(a) * len(d)) or whole(a, d, k))
    part = knn.Part(pa.array(range(len(x))), x)
    i, c, d, j = part.nearest(asked, np.full((50, 3), np.inf), 5)
    assert sum(met) < len(asked) * len(x) / 3 and set(c) == {0}
    for r in range(50):
        near = 1.5 * ((x[:, 1:] - asked[r, 1:]) ** 2).sum(axis=1)
        assert j[i == r].tolist() == np.argsort(near, kind="stable")[:5].tolist()


def test_tree_has_as_many_donors_on_either_side_and_splits_off_ties():
    rng = np.random.default_rng(2)
    x = np.column_stack((rng.normal(0, 9, 6_400), np.where(rng.random(6_400) < 0.8, 1.0, 0.0)))
    x[::7, 1] = np.nan
    leaves = np.bincount(knn.Tree(x, np.array([0.0, 0.8]), 5).leaf(x), minlength=32)
    assert leaves.min() > 100 and leaves.max() < 400
    assert set(knn.Tree(np.array([[0.0], [1.0], [1.0], [1.0]]), np.zeros(1), 1).leaf(np.array([[0.0], [1.0]]))) == {0, 1}
