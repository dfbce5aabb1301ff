"""Level dictionaries, encoders and dummies."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import features, levels


def test_codes_are_dense_and_sorted(spark):
    rows = [("b", "x"), ("a", "x"), (None, "y"), ("a", None), ("é", ""), ("B", "x")]
    df = spark.createDataFrame(rows, "s string, t string").repartition(3)
    got = sorted(tuple(r) for r in levels.level_dictionary(df, ["s", "t"]).select("column", "code", "level", "n").collect())
    assert got == [("s", 0, "B", 1), ("s", 1, "a", 2), ("s", 2, "b", 1), ("s", 3, "é", 1), ("t", 0, "", 1), ("t", 1, "x", 3), ("t", 2, "y", 1)]
    assert levels.level_dictionary(df.limit(0), ["s"]).count() == 0
    assert levels.level_counts(levels.level_dictionary(df, ["s"]), ["s", "none"]) == {"s": 4, "none": 0}


def test_five_million_levels_stay_in_a_table(spark):
    n = 5_000_000
    df = spark.range(n + 1).select(F.when(F.col("id") < n, F.format_string("%07d", (F.col("id") * 7) % n)).alias("s"), "id")
    enc, d = features.label_encode(df, "s", "code")
    # the code of a zero-padded number is the number, that of a NULL is NULL
    assert enc.where("code <> cast(s as int)").count() == 0 and enc.where("code is null").count() == 1
    back = features.label_decode(enc, "code", d, "back")
    assert back.where("not (back <=> s)").count() == 0
    plan = enc._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and len(plan) < 20_000  # no level is a literal of the plan
    out, names = features.one_hot(df.where("id < 5 or id >= 5000000"), ["s"], form="vector")
    assert names == ["s__levels"] and out.columns == ["id", "s__levels"]
    vec, _ = features.one_hot_vector(df.where("id < 2 or id = 5000000"), "s", dictionary=d)
    got = {r["id"]: r["s__levels"] for r in vec.collect()}
    assert got[0].size == n - 1 and got[0].numNonzeros() == 0 and got[1].indices.tolist() == [6] and got[n].numNonzeros() == 0


def test_unknown_levels_and_other_rows(spark):
    train = spark.createDataFrame([("a",), ("c",)], "s string")
    other = spark.createDataFrame([(1, "c"), (2, "b"), (3, None)], "k int, s string")
    _, d = features.label_encode(train, "s")
    enc, same = features.label_encode(other, "s", dictionary=d)
    assert {r.k: r.s_idx for r in enc.collect()} == {1: 1, 2: None, 3: None} and same is d
    assert {r.k: r.back for r in features.label_decode(enc, "s_idx", d, "back").collect()} == {1: "c", 2: None, 3: None}


def test_dummies_do_not_clash_and_the_form_is_named(spark):
    df = spark.createDataFrame([("a", "x", 0), ("b_x", "y", 0), ("c", "z", 1)], "k string, k_b string, K_C int")
    out, names = features.one_hot(df, ["k", "k_b"], drop_first=False)
    assert len(set(map(str.lower, out.columns))) == len(out.columns) == 1 + 6
    assert names == ["k_a", "k_b_x", "k_c_2", "k_b_x_2", "k_b_y", "k_b_z"]
    assert [r["k_b_x_2"] for r in out.orderBy("k_a", "k_b_x").collect()] == [0, 0, 1]
    wide = spark.range(80).select(F.col("id").cast("string").alias("w"))
    assert len(features.one_hot(wide, ["w"])[1]) == 79 and len(features.one_hot(wide, ["w"], form="vector")[1]) == 1
    with pytest.raises(ValueError):
        features.one_hot(wide, ["w"], form="wide")


def test_too_many_columns_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(features, "MOST_COLUMNS", 20)
    with pytest.raises(ValueError, match="vector"):
        features.one_hot(spark.range(80).select(F.col("id").cast("string").alias("w")), ["w"])
