"""The preparation is fitted on the rows it is given, and nothing else."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import assoc, features, impute, prepare
from tessera.session import checkpoint_dir


@pytest.fixture(scope="module")
def train(spark):
    d = spark.range(1, 301).select(F.col("id").alias("_src_idx"), F.pow("id", F.lit(3)).alias("a"), (F.col("id") % 17).cast("double").alias("b"),
                                   (F.col("id") % 5).alias("c"), F.when(F.col("id") % 4 > 0, "y").otherwise("x").alias("s"),
                                   F.lit("train").alias("split"), (F.col("id") % 2).cast("int").alias("t"))
    return d.select("_src_idx", *[F.when(F.col("_src_idx") % 11 == i, None).otherwise(F.col(c)).alias(c) for i, c in enumerate("abcs")],
                    "split", "t")


def test_equals_the_steps_one_by_one(train):
    prep = prepare.fit_preparation(train, "_src_idx", "t", exclude=("split",))
    whole = impute.impute_auto(train.drop("split"), key="_src_idx", method="median")
    whole = whole.withColumn("t", F.col("t").cast("int"))
    made, _ = features.standard_features(whole, "t", exclude=("_src_idx",))
    want, _ = assoc.prune_columns(made, "t", 0.95)
    got = prep.apply(train).drop("split")
    assert sorted(got.columns) == sorted(want.columns) and prep.logs == ("a",)
    cols = sorted(got.columns)
    a, b = (d.select(*cols).orderBy("_src_idx").collect() for d in (got, want))
    for x, y in zip(a, b, strict=True):
        assert tuple(x) == pytest.approx(tuple(y)) if not any(isinstance(v, str) for v in x) else all(
            u == v or u == pytest.approx(v) for u, v in zip(x, y))


def test_other_rows_have_no_say(spark, train):
    wild = train.limit(50).withColumn("a", F.lit(-1e12)).withColumn("s", F.lit("wild")).withColumn("split", F.lit("test"))
    both = train.unionByName(wild)
    prep = prepare.fit_preparation(both.where("split = 'train'"), "_src_idx", "t", exclude=("split",))
    assert prep == prepare.fit_preparation(train, "_src_idx", "t", exclude=("split",))
    out = prep.apply(both)
    assert out.count() == 350 and out.where("split = 'test' AND s = 'wild'").count() == 50
    assert out.where("split = 'test'").where("log_a <> 0").count() == 0  # values below those of training rows


def test_saved_and_loaded(spark, train):
    prep = prepare.fit_preparation(train, "_src_idx", "t", exclude=("split",))
    path = f"{checkpoint_dir(spark)}/preparation-test-{id(prep)}"
    prep.save(spark, path)
    assert prepare.Preparation.load(spark, path) == prep


def test_missing_infinite_and_clashing(spark):
    nan = float("nan")
    d = spark.createDataFrame([(1, None, nan, None, 1.0, 0), (2, None, 4.0, None, 2.0, 1), (3, None, 6.0, None, 3.0, None)],
                              "k long, e double, n double, s string, feat_sum double, t int")
    prep = prepare.fit_preparation(d, "k", "t", threshold=1.1)
    assert prep.numeric == {"e": 0.0, "n": 5.0} and prep.text == {"s": "MISSING"}
    rows = prep.apply(d).orderBy("k").collect()
    assert [r["feat_sum"] for r in rows] == [5.0, 4.0, 6.0] and [r["n"] for r in rows] == [5.0, 4.0, 6.0] and {r["s"] for r in rows} == {"MISSING"}
    assert prep.apply(d.limit(0)).count() == 0
    nothing = prepare.fit_preparation(d.limit(0), "k", "t")
    assert nothing.apply(d).count() == 3


def test_applying_moves_no_rows(train):
    plan = prepare.fit_preparation(train, "_src_idx", "t", exclude=("split",)).apply(train)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
