"""Streams with repeated, late and malformed rows; folds and splits that leave rows in place; quantiles of wide spreads."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.quantile import quantile_row
from tessera.operators import models, split
from tessera.session import checkpoint_dir
from tessera.streaming import first_by_key, rows_behind, start_deduplicated_scoring

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.DoubleType()),
                       T.StructField("at", T.TimestampType())])


@pytest.fixture(scope="module")
def bundle(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 20).cast("double").alias("x"),
                                 (F.col("id") % 20 > 9).cast("int").alias("y"))
    est = models.model_catalog("classification", trees=5)["RandomForest"]
    return models.fit_bundle(df, ["x"], [], "y", "classification", est)


def _arrive(spark, path, rows):
    lines = [r if isinstance(r, str) else json.dumps(dict(zip(("k", "x", "at"), r))) for r in rows]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.mode("append").text(path)


def _folder(spark, tmp_path_factory):
    return f"{checkpoint_dir(spark)}/{tmp_path_factory.mktemp('stream').name}-{id(tmp_path_factory)}"


def _run(spark, bundle, base, delay):
    scored, aside = start_deduplicated_scoring(spark, bundle, f"{base}/in", SCHEMA, "k", "at", delay, f"{base}/out",
                                               max_files_per_trigger=1)
    scored.awaitTermination()
    aside.awaitTermination()
    return rows_behind(scored)


def test_repeats_late_rows_malformed_rows_and_a_restart(spark, bundle, tmp_path_factory):
    base = _folder(spark, tmp_path_factory)
    _arrive(spark, f"{base}/in", [(1, 1.0, "2024-01-01T10:00:00"), (1, 1.0, "2024-01-01T10:00:00"), (2, 15.0, "2024-01-01T11:00:00"),
                                  '{"k": 3, "x":', (None, 1.0, "2024-01-01T10:00:00"), (4, 1.0, None), (5, "no", "2024-01-01T10:00:00")])
    assert _run(spark, bundle, base, "2 hours") == 0
    # after a restart: a repeat, a late row within the delay
    _arrive(spark, f"{base}/in", [(2, 15.0, "2024-01-01T11:00:00"), (6, 3.0, "2024-01-01T09:30:00"), (7, 12.0, "2024-01-01T18:00:00")])
    assert _run(spark, bundle, base, "2 hours") == 0
    # a repeat and a new row behind the watermark are left out and counted; a run without news changes nothing
    _arrive(spark, f"{base}/in", [(1, 1.0, "2024-01-01T10:00:00"), (8, 3.0, "2024-01-01T10:00:00")])
    assert _run(spark, bundle, base, "2 hours") == 2
    _run(spark, bundle, base, "2 hours")
    got = {r["k"]: r["prediction"] for r in spark.read.parquet(f"{base}/out/scored").collect()}
    assert spark.read.parquet(f"{base}/out/scored").count() == 4
    assert got == {1: 0.0, 2: 1.0, 6: 0.0, 7: 1.0}
    aside = [r["record"] for r in spark.read.parquet(f"{base}/out/malformed").collect()]
    assert len(aside) == 4 and '{"k": 3, "x":' in aside and sum('"no"' in r for r in aside) == 1


def test_a_key_that_comes_again_after_the_delay_is_a_new_row(spark, tmp_path_factory):
    """The state forgets a key once the watermark has passed it: its size is that of one delay."""
    base = _folder(spark, tmp_path_factory)
    for rows in ([(1, 0.0, "2024-01-01T00:00:00")], [(1, 0.0, "2024-01-01T00:00:00"), (10, 0.0, "2024-01-02T00:00:00")],
                 [(11, 0.0, "2024-01-03T00:00:00")], [(1, 0.0, "2024-01-03T00:00:00")]):
        _arrive(spark, f"{base}/in", rows)
        q = (first_by_key(spark.readStream.schema(SCHEMA).json(f"{base}/in"), "k", "at", "1 hour").writeStream.format("parquet")
             .option("path", f"{base}/got").option("checkpointLocation", f"{base}/log").trigger(availableNow=True).start())
        q.awaitTermination()
    assert spark.read.parquet(f"{base}/got").where("k = 1").count() == 2
    held = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert held[-1] <= 2


@pytest.mark.parametrize("k", [2, 3, 5])
def test_ranges_are_even_in_every_class(spark, k):
    df = spark.range(503).select("id", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 3).alias("y"), F.lit(9).alias("fold"))
    got = split.kfold_ranges(df, "id", k, "y")
    sizes = {}
    for r in got.groupBy("y", "fold").count().collect():
        sizes.setdefault(r["y"], []).append(r["count"])
    assert got.count() == 503 and got.columns == ["id", "y", "fold"]
    assert all(len(v) == k and max(v) - min(v) <= 1 for v in sizes.values())
    assert sorted(got.collect()) == sorted(split.kfold_ranges(df.repartition(5), "id", k, "y").collect())


def test_ranges_of_small_empty_and_odd_tables(spark):
    few = spark.range(3).withColumnRenamed("id", "a.b")
    assert sorted(r["fold"] for r in split.kfold_ranges(few, "a.b", 5).collect()) == [1, 3, 4]
    assert split.kfold_ranges(spark.range(0), "id", 5).count() == 0
    twice = spark.range(50).union(spark.range(50)).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    per_key = split.kfold_ranges(twice, "id", 4).groupBy("id").agg(F.count_distinct("fold").alias("f"), F.count("*").alias("n")).collect()
    assert len(per_key) == 51 and all(r["f"] == 1 for r in per_key)
    t = split.train_test_split(twice, "id")
    assert t.count() == 101


def test_ranges_leave_whole_rows_in_place(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    plan = split.kfold_ranges(orders, "o_orderkey", 5, "o_orderstatus")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_gn" in plan
    assert not [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "o_totalprice" in x]


def test_more_cuts_than_may_be_collected_are_joined(spark, monkeypatch):
    df = spark.range(60).withColumn("y", F.col("id") % 4)
    want = [sorted(f(df, "id", label="y").collect()) for f in (split.train_test_split, split.kfold_ranges)]
    monkeypatch.setattr(split, "CUT_ROWS", 1)
    assert [sorted(f(df, "id", label="y").collect()) for f in (split.train_test_split, split.kfold_ranges)] == want


def test_quantiles_over_hundreds_of_powers_of_ten(spark):
    values = [s * (1 + i % 9) * 10.0 ** (i % 300 - 150) for i in range(1500) for s in (1, -1)] + [0.0, 5e-324, -5e-324, 1e308]
    got = quantile_row(spark.createDataFrame([(v,) for v in values], "v double"), ["v"], [0.0, 0.1, 0.5, 0.77, 1.0])
    values.sort()
    for q in (0.0, 0.1, 0.5, 0.77, 1.0):
        pos = q * (len(values) - 1)
        lo, hi = values[int(pos)], values[min(int(pos) + 1, len(values) - 1)]
        want = lo if pos == int(pos) or lo == hi else lo + (hi - lo) * (pos - int(pos))
        assert got[("v", q)] == pytest.approx(want, rel=1e-12)


def test_a_wide_spread_needs_few_levels(spark, monkeypatch):
    from tessera.functions import quantile
    levels = []
    real = quantile._part
    monkeypatch.setattr(quantile, "_part", lambda x, lo, hi, b: levels.append((lo, hi)) or real(x, lo, hi, b))
    df = spark.range(4000).select((F.pow(F.lit(10.0), F.col("id") % 260 - 130) * (1 + F.rand(3))).alias("v"))
    quantile_row(df, ["v"], [0.25])
    assert len(levels) <= 2 * 6
