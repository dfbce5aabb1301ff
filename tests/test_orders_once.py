"""The order frame that ``score_stream_repeats`` and ``best_model_chain`` split, fit on and score is written once, with every order."""

import pytest
from pyspark.sql import functions as F

from tessera.plans import catalog_ml
from tessera.plans.facts import order_frame


def _tables(spark, d):
    n = 60
    orders = spark.range(n).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 9 != 0, F.col("id") % 7).alias("o_custkey"),
        (F.col("id") * 1.5).alias("o_totalprice"), F.when(F.col("id") % 2 == 0, "1-URGENT").otherwise("5-LOW").alias("o_orderpriority"),
        F.lit("O").alias("o_orderstatus"), F.lit("1995-01-01").cast("date").alias("o_orderdate"))
    lines = spark.range(3 * n).where("id % 5 <> 0").select(
        (F.col("id") % n).alias("l_orderkey"), F.lit(3.0).alias("l_quantity"), (F.col("id") / 3).alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"), F.lit(0.02).alias("l_tax"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") % 60).cast("int")).alias("l_shipdate"))
    made = {"orders": orders, "lineitem": lines,
            "customer": spark.range(7).select(F.col("id").alias("c_custkey"), (F.col("id") % 2).alias("c_nationkey"),
                                              F.lit(1.0).alias("c_acctbal"), F.lit("M").alias("c_mktsegment")),
            "nation": spark.range(2).select(F.col("id").alias("n_nationkey"), F.lit(0).cast("long").alias("n_regionkey"), F.lit("N").alias("n_name")),
            "region": spark.range(1).select(F.col("id").alias("r_regionkey"), F.lit("R").alias("r_name"))}
    for name, df in made.items():
        df.write.parquet(f"{d}/{name}.parquet")


def test_training_rows_are_split_without_the_joins_behind_them(spark, tmp_path):
    d = str(tmp_path)
    _tables(spark, d)
    sp = catalog_ml._train_frame(spark, d, catalog_ml._orders_once(spark, d))
    assert not [f for f in sp.inputFiles() if "lineitem.parquet" in f]
    want = sorted(map(tuple, order_frame(spark, d).collect()))
    assert sorted(map(tuple, sp.drop("split").collect())) == want and len(want) == 60
    assert sp.where("split = 'test'").count() in range(10, 15)


def test_the_best_model_is_searched_and_fitted_without_the_joins_behind_it(spark, tmp_path, monkeypatch):
    d, met = str(tmp_path), []
    _tables(spark, d)

    class Stop(Exception):
        pass

    def bounded(df, *_):
        met.append(df)
        raise Stop

    monkeypatch.setattr(catalog_ml.models, "bounded_fit_rows", bounded)
    with pytest.raises(Stop):
        catalog_ml.q_best_model_chain(spark, d)
    assert not [f for f in met[0].inputFiles() if "lineitem.parquet" in f]
    assert met[0].count() in range(45, 51)
