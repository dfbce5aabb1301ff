"""Analysis frames derived from the driver tables (TPC-H-like star schema).

These play the role of the reference's flat supply-chain table: a fact row
(order line or order) with item, customer and geography attributes, a delay
measure and a 0/1 "late" target. All frames are lazy; Catalyst prunes the
columns each query does not use and pushes filters into the parquet scans.

Join strategy at scale: lineitem x orders and orders x customer are
big-big joins left to sort-merge on the key (AQE splits skewed key
partitions); nation and region are fixed-size dimensions broadcast behind a
row-count check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checked_broadcast

LATE_AFTER_DAYS = 30


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load_table(spark, sf_dir, "nation")
    r = load_table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    return checked_broadcast(geo, 10_000, cache_key=f"geo:{sf_dir}")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    g = _geo(spark, sf_dir)
    return c.join(g, c.c_nationkey == g.n_nationkey, "left").drop("n_nationkey")


def late_expr(ship="l_shipdate", order="o_orderdate"):
    return (F.col(ship) > F.col(order) + F.expr(f"INTERVAL {LATE_AFTER_DAYS} DAYS")).cast("int")


def money_sum(c: str):
    """Sum of a money column, exact to six decimals: values are added as wide decimals (no
    order dependence across tasks or engines) and turned into a double once."""
    return F.sum(F.col(c).cast("decimal(28,6)")).cast("double")


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: lineitem x orders x customer x nation x region.

    Adds ``delay_days`` (ship - order date) and ``late`` (shipped more than
    30 days after the order).
    """
    li = load_table(spark, sf_dir, "lineitem")
    o = load_table(spark, sf_dir, "orders")
    f = li.join(o, li.l_orderkey == o.o_orderkey)
    f = f.join(_customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    return (f.withColumn("delay_days", F.datediff("l_shipdate", "o_orderdate"))
             .withColumn("late", late_expr()))


def line_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders only, with ``late`` and ``delay_days`` (no dimension joins)."""
    li = load_table(spark, sf_dir, "lineitem")
    o = load_table(spark, sf_dir, "orders")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .withColumn("delay_days", F.datediff("l_shipdate", "o_orderdate"))
              .withColumn("late", late_expr()))


def order_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, keyed by the unique ``o_orderkey`` (our ``_src_idx``).

    orders left-joins its lines once; the line measures are aggregated per
    order with the order's own attributes as extra grouping keys (they depend
    on the key), so the aggregate reuses the join's order-key partitioning and
    orders is read once. An order without lines has 0 lines and zero measures and
    is not late; one without a known customer has NULL customer columns.
    Money sums and means are exact (``money_sum``). Target ``late`` = more
    than half of the order's lines shipped late.
    """
    li = load_table(spark, sf_dir, "lineitem")
    o = load_table(spark, sf_dir, "orders")
    zero = F.lit(0.0)
    f = (o.join(li, li.l_orderkey == o.o_orderkey, "left")
           .groupBy("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
           .agg(F.count("l_orderkey").alias("n_lines"),
                F.coalesce(F.sum("l_quantity"), zero).alias("sum_qty"),
                F.coalesce(money_sum("l_extendedprice"), zero).alias("sum_price"),
                F.coalesce(F.try_divide(money_sum("l_discount"), F.count("l_discount")), zero).alias("avg_discount"),
                F.coalesce(F.try_divide(money_sum("l_tax"), F.count("l_tax")), zero).alias("avg_tax"),
                F.coalesce(F.avg(late_expr()), zero).alias("late_share")))
    f = f.join(_customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "left")
    return f.select(
        F.col("o_orderkey").alias("_src_idx"), "o_totalprice", "n_lines", "sum_qty", "sum_price",
        "avg_discount", "avg_tax", "c_acctbal", "o_orderpriority", "o_orderstatus", "c_mktsegment",
        "r_name", "n_name", (F.col("late_share") > 0.5).cast("int").alias("late"))


ORDER_NUMERIC = ["o_totalprice", "n_lines", "sum_qty", "sum_price", "avg_discount", "avg_tax", "c_acctbal"]
ORDER_CATEGORICAL = ["o_orderpriority", "o_orderstatus", "c_mktsegment", "r_name", "n_name"]


def event_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events keyed by ``event_id``: skewed positive ``value`` plus a category."""
    return load_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_src_idx"), "user_id", "event_type", "value", "ts")


def with_nulls(df: DataFrame, key: str, cols: list[str], every: int = 10) -> DataFrame:
    """Deterministic null injection: NULL where ``key % every == 0`` (driver tables have none)."""
    return df.select([F.when(F.col(key) % every == 0, F.lit(None)).otherwise(F.col(c)).alias(c)
                      if c in cols else F.col(c) for c in df.columns])


def scored_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predictions-shaped table (F3) without a model: a fixed rule scores each order.

    ``prediction`` = 1.0 when the order has priority 1 or 2 or more than 4 lines;
    ``prediction_proba`` is a deterministic confidence in [0.5, 1]. Used by the
    dashboard/metric operators, which only need (actual, predicted) pairs.
    """
    f = order_frame(spark, sf_dir)
    pred = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") | (F.col("n_lines") > 4), 1.0).otherwise(0.0)
    proba = F.round(0.5 + (F.col("_src_idx") % 50).cast("double") / 100.0, 4)
    return f.withColumn("prediction", pred).withColumn("prediction_proba", proba)
