"""Declared hypothesis tests and verdicts (inventory 83-85).

A hypothesis is a declared spec (kind + key + target + expected direction)
instead of generated code. Each spec compiles to one grouped aggregate; all
results are unioned into one long table and judged by a fixed rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.safe import NUMERIC_TYPES, safe_corr
from tessera.functions.special import with_chi2_tail, with_f_tail
from tessera.operators.groups import bucket_expr, quantile_edges
from tessera.session import cut_lineage

RESULT_SCHEMA = "id string, grp string, ord double, mean double, count long"


def run_hypotheses(df: DataFrame, specs: list[dict]) -> DataFrame:
    """All specs in one pass: every row is unpivoted into one (id, group, order,
    target) record per spec and a single grouped aggregate (partial, map-side)
    computes every hypothesis' means and counts. Bucket edges of
    ``quantile_buckets`` specs are computed first (exact, bounded)."""
    if not specs:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return _grouped(df, specs).select("id", "grp", "ord", "mean", "count")


def _grouped(df: DataFrame, specs: list[dict]) -> DataFrame:
    """Per hypothesis and group the mean, and what the tests need: count, sum, sum of squares, whether all are zeros and ones."""
    t = F.col("t")
    return _records(df, specs).groupBy("id", "grp", "ord").agg(
        F.avg(t).alias("mean"), F.count(t).alias("count"), F.sum(t).alias("s"), F.sum(t * t).alias("ss"),
        F.bool_and(t.isin(0.0, 1.0)).alias("binary"))


def results_and_statistics(df: DataFrame, specs: list[dict]) -> tuple[DataFrame, DataFrame]:
    """:func:`run_hypotheses` and :func:`test_statistics` of one pass over ``df``: its groups are written once and read by both."""
    if not specs:
        return run_hypotheses(df, specs), test_statistics(df, specs)
    g = cut_lineage(_grouped(df, specs))
    return g.select("id", "grp", "ord", "mean", "count"), _statistics(g)


def _records(df: DataFrame, specs: list[dict]) -> DataFrame:
    """``(id, grp, ord, t)``: one record per row and spec, without those that have no group."""
    recs = []
    for s in specs:
        kind, key, target = s["kind"], s["key"], s["target"]
        t = F.col(target).cast("double")
        if kind == "quantile_buckets":
            q = int(s.get("q", 4))
            edges = quantile_edges(df, key, q)
            nb = len(edges) - 1
            labels = s.get("labels")
            if not labels or len(labels) != nb:
                labels = [f"B{i + 1}" for i in range(max(nb, 0))]
            grp = bucket_expr(key, edges, labels)
            ordc = F.lit(None).cast("double")
            for i, lab in enumerate(labels):
                ordc = F.when(grp == F.lit(lab), F.lit(float(i + 1))).otherwise(ordc)
        else:
            kc = F.expr(s["expr"]) if kind == "group_mean_derived" else F.col(key)
            grp = kc.cast("string")
            numeric = isinstance(df.select(kc.alias("_k")).schema["_k"].dataType, NUMERIC_TYPES)
            ordc = kc.cast("double") if numeric else F.lit(None).cast("double")
        recs.append(F.struct(F.lit(s["id"]).alias("id"), grp.alias("grp"), ordc.alias("ord"), t.alias("t")))
    return df.select(F.inline(F.array(*recs))).where(F.col("grp").isNotNull())


def test_statistics(df: DataFrame, specs: list[dict]) -> DataFrame:
    """One-way F and chi-square tests of every hypothesis: ``(id, groups, n, f_stat, f_p, chi2, chi2_p, p_value, p_holm)``.

    F compares the groups' means; chi-square, for a target of zeros and ones only, the groups' shares. Both come from each
    group's count, sum and sum of squares. ``p_value`` is that of chi-square where there is one, else of F; ``p_holm`` is
    corrected for all hypotheses (Holm). Without two groups, or without any variance, there is no statistic.
    """
    spark = df.sparkSession
    if not specs:
        return spark.createDataFrame([], "id string, groups long, n long, f_stat double, f_p double, chi2 double, chi2_p double, "
                                         "p_value double, p_holm double")
    return _statistics(_grouped(df, specs))


def _statistics(grouped: DataFrame) -> DataFrame:
    g = grouped.where(F.col("count") > 0).withColumnRenamed("count", "n")
    t = g.groupBy("id").agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"),
                            F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"), F.bool_and("binary").alias("binary"))
    k, n, mean = F.col("groups"), F.col("n"), F.try_divide(F.col("s"), F.col("n"))
    among, within = F.col("between") - F.col("s") * mean, F.col("ss") - F.col("between")
    # rounding may leave a tiny variance within groups that have none
    f = F.when((k > 1) & (n > k) & (within > 1e-12 * F.col("ss")), F.try_divide(F.greatest(among, F.lit(0.0)) / (k - 1), within / (n - k)))
    chi2 = F.when(F.col("binary") & (k > 1), F.try_divide(F.greatest(among, F.lit(0.0)), mean * (1 - mean)))
    t = t.select("id", "groups", "n", f.alias("f_stat"), chi2.alias("chi2"))
    t = with_f_tail(t, F.col("f_stat"), k - 1, n - k, "f_p")
    t = with_chi2_tail(t, F.col("chi2"), k - 1, "chi2_p").withColumn("p_value", F.coalesce("chi2_p", "f_p"))
    # one row per hypothesis
    order = Window.orderBy(F.col("p_value").asc_nulls_last(), "id")
    tests, upto = F.count("p_value").over(Window.partitionBy()), order.rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("_step", F.least(F.col("p_value") * (tests - F.row_number().over(order) + 1), F.lit(1.0)))
    return (t.withColumn("p_holm", F.when(F.col("p_value").isNotNull(), F.max("_step").over(upto)))
            .select("id", "groups", "n", "f_stat", "f_p", "chi2", "chi2_p", "p_value", "p_holm"))


test_statistics.__test__ = False  # not a test of pytest's


def verdict_by_test(results: DataFrame, statistics: DataFrame, specs: DataFrame, alpha: float = 0.05, min_support: int = 30) -> DataFrame:
    """Verdicts by the corrected test: TRUE if ``p_holm < alpha`` and the groups of ``min_support`` rows run in the expected direction.

    INCONCLUSIVE without a statistic or with fewer than two supported groups, else FALSE.
    """
    rule = hypothesis_verdict(results, specs, min_support, 0.0).select("id", "statement", "expected_direction", "supported", "direction_corr")
    exp, way = F.col("expected_direction"), F.col("direction_corr")
    right = F.coalesce(F.when(exp == "positive", way > 0).when(exp == "negative", way < 0).otherwise(F.lit(True)), F.lit(False))
    verdict = (F.when(F.col("p_holm").isNull() | (F.col("supported") < 2), "INCONCLUSIVE")
               .when((F.col("p_holm") < alpha) & right, "TRUE").otherwise("FALSE"))
    return rule.join(statistics.select("id", "p_holm"), "id", "left").select(
        "id", "statement", "expected_direction", "supported", "direction_corr", "p_holm", verdict.alias("verdict"))


def specs_frame(spark, specs: list[dict]) -> DataFrame:
    return spark.createDataFrame(
        [(s["id"], s.get("statement", ""), list(s.get("columns", [s["key"], s["target"]])), s["kind"], s["key"],
          s.get("expected_direction", "none")) for s in specs],
        "id string, statement string, columns array<string>, kind string, key string, expected_direction string")


def hypothesis_verdict(results: DataFrame, specs: DataFrame, min_support: int = 30,
                       min_spread: float = 0.05) -> DataFrame:
    """TRUE / FALSE / INCONCLUSIVE per hypothesis.

    INCONCLUSIVE when fewer than two groups have ``min_support`` rows. With a
    direction: TRUE when the supported groups' means spread at least
    ``min_spread`` and their correlation with the group order has the
    expected sign. Without one (categories): TRUE when the spread is at
    least ``min_spread``.
    """
    # one aggregate: two of them, joined, would run what leads to the results twice
    sup = results.withColumn("_sup", F.col("count") >= min_support).select(
        "id", "_sup", F.when(F.col("_sup"), F.col("ord")).alias("ord"), F.when(F.col("_sup"), F.col("mean")).alias("mean"))
    agg = sup.groupBy("id").agg(F.count(F.lit(1)).alias("groups"), F.count_if("_sup").alias("supported"),
                                (F.max("mean") - F.min("mean")).alias("spread"),
                                safe_corr("ord", "mean").alias("direction_corr"))
    j = specs.join(agg, "id", "left")
    exp = F.col("expected_direction")
    sign_ok = (F.when(exp == "positive", F.col("direction_corr") > 0)
               .when(exp == "negative", F.col("direction_corr") < 0).otherwise(F.lit(True)))
    verdict = (F.when(F.coalesce("supported", F.lit(0)) < 2, "INCONCLUSIVE")
               .when((F.col("spread") >= min_spread) & F.coalesce(sign_ok, F.lit(False)), "TRUE")
               .otherwise("FALSE"))
    return j.select("id", "statement", "expected_direction", F.coalesce("groups", F.lit(0)).cast("long").alias("groups"),
                    F.coalesce("supported", F.lit(0)).cast("long").alias("supported"), "spread", "direction_corr",
                    verdict.alias("verdict"))


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("verdict").agg(F.count(F.lit(1)).alias("count"))


def confirmed_insights(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(F.col("verdict") == "TRUE").select("id", "statement")
