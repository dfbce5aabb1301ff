"""Evaluation on any (actual, predicted) table (inventory 71-78, 81).

All metrics are aggregates over the scored rows; per-class metrics come
from the grouped confusion counts (one row per (actual, predicted) cell).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def label_col(df: DataFrame, c: str):
    """Class label as a string; numeric labels go through double so 1 and 1.0 agree ('1.0')."""
    from tessera.functions.safe import NUMERIC_TYPES
    if isinstance(df.schema[c].dataType, NUMERIC_TYPES):
        return F.col(c).cast("double").cast("string")
    return F.col(c).cast("string")


def accuracy(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """(rows, accuracy): share of rows with actual == predicted (compared as strings)."""
    eq = label_col(df, actual) == label_col(df, pred)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.avg(F.when(eq, 1.0).otherwise(0.0)).alias("accuracy"))


def rmse_r2(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """(rows, rmse, r2) with R^2 = 1 - SSE/SST; NULL R^2 for a constant actual."""
    a, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    ok = df.where(a.isNotNull() & p.isNotNull())
    return ok.agg(F.count(F.lit(1)).alias("rows"),
                  F.sqrt(F.avg((a - p) ** 2)).alias("rmse"),
                  (F.lit(1.0) - F.try_divide(F.sum((a - p) ** 2), F.var_pop(a) * F.count(F.lit(1)))).alias("r2"))


def _cells(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """Observed (a, p, n) cells in one grouped pass; a label seen only next to a null still counts."""
    return (df.select(label_col(df, actual).alias("a"), label_col(df, pred).alias("p"))
              .groupBy("a", "p").agg(F.count(F.lit(1)).alias("n")))


def confusion_matrix(df: DataFrame, actual: str, pred: str, labels: list[str] | None = None) -> DataFrame:
    """(actual, predicted, count) for every label pair, zero cells kept.

    One grouped aggregate gives the observed cells; every label is written out with the
    sorted list of labels (one row from an aggregate of the cells) and the cells join that grid.
    """
    cells = _cells(df, actual, pred)
    if labels is None:
        seen = cells.select(F.explode(F.array("a", "p")).alias("v")).where("v is not null")
        row = seen.agg(F.sort_array(F.collect_set("v")).alias("ls"))
    else:
        row = df.sparkSession.createDataFrame([(list(labels),)], "ls array<string>")
    grid = row.select(F.explode("ls").alias("actual"), "ls").select("actual", F.explode("ls").alias("predicted"))
    both = cells.where("a is not null and p is not null")
    return (grid.join(both, (F.col("actual") == F.col("a")) & (F.col("predicted") == F.col("p")), "left")
            .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("count")))


def binary_cells(df: DataFrame, actual: str, pred: str, positive="1.0") -> DataFrame:
    """tn, fp, fn, tp for a binary problem (compared as strings)."""
    a = label_col(df, actual) == F.lit(str(positive))
    p = label_col(df, pred) == F.lit(str(positive))
    return df.agg(F.count_if(~a & ~p).alias("tn"), F.count_if(~a & p).alias("fp"),
                  F.count_if(a & ~p).alias("fn"), F.count_if(a & p).alias("tp"))


def classification_report(df: DataFrame, actual: str, pred: str, labels: list[str] | None = None) -> DataFrame:
    """precision, recall, f1, support per class, then accuracy, macro avg, weighted avg rows.

    Zero divisions give 0 (scikit-learn's zero_division default output).
    The accuracy row carries the accuracy in all three metric columns.
    Computed from the grouped confusion cells, for any number of classes.
    """
    cells = _cells(df, actual, pred)
    if labels is None:
        base = cells.select(F.explode(F.array("a", "p")).alias("label")).where("label is not null").distinct()
    else:
        base = df.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    zero = F.lit(0).cast("long")
    both = cells.where("a is not null and p is not null")
    if labels is not None:
        both = both.where(F.col("a").isin(list(labels)) & F.col("p").isin(list(labels)))
    sums = (both.select(F.inline(F.array(
        F.struct(F.col("a").alias("label"), F.col("n").alias("s"), zero.alias("q"),
                 F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(zero).alias("t")),
        F.struct(F.col("p").alias("label"), zero.alias("s"), F.col("n").alias("q"), zero.alias("t")))))
        .groupBy("label").agg(F.sum("s").alias("support"), F.sum("q").alias("pred_n"), F.sum("t").alias("tp")))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    pr, rc = F.col("precision"), F.col("recall")
    per = (base.join(sums, "label", "left").select(
        "label", *[F.coalesce(c, zero).alias(c) for c in ("support", "pred_n", "tp")])
        .withColumn("precision", ratio(F.col("tp"), F.col("pred_n"))).withColumn("recall", ratio(F.col("tp"), F.col("support")))
        .withColumn("f1", ratio(2 * pr * rc, pr + rc)))
    metric = ("precision", "recall", "f1")
    w = per.agg(F.coalesce(F.sum("support"), zero).alias("n"), F.coalesce(F.sum("tp"), zero).alias("tp"),
                *[F.coalesce(F.avg(m), F.lit(0.0)).alias(f"macro_{m}") for m in metric],
                *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in metric])
    acc = ratio(F.col("tp"), F.col("n"))
    totals = w.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("label"), *[acc.alias(m) for m in metric], F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), *[F.col(f"macro_{m}").alias(m) for m in metric], F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), *[F.col(f"weighted_{m}").alias(m) for m in metric],
                 F.col("n").alias("support")))))
    return per.select("label", *metric, "support").unionByName(totals)


def class_distribution_compare(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """(label, actual_count, predicted_count) from one unpivoted scan."""
    long = df.select(F.inline(F.array(
        F.struct(F.lit(0).alias("w"), label_col(df, actual).alias("label")),
        F.struct(F.lit(1).alias("w"), label_col(df, pred).alias("label")))))
    return (long.where(F.col("label").isNotNull()).groupBy("label")
            .agg(F.count_if(F.col("w") == 0).alias("actual_count"), F.count_if(F.col("w") == 1).alias("predicted_count")))


def error_rate_by_class(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """Per actual class: rows, errors, error rate, class accuracy (recall); plus an 'ALL' row."""
    a, p = label_col(df, actual), label_col(df, pred)
    d = df.where(a.isNotNull()).select(a.alias("label"), (a != p).alias("wrong"))
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("wrong")).alias("errors")]
    per = d.groupBy("label").agg(*aggs)
    allr = d.agg(*aggs).select(F.lit("ALL").alias("label"), "rows", "errors")
    out = per.unionByName(allr)
    return (out.withColumn("error_rate", F.try_divide(F.col("errors") * 1.0, F.col("rows")))
               .withColumn("accuracy", F.lit(1.0) - F.col("error_rate")))


def residuals(df: DataFrame, actual: str, pred: str, key: str) -> DataFrame:
    """(key, actual, predicted, residual = actual - predicted)."""
    a, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    return df.select(F.col(key), a.alias("actual"), p.alias("predicted"), (a - p).alias("residual"))


def identity_line(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """The actual-vs-predicted plot range: lo = min over both, hi = max over both."""
    a, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    return df.agg(F.least(F.min(a), F.min(p)).alias("lo"), F.greatest(F.max(a), F.max(p)).alias("hi"))


def train_test_gap(df: DataFrame, actual: str, pred: str, split: str = "split",
                   overfit_gap: float = 0.05) -> DataFrame:
    """Accuracy on train and test rows, their gap and a fit label."""
    eq = F.when(label_col(df, actual) == label_col(df, pred), 1.0).otherwise(0.0)
    s = df.agg(F.avg(F.when(F.col(split) == "train", eq)).alias("train_score"),
               F.avg(F.when(F.col(split) == "test", eq)).alias("test_score"))
    gap = F.col("train_score") - F.col("test_score")
    return s.select("train_score", "test_score", gap.alias("gap"),
                    F.when(gap > overfit_gap, "overfitting").when(gap < -overfit_gap, "underfitting")
                    .otherwise("good fit").alias("fit"))


def r2_gap(df: DataFrame, actual: str, pred: str, split: str = "split", overfit_gap: float = 0.05) -> DataFrame:
    """R2 on train and test rows, their gap and a fit label (the regression form of ``train_test_gap``)."""
    a, p = F.col(actual).cast("double"), F.col(pred).cast("double")

    def r2(part: str):
        here = F.col(split) == part
        return F.lit(1.0) - F.try_divide(F.sum(F.when(here, (a - p) ** 2)),
                                         F.var_pop(F.when(here & p.isNotNull(), a)) * F.count(F.when(here & p.isNotNull(), a)))
    s = df.agg(r2("train").alias("train_r2"), r2("test").alias("test_r2"))
    gap = F.col("train_r2") - F.col("test_r2")
    return s.select("train_r2", "test_r2", gap.alias("gap"),
                    F.when(gap > overfit_gap, "overfitting").when(gap < -overfit_gap, "underfitting").otherwise("good fit").alias("fit"))


def high_confidence_tiers(df: DataFrame, p1: str, high: float = 0.8, low: float = 0.5) -> DataFrame:
    """Rows per confidence tier of the class-1 probability: high > .8, medium .5-.8, low < .5."""
    p = F.col(p1).cast("double")
    tier = F.when(p > high, "high").when(p >= low, "medium").when(p.isNotNull(), "low")
    return df.select(tier.alias("tier")).where(F.col("tier").isNotNull()).groupBy("tier").agg(
        F.count(F.lit(1)).alias("rows"))
