"""Grouped aggregates behind hypothesis checks and dashboards (inventory 33-41).

All are single-level ``groupBy`` aggregates: Spark computes them with a
partial (map-side) aggregate before the shuffle, so a key holding a third of
the rows is reduced to one row per map task before it is exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.quantile import quantile_row
from tessera.session import cut_lineage, persisted


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def group_mean(df: DataFrame, key: str, target: str, top: int | None = 10) -> DataFrame:
    """Mean of ``target`` per ``key`` (null keys dropped), highest first, top ``top``."""
    out = (df.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.avg(F.col(target).cast("double")).alias("mean"))
             .orderBy(F.desc("mean"), F.asc(key)))
    return out.limit(top) if top else out


def group_mean_count(df: DataFrame, key: str, target: str, top: int | None = None) -> DataFrame:
    """Mean and non-null count of ``target`` per ``key``, mean descending."""
    out = (df.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.avg(F.col(target).cast("double")).alias("mean"),
                  F.count(target).alias("count"))
             .orderBy(F.desc("mean"), F.asc(key)))
    return out.limit(top) if top else out


def group_mean_derived(df: DataFrame, name: str, expr, target: str, top: int | None = 10) -> DataFrame:
    """Mean of ``target`` by a computed key ``name = expr`` (SQL string or Column)."""
    e = F.expr(expr) if isinstance(expr, str) else expr
    return group_mean(df.withColumn(name, e), name, target, top)


def quantile_edges(df: DataFrame, col: str, q: int = 4) -> list[float]:
    """Exact quantile edges (0, 1/q, ..., 1) with duplicates dropped (qcut ``duplicates='drop'``)."""
    probs = [i / q for i in range(q + 1)]
    qs = quantile_row(df, [col], probs)
    vals = [qs[(col, p)] for p in probs if qs.get((col, p)) is not None]
    out = []
    for v in vals:
        if not out or v != out[-1]:
            out.append(v)
    return out


def bucket_expr(col: str, edges: list[float], labels: list[str] | None = None) -> Column:
    """Right-closed buckets (a, b] over ``edges``, the lowest edge included (qcut rules)."""
    nb = len(edges) - 1
    if nb < 1:
        return F.lit(None).cast("string")
    if not labels or len(labels) != nb:
        labels = [f"B{i + 1}" for i in range(nb)]
    x = F.col(col)
    e = F.when(x.isNull() | (x < F.lit(edges[0])) | (x > F.lit(edges[-1])), F.lit(None).cast("string"))
    for i in range(nb):
        e = e.when(x <= F.lit(edges[i + 1]), F.lit(labels[i]))
    return e


def quantile_buckets(df: DataFrame, col: str, target: str, q: int = 4,
                     labels: list[str] | None = None, name: str = "bucket") -> DataFrame:
    """qcut ``col`` into ``q`` exact-quantile buckets and average ``target`` per bucket.

    Unlike ``ntile`` (which splits ties) and ``QuantileDiscretizer``
    (approximate), edges are exact and equal values share a bucket.
    """
    # the edge search and the bucket means share one persisted two-column
    # projection, so a join feeding ``df`` runs once; the result has at most q rows
    with persisted(df.select(F.col(col), F.col(target))) as d:
        edges = quantile_edges(d, col, q)
        b = d.withColumn(name, bucket_expr(col, edges, labels)).where(F.col(name).isNotNull())
        rows = (b.groupBy(name).agg(F.avg(F.col(target).cast("double")).alias("mean"),
                                    F.count(target).alias("count"))
                 .orderBy(name).collect())
    return df.sparkSession.createDataFrame(rows, f"`{name}` string, mean double, count long")


def group_multi_agg(df: DataFrame, key: str, aggs: dict[str, list[str]]) -> DataFrame:
    """Several aggregates of several columns per group: columns ``{col}_{fn}``.

    fn in mean, std (sample), min, max, sum, count, median (exact, via ``percentile``
    is avoided: use ``exact_quantiles`` for global medians).
    """
    fns = {"mean": lambda c: F.avg(c), "std": lambda c: F.stddev_samp(c), "min": F.min,
           "max": F.max, "sum": F.sum, "count": F.count}
    exprs = [fns[fn](F.col(c).cast("double") if fn not in ("count",) else F.col(c)).alias(f"{c}_{fn}")
             for c, fl in aggs.items() for fn in fl]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*exprs)


def prediction_kpis(df: DataFrame, pred: str = "prediction", proba: str = "prediction_proba",
                    benefit: str | None = None, positive: float = 1.0) -> DataFrame:
    """One-row KPIs: rows, most predicted class and its share (%), mean confidence,
    share predicted positive (%; 0 on empty input), mean benefit.

    Computed from the per-class partial table (one row per class), so the
    whole input is scanned once and nothing is joined.
    """
    b = F.col(benefit).cast("double") if benefit else F.lit(None).cast("double")
    per = df.groupBy(F.col(pred).alias("cls")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(proba).cast("double")).alias("sp"),
        F.count(proba).alias("np"), F.sum(b).alias("sb"), F.count(b).alias("nb"))
    top = F.min(F.when(F.col("cls").isNotNull(), F.struct((-F.col("n")).alias("nn"), F.col("cls").alias("cls"))))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return per.agg(
        rows.alias("rows"),
        top.getField("cls").alias("top_class"),
        F.coalesce(F.try_divide(-top.getField("nn") * 100.0, rows), F.lit(0.0)).alias("top_share_pct"),
        F.try_divide(F.sum("sp"), F.sum("np")).alias("mean_confidence"),
        F.coalesce(F.try_divide(F.sum(F.when(F.col("cls") == positive, F.col("n"))) * 100.0, rows),
                   F.lit(0.0)).alias("positive_pct"),
        F.try_divide(F.sum("sb"), F.sum("nb")).alias("mean_benefit"))


def predicted_rate_by_category(df: DataFrame, key: str, pred: str = "prediction",
                               positive: float = 1.0) -> DataFrame:
    """Percent of rows predicted positive per category (the dashboard's 'late %')."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
              .agg((F.avg(F.when(F.col(pred) == positive, 1.0).otherwise(0.0)) * 100.0).alias("positive_pct"),
                   F.count(F.lit(1)).alias("rows"))
              .orderBy(F.desc("positive_pct"), F.asc(key)))


def late_by_state_top10(df: DataFrame, key: str, pred: str = "prediction", positive: float = 1.0,
                        top: int = 10) -> DataFrame:
    """Rows predicted positive per category, top ``top`` (value_counts on the filtered frame)."""
    return (df.where((F.col(pred) == positive) & F.col(key).isNotNull())
              .groupBy(key).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc(key)).limit(top))


def dashboard_summary(df: DataFrame, key: str, pred: str = "prediction", proba: str = "prediction_proba",
                      importance: DataFrame | None = None, verdicts: DataFrame | None = None,
                      top_features: int = 8, positive: float = 1.0) -> DataFrame:
    """Rows ``(section, name, value)`` for the dashboard: KPIs, class distribution, rate per
    category, top feature importances ``(feature, importance)`` and verdict counts.

    One grouped aggregate by (prediction, category) feeds the first three sections;
    any number of classes or categories is kept.
    """
    p = F.col("cls")
    # read by three sections: without the cut each would run what leads to it
    cells = cut_lineage(df.groupBy(F.col(pred).alias("cls"), F.col(key).cast("string").alias("cat"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(proba).cast("double")).alias("sp"), F.count(proba).alias("np")))
    pos = F.sum(F.when(p == positive, F.col("n")).otherwise(0))
    k = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("rows"),
                  F.coalesce(F.try_divide(pos * 100.0, F.sum("n")), F.lit(0.0)).alias("positive_pct"),
                  F.try_divide(F.sum("sp"), F.sum("np")).alias("mean_confidence"))
    parts = [k.select(F.lit("kpi").alias("section"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("rows", "positive_pct", "mean_confidence")]))),
        cells.groupBy(p.cast("string").alias("name")).agg(F.sum("n").cast("double").alias("value"))
        .select(F.lit("distribution").alias("section"), "name", "value"),
        cells.where("cat is not null").groupBy(F.col("cat").alias("name"))
        .agg(F.try_divide(pos * 100.0, F.sum("n")).alias("value")).select(F.lit("by_category").alias("section"), "name", "value")]
    if importance is not None:
        parts.append(importance.orderBy(F.desc("importance"), "feature").limit(top_features)
                     .select(F.lit("importance").alias("section"), F.col("feature").alias("name"), F.col("importance").alias("value")))
    if verdicts is not None:
        parts.append(verdicts.groupBy(F.col("verdict").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("value"))
                     .select(F.lit("verdict").alias("section"), "name", "value"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
