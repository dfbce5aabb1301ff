"""Association and redundancy (inventory 42-46).

The correlation matrix is one wide aggregate holding three moments per
column pair (pair-complete covariance and standard deviations), computed
once and reused for the target ranking and the redundancy rule.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.safe import nan_to_null, numeric_columns, safe_corr
from tessera.operators.gramian import correlated_pairs
from tessera.session import persisted


def _q(c: str):
    return F.col(f"`{c}`")


def _pairwise(df: DataFrame, cols: list[str], means: list[float], devs: list[float], pairs: list[tuple[int, int]]) -> dict:
    """Pairwise-complete Pearson correlations of any number of columns in one pass.

    Each row becomes its standardised values (0 where missing), their squares and a 0/1 mask;
    the Gramian of these 3p numbers, accumulated per partition and merged in a tree, holds every pair's
    count, sums and cross product.
    """
    p = len(cols)
    z = [(_q(c).cast("double") - F.lit(means[i])) / F.lit(devs[i]) for i, c in enumerate(cols)]
    parts = [F.coalesce(x, F.lit(0.0)) for x in z] + [F.coalesce(x * x, F.lit(0.0)) for x in z] + [
        F.col(f"`{c}`").isNotNull().cast("double") for c in cols]
    rows = df.select(array_to_vector(F.array(*parts)).alias("v"))
    g = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v")).computeGramianMatrix().toArray()
    out: dict = {}
    for i, j in pairs:
        n = g[2 * p + i][2 * p + j]
        if n < 2:
            out[(i, j)] = None
            continue
        sx, sy = g[i][2 * p + j], g[2 * p + i][j]
        sxx, syy = g[p + i][2 * p + j], g[2 * p + i][p + j]
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        flat = vx <= 1e-12 * max(sxx, 1.0) or vy <= 1e-12 * max(syy, 1.0)
        out[(i, j)] = None if flat else float((g[i][j] - sx * sy / n) / math.sqrt(vx * vy))
    return out


def correlation_matrix(df: DataFrame, cols: list[str] | None = None, full: bool = False) -> DataFrame:
    """Pearson correlation of all numeric pairs over pairwise-complete rows.

    Long form ``(col_a, col_b, pos_a, pos_b, corr)`` for ``pos_a < pos_b``;
    ``full=True`` adds the mirrored pairs and the diagonal (1, or NULL for a
    constant/empty column). NULL stands for pandas' NaN.

    One pass gets means and null counts. Without nulls the centred columns go
    through ``pyspark.ml.stat.Correlation`` (a tree-aggregated Gramian); with
    nulls, one Gramian of values, squares and masks serves all pairs. NaN is missing; a pair with an
    infinite value in one of its columns is NULL. The p x p result is bounded by the schema width; for very wide tables
    ``gramian.correlated_pairs`` gives the pairs above a threshold and keeps the rest on the executors.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    spark = df.sparkSession
    schema = "col_a string, col_b string, pos_a int, pos_b int, corr double"
    p = len(cols)
    if p < 2 and not (full and p == 1):
        return spark.createDataFrame([], schema)
    with persisted(nan_to_null(df.select([_q(c) for c in cols]))) as d:
        rows = _corr_rows(d, cols, full)
    return spark.createDataFrame(rows, schema)


def _corr_rows(df: DataFrame, cols: list[str], full: bool) -> list:
    p, top = len(cols), float("inf")
    endless = [F.abs(_q(c).cast("double")) == F.lit(top) for c in cols]
    df, whole = df.select([F.when(~e, _q(c)).alias(c) for c, e in zip(cols, endless)]), df
    inf = whole.agg(*[F.count_if(e).alias(f"i{i}") for i, e in enumerate(endless)]).first()
    inf = {i for i in range(p) if inf[f"i{i}"]}
    st = df.agg(F.count(F.lit(1)).alias("n"),
                *[F.count(_q(c)).alias(f"c{i}") for i, c in enumerate(cols)],
                *[F.avg(_q(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                *[F.stddev_samp(_q(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    means = [st[f"m{i}"] if st[f"m{i}"] is not None else 0.0 for i in range(p)]
    pairs = [(i, j) for i in range(p) for j in range(i + 1, p)]
    no_nulls = all(st[f"c{i}"] == st["n"] for i in range(p))
    corr: dict = {}
    if no_nulls and st["n"] >= 2 and p >= 2:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.stat import Correlation
        centred = df.select([(_q(c).cast("double") - F.lit(means[i])).alias(f"z{i}") for i, c in enumerate(cols)])
        vec = VectorAssembler(inputCols=[f"z{i}" for i in range(p)], outputCol="v").transform(centred).select("v")
        mat = Correlation.corr(vec, "v", "pearson").first()[0].toArray()
        for i, j in pairs:
            v = float(mat[i][j])
            const = not st[f"s{i}"] or not st[f"s{j}"]
            corr[(i, j)] = None if (math.isnan(v) or const) else v
    elif pairs:
        corr = _pairwise(df, cols, means, [st[f"s{i}"] or 1.0 for i in range(p)], pairs)
    corr = {(i, j): v for (i, j), v in corr.items() if i not in inf and j not in inf}
    rows = [(cols[i], cols[j], i, j, corr.get((i, j))) for i, j in pairs]
    if full:
        rows += [(cols[j], cols[i], j, i, corr.get((i, j))) for i, j in pairs]
        rows += [(c, c, i, i, 1.0 if st[f"s{i}"] and i not in inf else None) for i, c in enumerate(cols)]
    return rows


def correlation_with_target(df: DataFrame, target: str, cols: list[str] | None = None,
                            first: int | None = 10) -> DataFrame:
    """Correlation of each numeric column (first ``first``) with the target, ranked by |corr|.

    A non-numeric target gives 0.0 for every column (the reference's rule). NULL where an infinite value takes part.
    """
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=(target,))
    if first:
        cols = cols[:first]
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column string, position int, corr double, abs_corr double")
    numeric_target = target in numeric_columns(df)
    aggs = [(F.nanvl(safe_corr(_q(c), _q(target)), F.lit(None)) if numeric_target else F.lit(0.0)).alias(f"r{i}")
            for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), F.col(f"r{i}").alias("corr"))
               for i, c in enumerate(cols)]
    return (wide.select(F.inline(F.array(*structs))).withColumn("abs_corr", F.abs("corr"))
            .orderBy(F.desc_nulls_last("abs_corr"), "position"))


def id_like_columns(columns: list[str], target: str | None = None, strict: bool = False) -> list[str]:
    """Names containing 'id' (substring, as the reference: ``width`` matches too).

    ``strict=True`` only matches 'id' as a whole underscore-separated token.
    """
    pat = re.compile(r"(^|_)id($|_)") if strict else None
    out = []
    for c in columns:
        if c == target:
            continue
        hit = bool(pat.search(c.lower())) if strict else ("id" in c.lower())
        if hit:
            out.append(c)
    return out


def redundant_columns(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.95,
                      target: str | None = None, corr: DataFrame | None = None) -> DataFrame:
    """Columns to drop for redundancy: c is dropped if |corr(c, any earlier column)| > threshold.

    Earlier columns count even when they are dropped themselves; the target
    can cause a drop but is never dropped. NULL correlation never triggers.
    Returns ``(column, position, max_abs_corr, partner)``.
    """
    cm = corr if corr is not None else correlated_pairs(df, list(cols) if cols is not None else numeric_columns(df), threshold)
    hits = cm.where(F.abs("corr") > threshold)
    if target is not None:
        hits = hits.where(F.col("col_b") != target)
    return (hits.groupBy(F.col("col_b").alias("column"), F.col("pos_b").alias("position"))
            .agg(F.max(F.struct(F.abs("corr").alias("a"), (-F.col("pos_a")).alias("p"), F.col("col_a").alias("c")))
                 .alias("m"))
            .select("column", "position", F.col("m.a").alias("max_abs_corr"), F.col("m.c").alias("partner"))
            .orderBy("position"))


def prune_columns(df: DataFrame, target: str, threshold: float = 0.95, strict_ids: bool = False,
                  keep: tuple[str, ...] = ("_src_idx",)) -> tuple[DataFrame, list[str]]:
    """Drop redundant numeric columns and id-like columns (the 'ml_ready' layer); the row key (``keep``) stays."""
    red = [r["column"] for r in redundant_columns(df, threshold=threshold, target=target).collect()]
    ids = id_like_columns(df.columns, target, strict=strict_ids)
    drop = sorted((set(red) | set(ids)) - {target} - set(keep))
    return df.drop(*drop), drop


def cramers_v_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cramér's V (plain, no bias correction) for every pair of categorical columns.

    Callers choose the columns (``low_cardinality_columns``). Per row one (pair, a, b) record is
    emitted per column pair; observed cells are counted with a grouped
    aggregate, and chi2 = sum(O^2 / E) - n over observed cells only, so empty
    cells are never materialised. Rows with a null in either column of a pair
    are left out of that pair.
    """
    spark = df.sparkSession
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not pairs:
        return spark.createDataFrame([], "col_a string, col_b string, n long, chi2 double, cramers_v double")
    recs = df.select(F.inline(F.array(*[
        F.struct(F.lit(p).alias("pair"), _q(cols[i]).cast("string").alias("a"), _q(cols[j]).cast("string").alias("b"))
        for p, (i, j) in enumerate(pairs)]))).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    cells = recs.groupBy("pair", "a", "b").agg(F.count(F.lit(1)).alias("o"))
    ra = cells.groupBy("pair", "a").agg(F.sum("o").alias("ra"))
    cb = cells.groupBy("pair", "b").agg(F.sum("o").alias("cb"))
    tot = cells.groupBy("pair").agg(F.sum("o").alias("n"), F.countDistinct("a").alias("r"),
                                    F.countDistinct("b").alias("c"))
    chi = (cells.join(ra, ["pair", "a"]).join(cb, ["pair", "b"]).join(tot, "pair")
           .groupBy("pair", "n", "r", "c")
           .agg((F.sum(F.col("o") * F.col("o") * F.col("n") / (F.col("ra") * F.col("cb"))) - F.first("n")).alias("chi2")))
    names_a = F.array(*[F.lit(cols[i]) for i, _ in pairs])
    names_b = F.array(*[F.lit(cols[j]) for _, j in pairs])
    k = F.least(F.col("r"), F.col("c")) - 1
    return chi.select(F.element_at(names_a, F.col("pair") + 1).alias("col_a"),
                      F.element_at(names_b, F.col("pair") + 1).alias("col_b"), "n", "chi2",
                      F.when(k > 0, F.sqrt(F.greatest(F.col("chi2"), F.lit(0.0)) / (F.col("n") * k)))
                      .alias("cramers_v"))
