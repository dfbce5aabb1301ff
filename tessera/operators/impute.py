"""Imputation (inventory 47, 48, 50; 49 is in ``knn``).

Median, mean and mode fills are one bounded statistics job plus a ``coalesce``
projection. Neighbour imputation is exact (``knn``) or, with work linear in the rows, by a fixed number of
learned centres. The caller names the method; no method
changes with the size of the table. NaN is a missing value throughout.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.quantile import mode_table, quantile_row
from tessera.functions.safe import nan_to_null, numeric_columns, string_columns
from tessera.operators.knn import impute_knn
from tessera.session import persisted

#: Complete rows that centres are learned from at most (about).
FIT_ROWS = 1_000_000


def _q(c: str):
    return F.col(f"`{c}`")


def impute_median(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Fill numeric NULLs with the exact column median; all-null columns are left alone.

    Imputed columns become double (as the reference's float64 output).
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    df = nan_to_null(df, cols)
    med = quantile_row(df, cols, [0.5])
    fill = {c: med.get((c, 0.5)) for c in cols}
    return df.select([F.coalesce(_q(c).cast("double"), F.lit(fill[c])).alias(c)
                      if c in fill and fill[c] is not None else _q(c) for c in df.columns])


def impute_mode(df: DataFrame, cols: list[str] | None = None, missing: str = "MISSING") -> DataFrame:
    """Fill string NULLs with the column mode (smallest on ties), ``missing`` when there is none."""
    cols = list(cols) if cols is not None else string_columns(df)
    modes = {r["name"]: r["value"] for r in mode_table(df, cols).collect()}
    return df.select([F.coalesce(_q(c), F.lit(modes.get(c) if modes.get(c) is not None else missing)).alias(c)
                      if c in cols else _q(c) for c in df.columns])


def impute_mean(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Fill numeric NULLs with the column mean; all-null columns are left alone."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    if not cols:
        return df
    df = nan_to_null(df, cols)
    mean = df.agg(*[F.avg(_q(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    fill = {c: mean[f"m{i}"] for i, c in enumerate(cols)}
    return df.select([F.coalesce(_q(c).cast("double"), F.lit(fill[c])).alias(c)
                      if fill.get(c) is not None else _q(c) for c in df.columns])


def fit_centres(df: DataFrame, cols: list[str], centres: int = 64, seed: int = 42, max_rows: int = FIT_ROWS) -> dict:
    """Centres of the complete rows (k-means on standardised columns) with the means and deviations used.

    k-means is fitted on at most about ``max_rows`` complete rows (a documented bound of the fit, chosen by a
    seeded hash); every row is imputed with it afterwards.
    """
    base = df.select([_q(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    stats = base.agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(cols))],
                     *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(len(cols))]).first()
    mean = [stats[f"m{i}"] for i in range(len(cols))]
    dev = [stats[f"s{i}"] or 1.0 for i in range(len(cols))]
    full = base.dropna()
    n = full.count()
    if n == 0:
        return {"mean": mean, "dev": dev, "centres": []}
    if n > max_rows:
        full = full.where(F.pmod(F.xxhash64(*full.columns, F.lit(seed)), F.lit(1 << 20)) < int(max_rows / n * (1 << 20)) + 1)
    scaled = full.select(array_to_vector(F.array(*[(F.col(f"x{i}") - mean[i]) / dev[i] for i in range(len(cols))])).alias("features"))
    model = KMeans(k=centres, seed=seed, maxIter=20).fit(scaled)
    return {"mean": mean, "dev": dev, "centres": [[float(v) for v in c] for c in model.clusterCenters()]}


def impute_centres(df: DataFrame, cols: list[str] | None = None, key: str | None = None, centres: int = 64,
                   seed: int = 42, max_rows: int = FIT_ROWS) -> DataFrame:
    """Neighbour imputation with a fixed number of learned centres, at any size.

    A row with a missing value takes it from the nearest centre: Euclidean on standardised columns over the
    coordinates the row has. A row with none takes the column mean. Observed values never change; the centres are a
    bounded literal, so rows are filled where they are. ``max_rows`` bounds the rows that centres are learned from.
    """
    cols = list(cols) if cols is not None else [c for c in numeric_columns(df) if c != key]
    df = nan_to_null(df, cols)
    if not cols:
        return df
    # four passes over these columns
    with persisted(df.select(*[_q(c) for c in cols])) as seen:
        valid = seen.agg(*[F.count(_q(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
        cols = [c for i, c in enumerate(cols) if valid[f"n{i}"] > 0]
        if not cols:
            return df
        fit = fit_centres(seen, cols, centres, seed, max_rows)
    z = [(_q(c).cast("double") - fit["mean"][i]) / fit["dev"][i] for i, c in enumerate(cols)]
    missing = F.greatest(*[x.isNull().cast("int") for x in z], F.lit(0)) == 1
    if fit["centres"]:
        # one expression over an array of the centres: an expression per centre outgrows what one generated method holds
        def away(v):
            return F.struct(sum(F.coalesce((x - v[i]) * (x - v[i]), F.lit(0.0)) for i, x in enumerate(z)).alias("d"), v.alias("v"))
        any_seen = F.least(*[x.isNull().cast("int") for x in z], F.lit(1)) == 0
        held = F.array(*[F.array(*map(F.lit, centre)) for centre in fit["centres"]])
        nearest = F.when(missing & any_seen, F.array_min(F.transform(held, away))["v"])
    else:
        nearest = F.lit(None).cast("array<double>")
    out = df.withColumn("_centre", nearest)
    return out.select([F.coalesce(_q(c).cast("double"), F.col("_centre")[cols.index(c)] * fit["dev"][cols.index(c)]
                                  + fit["mean"][cols.index(c)], F.lit(fit["mean"][cols.index(c)])).alias(c)
                       if c in cols else _q(c) for c in df.columns])


METHODS = {"median": impute_median, "mean": impute_mean, "centres": impute_centres}


def impute_auto(df: DataFrame, key: str = "_src_idx", method: str = "median") -> DataFrame:
    """Numeric columns by the named ``method``, the same at every size; strings by mode. ``key`` is left alone."""
    num = [c for c in numeric_columns(df) if c != key]
    return impute_mode(impute_knn(df, num, key) if method == "knn" else METHODS[method](df, num))
