"""ANSI-safe statistical expressions with pandas-compatible semantics.

ANSI mode stays on: every division that can hit zero goes through
``try_divide`` (NULL instead of an error).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sample_skew(c) -> Column:
    """Bias-corrected sample skewness (the pandas ``skew`` definition).

    Spark's ``skewness`` is the population form g1; G1 = g1 * sqrt(n(n-1))/(n-2).
    NULL below three values; 0 for a constant column (pandas returns 0 there).
    """
    x = _c(c).cast("double")
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.var_pop(x) == 0, F.lit(0.0))
            .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def safe_corr(x, y) -> Column:
    """Pearson correlation over pairwise-complete rows; NULL when a side is constant.

    ``F.corr`` raises DIVIDE_BY_ZERO under ANSI for a zero-variance input, so
    the ratio is formed with ``try_divide`` over pair-complete moments.
    """
    xc, yc = _c(x).cast("double"), _c(y).cast("double")
    xp = F.when(yc.isNotNull(), xc)
    yp = F.when(xc.isNotNull(), yc)
    return F.try_divide(F.covar_samp(xc, yc), F.stddev_samp(xp) * F.stddev_samp(yp))


def sql_std_name(c) -> Column:
    """The name standardisation chain as SQL functions (for name columns in data)."""
    return F.regexp_replace(F.replace(F.lower(F.trim(_c(c))), F.lit(" "), F.lit("_")),
                            r"[^a-z0-9_]", "")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    ex = set(exclude or ())
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    ex = set(exclude or ())
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``df`` with NaN as NULL in the float columns (of ``cols``): a missing value, as at CSV ingest."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
              and (cols is None or f.name in cols)}
    if not floats:
        return df
    return df.select([F.nanvl(F.col(f"`{c}`"), F.lit(None)).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns])
