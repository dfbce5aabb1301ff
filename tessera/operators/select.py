"""Projections, filters and column selection (inventory 10-21).

Schema-level decisions run on the driver over ``df.schema`` (metadata);
the data work stays a lazy projection/filter that Catalyst pushes into the
scan. Filters compare the column with typed literals so parquet predicate
pushdown applies (casting the column to string would block it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.safe import NUMERIC_TYPES, numeric_columns, string_columns
from tessera.operators.profile import distinct_counts

ENGINEERED_PREFIXES = ("feat_", "log_", "sq_")


def _q(c: str):
    return F.col(f"`{c}`")


def select_by_type(df: DataFrame, kind: str = "numeric", exclude=()) -> DataFrame:
    """Numeric or string columns, minus ``exclude`` (e.g. the target)."""
    cols = numeric_columns(df, exclude) if kind == "numeric" else string_columns(df, exclude)
    return df.select([_q(c) for c in cols])


def low_cardinality_columns(df: DataFrame, max_unique: int = 20, first: int | None = 4,
                            exclude=(), approx: bool = False) -> DataFrame:
    """String columns with at most ``max_unique`` distinct values, first ``first`` in schema order."""
    cols = string_columns(df, exclude)
    pos = {c: i for i, c in enumerate(df.columns)}
    spark = df.sparkSession
    posdf = spark.createDataFrame([(c, pos[c]) for c in cols], "column string, position int")
    out = (distinct_counts(df, cols, approx=approx).where(F.col("nunique") <= max_unique)
           .join(F.broadcast(posdf), "column").orderBy("position"))
    return out.limit(first) if first else out


def base_columns(df: DataFrame, first: int = 8, exclude=()) -> list[str]:
    """Numeric columns not created by feature engineering, first ``first``."""
    return [c for c in numeric_columns(df, exclude) if not c.startswith(ENGINEERED_PREFIXES)][:first]


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop the listed columns, ignoring names that are not present."""
    present = set(df.columns)
    return df.drop(*[c for c in cols if c in present])


def drop_null_rows(df: DataFrame, subset=None, how: str = "any") -> DataFrame:
    return df.dropna(how=how, subset=list(subset) if subset else None)


def _typed_literals(df: DataFrame, col: str, values):
    dt = df.schema[col].dataType
    if isinstance(dt, T.StringType):
        return [str(v) for v in values]
    if not isinstance(dt, NUMERIC_TYPES):
        return [str(v) for v in values]
    out = []
    for v in values:
        try:
            f = float(v)
        except (TypeError, ValueError):  # a text that is no number equals none
            continue
        if not isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            out.append(f)
        elif f.is_integer():
            out.append(int(v) if isinstance(v, int) else int(f))
    return out


def filter_in(df: DataFrame, col: str, values) -> DataFrame:
    """Multi-select filter on the string form of a value; empty selection = no filter.

    The selected strings are converted to the column's type so the filter
    reaches the parquet scan as ``In(col, ...)``; one that the type does not hold selects nothing.
    """
    if not values:
        return df
    return df.where(_q(col).isin(_typed_literals(df, col, values)))


def data_bounds(df: DataFrame, cols: list[str]) -> dict[str, tuple]:
    """(min, max) per column in one aggregate (the slider defaults)."""
    r = df.agg(*[F.min(_q(c)).alias(f"lo{i}") for i, c in enumerate(cols)],
               *[F.max(_q(c)).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    return {c: (r[f"lo{i}"], r[f"hi{i}"]) for i, c in enumerate(cols)}


def filter_range(df: DataFrame, ranges: dict) -> DataFrame:
    """Inclusive range per column; a column whose data min equals max is not filtered.

    ``ranges``: col -> (lo, hi). Rows with NULL fall out once a range applies.
    One aggregate finds the data bounds; the ranges then reach the scan as plain comparisons.
    """
    out = df
    wanted = {c: r for c, r in ranges.items() if r[0] is not None and r[1] is not None}
    bounds = data_bounds(df, list(wanted)) if wanted else {}
    for c, (lo, hi) in wanted.items():
        if bounds[c][0] == bounds[c][1]:
            continue
        out = out.where(_q(c).between(F.lit(lo), F.lit(hi)))
    return out


def filter_prediction(df: DataFrame, which: str = "all", pred: str = "prediction") -> DataFrame:
    """all / late (prediction 1) / on_time (prediction 0)."""
    if which in ("late", "1", "positive"):
        return df.where(F.col(pred) == 1.0)
    if which in ("on_time", "0", "negative"):
        return df.where(F.col(pred) == 0.0)
    return df


DEFAULT_PRIORITY = ["prediction", "prediction_proba", "late", "o_orderpriority", "o_orderstatus"]
DEFAULT_PERSONAL = ("email", "password", "fname", "lname", "street", "c_name", "phone")


def project_priority(df: DataFrame, priority=None, personal=DEFAULT_PERSONAL, cap: int = 20) -> DataFrame:
    """Priority columns first (when present), then the rest minus personal columns, at most ``cap``."""
    priority = list(priority) if priority is not None else DEFAULT_PRIORITY
    first = [c for c in priority if c in df.columns]
    rest = [c for c in df.columns if c not in first and not any(p in c for p in personal)]
    return df.select([_q(c) for c in (first + rest)[:cap]])


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None, default=None) -> DataFrame:
    """Replace values through a literal map (e.g. 1.0 -> 'Late', 0.0 -> 'On time')."""
    e = None
    for k, v in mapping.items():
        e = (F.when(_q(col) == F.lit(k), F.lit(v)) if e is None else e.when(_q(col) == F.lit(k), F.lit(v)))
    e = e.otherwise(F.lit(default)) if e is not None else F.lit(default)
    return df.withColumn(out or col, e)


def align_schema(df: DataFrame, columns: list[str], fill=0, keep=()) -> DataFrame:
    """Reindex to the training columns: missing ones filled with ``fill``, extras dropped."""
    present = set(df.columns)
    return df.select([_q(c) for c in keep if c in present] +
                     [_q(c) if c in present else F.lit(fill).alias(c) for c in columns if c not in keep])


def sample_head(df: DataFrame, n: int = 10, order_by: str = "_src_idx") -> DataFrame:
    """First ``n`` rows by the row key (a distributed top-k, not a full sort)."""
    return df.orderBy(_q(order_by)).limit(n)


def column_samples(df: DataFrame, n: int = 3, order_by: str = "_src_idx") -> DataFrame:
    """``(column, rank, value)``: the first ``n`` non-null values of every column by the row key.

    One pass: each task keeps ``n`` rows per column before anything is shuffled.
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), _q(order_by).alias("_k"), _q(c).cast("string").alias("value"))
        for c in df.columns if c != order_by]))).where("value is not null")
    rank = F.row_number().over(Window.partitionBy("column").orderBy("_k"))
    return long.withColumn("rank", rank).where(F.col("rank") <= n).select("column", "rank", "value")
