"""Feature engineering, encoding and problem typing (inventory 51-61).

Decisions that depend on statistics (which columns get a log) need one small aggregate
collected to the driver; the feature columns themselves are plain column arithmetic inside one
projection (whole-stage codegen). Levels of text columns are numbered in a table (``levels``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.safe import numeric_columns, sample_skew, string_columns
from tessera.operators.levels import level_counts, level_dictionary, unit_vector, with_codes, with_levels
from tessera.operators.profile import distinct_counts

EPS = 1e-9


def _q(c: str):
    return F.col(f"`{c}`")


def feat_pair(df: DataFrame, c0: str, c1: str) -> DataFrame:
    """feat_ratio = c0/(c1+1e-9), feat_sum, feat_product, feat_diff."""
    a, b = _q(c0).cast("double"), _q(c1).cast("double")
    return df.select("*", F.try_divide(a, b + EPS).alias("feat_ratio"), (a + b).alias("feat_sum"),
                     (a * b).alias("feat_product"), (a - b).alias("feat_diff"))


def log_candidates(df: DataFrame, cols: list[str], skew_limit: float = 1.0) -> list[str]:
    """Columns whose non-null minimum is > 0 and |corrected skew| > ``skew_limit`` (one aggregate)."""
    if not cols:
        return []
    r = df.agg(*[F.min(_q(c)).alias(f"m{i}") for i, c in enumerate(cols)],
               *[sample_skew(_q(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols)
            if r[f"m{i}"] is not None and r[f"m{i}"] > 0 and r[f"s{i}"] is not None and abs(r[f"s{i}"]) > skew_limit]


def log_features(df: DataFrame, cols: list[str], skew_limit: float = 1.0) -> tuple[DataFrame, list[str]]:
    """Add ``log_<c>`` = log1p(c) for the skewed positive columns among ``cols``."""
    chosen = log_candidates(df, cols, skew_limit)
    return df.select("*", *[F.log1p(_q(c)).alias(f"log_{c}") for c in chosen]), [f"log_{c}" for c in chosen]


def standard_features(df: DataFrame, target: str | None = None, exclude=(),
                      logs: bool = True) -> tuple[DataFrame, list[str]]:
    """The always-on features over the numeric columns c0, c1, c2 ... (schema order, target excluded):
    ratio/sum/product/diff of c0,c1; log1p of skewed positive columns among the
    first 8; c0*c2; squares of c0 and c1."""
    num = numeric_columns(df, exclude=tuple(exclude) + ((target,) if target else ()))
    made: list[str] = []
    out = df
    if len(num) >= 2:
        out = feat_pair(out, num[0], num[1])
        made += ["feat_ratio", "feat_sum", "feat_product", "feat_diff"]
    if logs:
        out, made_logs = log_features(out, num[:8])
        made += made_logs
    extra = []
    if len(num) >= 3:
        extra.append((_q(num[0]).cast("double") * _q(num[2]).cast("double")).alias("feat_interact"))
        made.append("feat_interact")
    if len(num) >= 2:
        extra += [(_q(num[0]).cast("double") * _q(num[0]).cast("double")).alias(f"sq_{num[0]}"),
                  (_q(num[1]).cast("double") * _q(num[1]).cast("double")).alias(f"sq_{num[1]}")]
        made += [f"sq_{num[0]}", f"sq_{num[1]}"]
    if extra:
        out = out.select("*", *extra)
    return out, made


def domain_features(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """User-declared features: name -> SQL expression (replaces generated code).

    Expressions are parsed by Spark, so they stay JVM-side and optimisable.
    Division should use ``try_divide`` to stay ANSI-safe.
    """
    return df.select("*", *[F.expr(e).alias(n) for n, e in exprs.items()])


#: Dummy columns that a schema may get; more levels than that want the vector form.
MOST_COLUMNS = 10_000


def one_hot(df: DataFrame, cols: list[str] | None = None, drop_first: bool = True, form: str = "columns",
            drop_source: bool = True) -> tuple[DataFrame, list[str]]:
    """0/1 dummies of every level of the string columns (get_dummies); no level is left out.

    The caller names the ``form``, whatever the number of levels: ``columns`` gives integer columns
    ``<col>_<value>`` (the levels become names of the schema, so they reach the driver; above ``MOST_COLUMNS`` that is
    an error), ``vector`` one sparse vector column ``<col>__levels`` per column (see ``one_hot_vector``), whose levels
    stay in a table. Levels are sorted; with ``drop_first`` the alphabetically first one is dropped; a NULL row is all
    zeros. A new name that is taken gets a numeric suffix.
    """
    if form not in ("columns", "vector"):
        raise ValueError("form is 'columns' or 'vector'")
    cols = list(cols) if cols is not None else string_columns(df)
    if not cols:
        return df, []
    dictionary = level_dictionary(df, cols)
    if form == "vector":
        out, names = df, []
        for c in cols:
            out, name = one_hot_vector(out, c, drop_first, dictionary)
            names.append(name)
        return out.select([_q(c) for c in out.columns if not (drop_source and c in cols)]), names
    wanted = dictionary.where(F.col("code") >= int(drop_first)).select("column", "code", "level")
    found = wanted.limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} levels to become columns; use form='vector'")
    kept = [c for c in df.columns if not (drop_source and c in cols)]
    taken, dummies, names = {c.lower() for c in kept}, [], []
    for c, _, v in sorted((cols.index(r["column"]), r["code"], r["level"]) for r in found):
        name, i = f"{cols[c]}_{v}", 2
        while name.lower() in taken:
            name, i = f"{cols[c]}_{v}_{i}", i + 1
        taken.add(name.lower())
        dummies.append(F.when(_q(cols[c]).cast("string") == F.lit(v), 1).otherwise(0).cast("int").alias(name))
        names.append(name)
    return df.select(*[_q(c) for c in kept], *dummies), names


def one_hot_vector(df: DataFrame, col: str, drop_first: bool = True, dictionary: DataFrame | None = None) -> tuple[DataFrame, str]:
    """Adds ``<col>__levels``: a sparse 0/1 vector over all levels of ``col`` in ascending order, without the first
    one if ``drop_first``. A NULL or an unknown level is all zeros. ``dictionary`` holds the levels of the training rows."""
    out, code = f"{col}__levels", f"{col}__code"
    if dictionary is None:
        dictionary = level_dictionary(df, [col])
    size = max(level_counts(dictionary, [col])[col] - int(drop_first), 0)
    place = F.col(f"`{code}`") - int(drop_first)
    coded = with_codes(df, dictionary, {col: code}).withColumn(out, unit_vector(F.when(place >= 0, place), size))
    return coded.drop(code), out


def label_encode(df: DataFrame, col: str, out: str | None = None, dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Classes to sorted integer codes 0..k-1, and the level dictionary; a NULL or unknown class has no code.

    Pass the ``dictionary`` of the training rows to encode others alike."""
    out = out or f"{col}_idx"
    if dictionary is None:
        dictionary = level_dictionary(df, [col])
    text = df.withColumn(col, _q(col).cast("string"))
    return with_codes(text, dictionary, {col: out}).withColumn(out, _q(out).cast("int")), dictionary


def label_decode(df: DataFrame, col: str, dictionary: DataFrame, out: str, column: str | None = None) -> DataFrame:
    """The class of each code in ``col``; ``column`` names the encoded column if the dictionary has several."""
    part = dictionary if column is None else dictionary.where(F.col("column") == column)
    return with_levels(df, part.withColumn("column", F.lit("_")), {("_", col): out})


def detect_problem_type(df: DataFrame, targets: list[str]) -> DataFrame:
    """classification/regression per candidate target, rules in order:
    string -> class; nunique <= 15 -> class; <= 30 and integer -> class;
    nunique / n < 0.05 -> class; else regression."""
    spark = df.sparkSession
    nun = distinct_counts(df, targets)
    n = df.select(F.count(F.lit(1))).scalar()
    types = spark.createDataFrame(
        [(t, df.schema[t].dataType.simpleString(),
          isinstance(df.schema[t].dataType, T.StringType),
          isinstance(df.schema[t].dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)))
         for t in targets], "column string, dtype string, is_string boolean, is_int boolean")
    r = F.col("ratio")
    return (nun.join(F.broadcast(types), "column")
            .withColumn("n", n)
            .withColumn("ratio", F.try_divide(F.col("nunique") * 1.0, F.col("n")))
            .withColumn("problem_type",
                        F.when(F.col("is_string"), "classification")
                        .when(F.col("nunique") <= 15, "classification")
                        .when((F.col("nunique") <= 30) & F.col("is_int"), "classification")
                        .when(r < 0.05, "classification").otherwise("regression"))
            .select("column", "dtype", "nunique", "n", "problem_type"))


def choose_target(df: DataFrame, target: str | None = None) -> str:
    """The user's target, else the last numeric column (the older rule)."""
    if target:
        return target
    num = numeric_columns(df)
    if not num:
        raise ValueError("no numeric column to use as target")
    return num[-1]


def log_decisions(df: DataFrame, cols: list[str], skew_limit: float = 1.0) -> DataFrame:
    """The log rule as a table: (column, position, min, skew, chosen)."""
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column string, position int, min double, skew double, chosen boolean")
    wide = df.agg(*[F.min(_q(c)).cast("double").alias(f"m{i}") for i, c in enumerate(cols)],
                  *[sample_skew(_q(c)).alias(f"s{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), F.col(f"m{i}").alias("min"),
                        F.col(f"s{i}").alias("skew")) for i, c in enumerate(cols)]
    out = wide.select(F.inline(F.array(*structs)))
    return out.withColumn("chosen", F.coalesce((F.col("min") > 0) & (F.abs("skew") > skew_limit), F.lit(False)))
