"""Profiling and descriptive aggregates (inventory 22-32).

The reference loops over columns (one pass per column and statistic); here
each profile is one wide aggregate over the table, unpivoted afterwards
into a long (one row per column) result. Distinct counts and modes go
through a long ``(column, value)`` grouping whose partial aggregation
collapses hot values before the shuffle.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.quantile import exact_quantiles, mode_table, quantile_row
from tessera.functions.safe import NUMERIC_TYPES, nan_to_null, numeric_columns, sample_skew, string_columns
from tessera.session import persisted


def _q(c: str):
    return F.col(f"`{c}`")


def _unpivot_row(wide: DataFrame, names: list[str], fields: dict[str, str], types: dict[str, str]) -> DataFrame:
    """Turn the one-row wide aggregate into one row per column name.

    ``fields`` maps output field -> template with ``{i}`` for the column index;
    a missing field for a column becomes NULL.
    """
    structs = []
    for i, n in enumerate(names):
        parts = [F.lit(n).alias("column")]
        for f, tmpl in fields.items():
            src = tmpl.format(i=i)
            parts.append((F.col(src) if src in wide.columns else F.lit(None)).cast(types[f]).alias(f))
        structs.append(F.struct(*parts))
    return wide.select(F.inline(F.array(*structs)))


def distinct_counts(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """(column, nunique) for every column: nulls not counted (pandas ``nunique``).

    Exact: ``count(DISTINCT c)`` for all columns in one aggregate - Catalyst
    expands each row once per column and partially aggregates (column,
    value) pairs before the shuffle, so a hot value is combined map-side.
    ``approx=True`` uses HyperLogLog++ (bounded memory, one pass).
    """
    cols = list(cols if cols is not None else df.columns)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column string, nunique long")
    fn = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(*[fn(_q(c)).alias(f"d{i}") for i, c in enumerate(cols)])
    return _unpivot_row(wide, cols, {"nunique": "d{i}"}, {"nunique": "long"})


PROFILE_SCHEMA = ("column string, position int, dtype string, nunique long, null_pct double, mean double, "
                  "std double, min double, max double, skew double")


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: dtype, nunique, null %, and for numbers mean, std, min, max, skew.

    Two passes over the (persisted) input: one wide aggregate and one
    distinct-count grouping; the result has one row per column.
    """
    df = nan_to_null(df)
    cols = df.columns
    num = set(numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(_q(c).isNull()).alias(f"z{i}"))
        if c in num:
            x = _q(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                     F.max(x).alias(f"hi{i}"), sample_skew(x).alias(f"k{i}")]
    with persisted(df) as d:
        w = d.agg(*aggs).first()
        nun = {r["column"]: r["nunique"] for r in distinct_counts(d, cols).collect()}
    n = w["n"]
    rows = []
    for i, f in enumerate(df.schema.fields):
        c = f.name
        g = (lambda k: w[f"{k}{i}"]) if c in num else (lambda k: None)
        rows.append((c, i, f.dataType.simpleString(), int(nun.get(c, 0)),
                     (w[f"z{i}"] * 100.0 / n) if n else None, g("m"), g("s"),
                     None if g("lo") is None else float(g("lo")), None if g("hi") is None else float(g("hi")),
                     g("k")))
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


DESCRIBE_SCHEMA = ("column string, position int, count long, unique long, top string, freq long, mean double, "
                   "std double, min double, q25 double, q50 double, q75 double, max double")


def describe_all(df: DataFrame, digits: int | None = None) -> DataFrame:
    """pandas ``describe(include='all')`` in long form, one row per column.

    numbers: count, mean, std, min, 25/50/75 % (exact, interpolated), max;
    strings, booleans, dates and timestamps (as text): count, unique, top (most frequent,
    smallest on ties), freq. NaN is a missing value.
    """
    other = [f.name for f in df.schema.fields
             if isinstance(f.dataType, (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))]
    df = nan_to_null(df).select([_q(c).cast("string").alias(c) if c in other else _q(c) for c in df.columns])
    cols = df.columns
    num = numeric_columns(df)
    strs = string_columns(df)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        aggs.append(F.count(_q(c)).alias(f"c{i}"))
        if c in num:
            x = _q(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                     F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    with persisted(df) as d:
        # one scan: the statistics ride on the quantiles' first pass
        qs, w = quantile_row(d, num, [0.25, 0.5, 0.75], extra=aggs)
        # modes and distinct counts come from the same grouped (column, value) count
        top, uniq = {}, {}
        for r in mode_table(d, strs, with_distinct=True).collect():
            top[r["name"]], uniq[r["name"]] = (r["value"], r["freq"]), r["nunique"]

    def rd(v):
        if v is None:
            return None
        if digits is None:
            return float(v)
        # half-up on the exact binary value, as Spark's and DuckDB's round
        return float(Decimal(float(v)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))
    rows = []
    for i, c in enumerate(cols):
        if c in num:
            rows.append((c, i, w[f"c{i}"], None, None, None, rd(w[f"m{i}"]), rd(w[f"s{i}"]), rd(w[f"lo{i}"]),
                         rd(qs.get((c, 0.25))), rd(qs.get((c, 0.5))), rd(qs.get((c, 0.75))), rd(w[f"hi{i}"])))
        else:
            t, fq = top.get(c, (None, None))
            rows.append((c, i, w[f"c{i}"], uniq.get(c) if c in strs else None, t, fq,
                         None, None, None, None, None, None, None))
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


def describe_numeric_transposed(df: DataFrame, digits: int = 3) -> DataFrame:
    """Numeric-only describe rounded to ``digits`` (the notebook's transposed view)."""
    num = numeric_columns(df)
    d = describe_all(df.select([_q(c) for c in num]), digits=digits)
    return d.select("column", "position", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def table_inventory(df: DataFrame) -> DataFrame:
    """Shape and dtypes: one row per column with the table's row count."""
    structs = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("dtype"))
               for i, f in enumerate(df.schema.fields)]
    n = df.agg(F.count(F.lit(1)).alias("rows"))
    return n.select("rows", F.lit(len(df.columns)).alias("columns"), F.inline(F.array(*structs)))


def null_report(df: DataFrame) -> DataFrame:
    """Null count per column, only columns with nulls, most nulls first."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(_q(c).isNull()).alias(f"z{i}")
                                                  for i, c in enumerate(cols)])
    long = _unpivot_row(wide, cols, {"nulls": "z{i}"}, {"nulls": "long"})
    return long.where(F.col("nulls") > 0).orderBy(F.desc("nulls"), F.asc("column"))


def iqr_outliers(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows strictly outside [q1 - 1.5 iqr, q3 + 1.5 iqr] per numeric column (> 0 only).

    Quartiles are exact (distributed); the 2 x p bounds are inlined as
    literals into one wide conditional count over the persisted projection.
    """
    cols = cols or numeric_columns(df)
    schema = "column string, outliers long, q1 double, q3 double, lower double, upper double"
    rows = []
    with persisted(nan_to_null(df.select([_q(c) for c in cols]))) as d:
        qs = quantile_row(d, cols, [0.25, 0.75])
        aggs, kept = [], []
        for i, c in enumerate(cols):
            q1, q3 = qs.get((c, 0.25)), qs.get((c, 0.75))
            if q1 is None or q3 is None:
                continue
            lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
            x = _q(c).cast("double")
            aggs.append(F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias(f"o{i}"))
            kept.append((i, c, q1, q3, lo, hi))
        if aggs:
            w = d.agg(*aggs).first()
            rows = [(c, w[f"o{i}"], q1, q3, lo, hi) for i, c, q1, q3, lo, hi in kept if w[f"o{i}"] > 0]
    return df.sparkSession.createDataFrame(rows, schema)


def value_counts(df: DataFrame, col: str, top: int | None = 15) -> DataFrame:
    """Counts per non-null value, count descending then value ascending; top ``top``.

    ``orderBy(...).limit`` plans as a per-partition top-k then a merge, so the
    sort never sees all values in one task.
    """
    out = (df.where(_q(col).isNotNull()).groupBy(_q(col).alias(col)).agg(F.count(F.lit(1)).alias("count"))
             .orderBy(F.desc("count"), F.asc(col)))
    return out.limit(top) if top else out


def value_shares(df: DataFrame, col: str, top: int | None = None, percent: bool = False) -> DataFrame:
    """Normalised value counts. The total is a scalar subquery (one extra
    aggregate broadcast as a literal), not a global window."""
    nonnull = df.where(_q(col).isNotNull())
    total = nonnull.select(F.count(F.lit(1))).scalar()
    vc = value_counts(df, col, top)
    mult = 100.0 if percent else 1.0
    return vc.withColumn("share", F.try_divide(F.col("count") * mult, total))


def mode_of(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value (smallest on ties) and its share of all rows."""
    typ = "double" if isinstance(df.schema[col].dataType, NUMERIC_TYPES) else "string"
    m = mode_table(df, [col], typ)
    total = df.select(F.count(F.lit(1))).scalar()
    return m.select(F.col("value").alias("mode"), "freq", F.try_divide(F.col("freq") * 1.0, total).alias("share"))


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram between the finite min and max, last bin closed, nulls dropped.

    Every bin is returned (empty ones with count 0). A constant column puts
    all rows into bin 0. Infinite values are counted apart, in bins -1 and ``bins`` whose two edges are
    infinite; these bins are there only if they hold rows.
    """
    spark = df.sparkSession
    df = nan_to_null(df, [col])
    raw, top = _q(col).cast("double"), F.lit(float("inf"))
    x = F.when(F.abs(raw) < top, raw)
    mm = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx"))
    mn, mx = mm.select("mn").scalar(), mm.select("mx").scalar()
    width = (mx - mn) / F.lit(float(bins))
    b = F.when(mx == mn, F.lit(0)).otherwise(
        F.least(F.floor((x - mn) / width), F.lit(bins - 1))).cast("int")
    b = F.when(raw == top, F.lit(bins)).when(raw == -top, F.lit(-1)).otherwise(b)
    counts = (df.where(raw.isNotNull()).select(b.alias("bin"))
                .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    # bins rows: bounded by the parameter
    grid = F.broadcast(spark.range(bins).select(F.col("id").cast("int").alias("bin")))
    finite = (grid.join(counts, "bin", "left")
              .select("bin", (mn + F.col("bin") * width).alias("lower"),
                      (mn + (F.col("bin") + 1) * width).alias("upper"),
                      F.coalesce("count", F.lit(0)).cast("long").alias("count"))
              .where(mn.isNotNull()))
    edge = F.when(F.col("bin") < 0, -top).otherwise(top)
    return finite.unionByName(counts.where((F.col("bin") < 0) | (F.col("bin") == bins))
                              .select("bin", edge.alias("lower"), edge.alias("upper"), "count"))


def boxplot_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Quartiles, whiskers at the extreme points within 1.5 iqr, and flier count."""
    cols = cols or numeric_columns(df)
    schema = ("column string, q1 double, median double, q3 double, iqr double, whisker_low double, "
              "whisker_high double, fliers long")
    rows = []
    with persisted(nan_to_null(df.select([_q(c) for c in cols]))) as d:
        qs = quantile_row(d, cols, [0.25, 0.5, 0.75])
        aggs, kept = [], []
        for i, c in enumerate(cols):
            q1, q2, q3 = qs.get((c, 0.25)), qs.get((c, 0.5)), qs.get((c, 0.75))
            if q1 is None:
                continue
            lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
            x = _q(c).cast("double")
            inside = (x >= F.lit(lo)) & (x <= F.lit(hi))
            aggs += [F.min(F.when(inside, x)).alias(f"wl{i}"), F.max(F.when(inside, x)).alias(f"wh{i}"),
                     F.count_if(x.isNotNull() & ~inside).alias(f"f{i}")]
            kept.append((i, c, q1, q2, q3))
        if aggs:
            w = d.agg(*aggs).first()
            rows = [(c, q1, q2, q3, q3 - q1, w[f"wl{i}"], w[f"wh{i}"], w[f"f{i}"]) for i, c, q1, q2, q3 in kept]
    return df.sparkSession.createDataFrame(rows, schema)
