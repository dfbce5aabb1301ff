"""Distributed exact quantiles and modes.

Spark's exact ``percentile`` keeps a map of every distinct value and merges
it in a single task per group, which cannot hold a 100 TB column. Here the
exact answer is found by narrowing value intervals with grouped counts until
one value is left.

Quantiles interpolate linearly between order statistics (pandas default,
DuckDB ``quantile_cont``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import persisted

#: Equal parts that an interval is cut into; the largest finite double.
BUCKETS = 4_096
TOP = 1.7976931348623157e308


def _long(df: DataFrame, cols: list[str], value_type: str = "double") -> DataFrame:
    """Unpivot ``cols`` into (k, v) with k the column position; nulls/NaN dropped."""
    parts = [F.struct(F.lit(i).alias("k"), df[c].cast(value_type).alias("v"))
             for i, c in enumerate(cols)]
    out = df.select(F.inline(F.array(*parts))).where(F.col("v").isNotNull())
    if value_type == "double":
        out = out.where(~F.isnan("v"))
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], buckets: int = BUCKETS) -> DataFrame:
    """Exact linear-interpolated quantiles: (name string, q double, value double).

    One pass counts each column and finds its range. Then, level by level, the interval around
    every wanted rank is cut into ``buckets`` equal parts (or, while it spans many, into powers of two); a grouped aggregate (combined in
    the map tasks) gives each part's count, smallest and largest value, and the part
    that holds the rank is the next interval. A part whose smallest and largest value are equal
    is the answer. As an interval's two ends always fall into different parts, every level
    narrows: one level finds the power of two, five more the value, whatever the spread.

    A value repeated a billion times is one entry of a grouped count, and no window or sort
    ever holds more than ``buckets`` rows of an interval, so hot values never make a task
    large. Only one row per wanted rank reaches the driver in a level.
    """
    rows, _ = quantiles_with_aggs(df, cols, probs, buckets=buckets)
    return df.sparkSession.createDataFrame(rows, "name string, q double, value double")


def quantiles_with_aggs(df: DataFrame, cols: list[str], probs: list[float], extra: list | None = None,
                        buckets: int = BUCKETS):
    """Exact quantiles of ``cols`` plus ``extra`` aggregates over ``df`` in the same first pass.

    Returns (rows, extra_row): rows as in :func:`exact_quantiles`, extra_row
    the one-row result of ``extra`` (``None`` when no extra aggregate is
    given). Folding the caller's statistics (count, mean, min, ...) into the
    quantiles' first pass saves one scan of the input.
    """
    cols = list(cols)
    extra = list(extra or [])
    if not cols and not extra:
        return [], None
    # infinities take the ends of the number line, so that intervals have widths
    vals = []
    for i, c in enumerate(cols):
        x = df[c].cast("double")
        vals.append(F.when(x.isNotNull() & ~F.isnan(x), F.greatest(F.least(x, F.lit(TOP)), F.lit(-TOP))).alias(_vn(i)))
    keep = [F.col(f"`{c}`") for c in df.columns] if extra else []
    with persisted(df.select(*vals, *keep)) as src:
        p = len(cols)
        first = src.agg(*[F.count(_vn(i)).alias(f"__n{i}") for i in range(p)], *[F.min(_vn(i)).alias(f"__lo{i}") for i in range(p)],
                        *[F.max(_vn(i)).alias(f"__hi{i}") for i in range(p)], *extra).first()
        found = _select_ranks(src, {i: (first[f"__n{i}"], first[f"__lo{i}"], first[f"__hi{i}"]) for i in range(p)}, probs, buckets)
    rows = []
    for i, c in enumerate(cols):
        for q in probs:
            v = None
            if first[f"__n{i}"]:
                pos = float(q) * (first[f"__n{i}"] - 1)
                lo, hi = found[(i, math.floor(pos))], found[(i, math.ceil(pos))]
                v = lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos))
            rows.append((c, float(q), v))
    return rows, first if extra else None


def _vn(i: int) -> str:
    return f"__q{i}"


def _part(x, lo: float, hi: float, buckets: int):
    """Which of the ``buckets`` parts of the interval ``lo`` to ``hi`` holds ``x``; both ends never share one.

    An interval within a few powers of two is cut into equal widths. A wider one is cut by sign and power of two, so that
    values spread over hundreds of powers of ten are told apart in one level, whatever their spread.
    """
    if lo < 0 < hi or (lo == 0 or hi == 0) or max(abs(lo), abs(hi)) > 16 * min(abs(lo), abs(hi)):
        # -1100 is below the exponent of the least double; zero stands alone between the signs
        power = F.floor(F.log2(F.abs(x))).cast("int") + F.lit(1101)
        return F.when(x > 0, power).when(x < 0, -power).otherwise(0)
    # halves keep the width finite; of neighbouring tiny numbers it may vanish
    width = hi / 2 - lo / 2
    part = (F.floor((x / 2 - F.lit(lo / 2)) / F.lit(width) * buckets).cast("int") if width
            else F.when(x > F.lit(lo), 1).otherwise(0))
    return F.least(part, F.lit(buckets - 1))


def _select_ranks(src: DataFrame, ranges: dict, probs: list[float], buckets: int) -> dict:
    """{(column, 0-based rank): value} for the ranks around every quantile."""
    spark = src.sparkSession
    found: dict = {}
    # (column, rank) -> (lo, hi, rank inside that interval)
    open_: dict = {}
    for i, (n, lo, hi) in ranges.items():
        for q in probs if n else ():
            for r in {math.floor(float(q) * (n - 1)), math.ceil(float(q) * (n - 1))}:
                if lo == hi:
                    found[(i, r)] = lo
                else:
                    open_[(i, r)] = (lo, hi, r)
    while open_:
        intervals = sorted({(i, lo, hi) for (i, _), (lo, hi, _) in open_.items()})
        index = {v: j for j, v in enumerate(intervals)}
        recs = []
        for j, (i, lo, hi) in enumerate(intervals):
            x = F.col(_vn(i))
            x = F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), x)
            recs.append(F.struct(F.lit(j).alias("j"), x.alias("v"), _part(x, lo, hi, buckets).alias("b")))
        parts = (src.select(F.inline(F.array(*recs))).where(F.col("v").isNotNull()).groupBy("j", "b")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
        upto = Window.partitionBy("j").orderBy("b")  # at most ``buckets`` rows (4,300 powers of two) an interval
        parts = parts.withColumn("upto", F.sum("n").over(upto))
        want = spark.createDataFrame([(index[(i, lo, hi)], i, r, inside) for (i, r), (lo, hi, inside) in open_.items()],
                                     "j int, i int, r long, inside long")
        # want: at most two rows for each column and quantile
        hits = (parts.join(F.broadcast(want), "j").where("inside < upto and inside >= upto - n")
                .select("i", "r", "lo", "hi", (F.col("inside") - (F.col("upto") - F.col("n"))).alias("inside")).collect())
        open_ = {}
        for h in hits:
            if h["lo"] == h["hi"]:
                found[(h["i"], h["r"])] = h["lo"]
            else:
                open_[(h["i"], h["r"])] = (h["lo"], h["hi"], h["inside"])
    return {k: math.copysign(math.inf, v) if abs(v) == TOP else v for k, v in found.items()}


def quantile_row(df: DataFrame, cols: list[str], probs: list[float], extra: list | None = None, **kw):
    """The (bounded) quantile table as {(name, q): value}.

    With ``extra`` aggregates, returns ({(name, q): value}, extra_row), the
    aggregates computed in the quantiles' first pass.
    """
    rows, extra_row = quantiles_with_aggs(df, cols, probs, extra=extra, **kw)
    qs = {(n, q): v for n, q, v in rows}
    return (qs, extra_row) if extra else qs


def mode_table(df: DataFrame, cols: list[str], value_type: str = "string",
               with_distinct: bool = False) -> DataFrame:
    """Most frequent non-null value per column, smallest value on ties.

    (name, value, freq, n[, nunique]). Counting is a grouped aggregate
    (map-side combine), the arg-max a ``min(struct(-count, value))`` - no
    single task ever holds a column's distinct values. ``with_distinct``
    adds the number of distinct values, counted from the same groups.
    """
    spark = df.sparkSession
    if not cols:
        extra = ", nunique long" if with_distinct else ""
        return spark.createDataFrame([], f"name string, value {value_type}, freq long, n long{extra}")
    long = _long(df, cols, value_type) if value_type == "double" else df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("k"), df[c].cast(value_type).alias("v")) for i, c in enumerate(cols)]))
    ).where(F.col("v").isNotNull())
    vc = long.groupBy("k", "v").agg(F.count(F.lit(1)).alias("cnt"))
    best = vc.groupBy("k").agg(F.min(F.struct((-F.col("cnt")).alias("nc"), F.col("v").alias("v"))).alias("m"),
                              F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("nunique"))
    names = F.array(*[F.lit(c) for c in cols])
    return best.select(F.element_at(names, F.col("k") + 1).alias("name"),
                       F.col("m.v").alias("value"), (-F.col("m.nc")).alias("freq"), "n",
                       *(["nunique"] if with_distinct else []))
