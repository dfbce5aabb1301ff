"""Tail probabilities of the F and chi-square distributions as column expressions.

Regularised incomplete beta and gamma functions by their continued fractions (and the gamma series), with as many steps as
the parameters need; everything is built-in functions over a row's own numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TINY = 1e-300


def ln_gamma(z: Column) -> Column:
    """Natural logarithm of the gamma function for ``z > 0`` (Stirling's series, ten places further up)."""
    y = z + 10
    below = sum((F.log(z + i) for i in range(1, 10)), F.log(z))
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7) + 1 / (1188 * y ** 9)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - below


def _guard(v: Column) -> Column:
    return F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)


def _steps(largest: Column) -> Column:
    """Enough steps for the fractions to converge: they need some multiple of the square root of the largest parameter."""
    return F.sequence(F.lit(1), (F.lit(200) + F.ceil(6 * F.sqrt(largest))).cast("int"))


def with_beta(df: DataFrame, a: Column, b: Column, x: Column, out: str) -> DataFrame:
    """``df`` with the regularised incomplete beta function I_x(a, b) for ``a, b > 0`` and ``0 <= x <= 1`` (else NULL)."""
    d = df.withColumns({"_a": a.cast("double"), "_b": b.cast("double"), "_x": x.cast("double")})
    ok = (F.col("_a") > 0) & (F.col("_b") > 0) & F.col("_x").between(0.0, 1.0)
    # the fraction converges fast on one side of the mean; the other side is its mirror image
    d = d.withColumn("_m", F.col("_x") > F.try_divide(F.col("_a") + 1, F.col("_a") + F.col("_b") + 2))
    d = d.select("*", F.when(F.col("_m"), F.col("_b")).otherwise(F.col("_a")).alias("_p"), F.when(F.col("_m"), F.col("_a")).otherwise(F.col("_b")).alias("_q"),
                 F.when(F.col("_m"), 1 - F.col("_x")).otherwise(F.col("_x")).alias("_y"))
    p, q, y = F.col("_p"), F.col("_q"), F.col("_y")

    def half(s, factor):
        c, e = _guard(1 + F.try_divide(factor, s["c"])), F.try_divide(F.lit(1.0), _guard(1 + factor * s["d"]))
        return F.struct(c.alias("c"), e.alias("d"), (s["h"] * c * e).alias("h"))

    def step(s, m):
        m = m.cast("double")
        s = half(s, m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)))
        return half(s, -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1)))

    first = F.try_divide(F.lit(1.0), _guard(1 - (p + q) * y / (p + 1)))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    fraction = F.aggregate(_steps(F.greatest(p, q)), start, step, lambda s: s["h"])
    front = F.exp(ln_gamma(p + q) - ln_gamma(p) - ln_gamma(q) + p * F.log(y) + q * F.log1p(-y)) / p
    tail = F.when(y <= 0, F.lit(0.0)).when(y >= 1, F.lit(1.0)).otherwise(front * fraction)
    return d.withColumn(out, F.when(ok, F.when(F.col("_m"), 1 - tail).otherwise(tail))).drop("_a", "_b", "_x", "_m", "_p", "_q", "_y")


def with_upper_gamma(df: DataFrame, s: Column, x: Column, out: str) -> DataFrame:
    """``df`` with the regularised upper incomplete gamma function Q(s, x) for ``s > 0`` and ``x >= 0`` (else NULL)."""
    d = df.withColumns({"_s": s.cast("double"), "_x": x.cast("double")})
    s, x = F.col("_s"), F.col("_x")
    front = F.exp(s * F.log(x) - x - ln_gamma(s))

    def term(t, n):
        next_ = t["t"] * x / (s + n)
        return F.struct(next_.alias("t"), (t["sum"] + next_).alias("sum"))

    first = F.try_divide(F.lit(1.0), s)
    series = F.aggregate(_steps(F.greatest(s, x)), F.struct(first.alias("t"), first.alias("sum")), term, lambda t: t["sum"])

    def step(t, i):
        i = i.cast("double")
        a, b = -i * (i - s), x + 2 * i + 1 - s
        d = F.try_divide(F.lit(1.0), _guard(a * t["d"] + b))
        c = _guard(b + F.try_divide(a, t["c"]))
        return F.struct(c.alias("c"), d.alias("d"), (t["h"] * c * d).alias("h"))

    first = F.try_divide(F.lit(1.0), _guard(x + 1 - s))
    fraction = F.aggregate(_steps(F.greatest(s, x)), F.struct(F.lit(1 / TINY).alias("c"), first.alias("d"), first.alias("h")), step, lambda t: t["h"])
    q = F.when(x <= 0, F.lit(1.0)).when(x < s + 1, 1 - front * series).otherwise(front * fraction)
    return d.withColumn(out, F.when((s > 0) & (x >= 0), q)).drop("_s", "_x")


def with_f_tail(df: DataFrame, f: Column, d1: Column, d2: Column, out: str) -> DataFrame:
    """P(F(d1, d2) >= f)."""
    d2, d1 = d2.cast("double"), d1.cast("double")
    return with_beta(df, d2 / 2, d1 / 2, F.try_divide(d2, d2 + d1 * f), out)


def with_chi2_tail(df: DataFrame, chi2: Column, dof: Column, out: str) -> DataFrame:
    """P(chi-square(dof) >= chi2)."""
    return with_upper_gamma(df, dof.cast("double") / 2, chi2 / 2, out)
