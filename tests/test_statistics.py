"""Tail probabilities against plain numeric integration; tests of hypotheses; nested records."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import special
from tessera.operators import hypothesis as hyp
from tessera.plans.catalog_ml import scratch
from tessera.sources import files


def integral(f, a, b, n=400_000):
    """Simpson's rule."""
    x = np.linspace(a, b, n + 1)
    y = f(x)
    return (b - a) / n / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())


def f_tail(f, d1, d2):
    # with x = u^2 the density has no pole at 0
    a, b = d1 / 2, d2 / 2
    top = math.sqrt(d2 / (d2 + d1 * f))
    log_b = math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    # I_x(b, a) over x = sin^2 keeps both ends smooth
    t = math.asin(top)
    with np.errstate(divide="ignore"):
        return integral(lambda u: 2 * np.exp((2 * b - 1) * np.log(np.maximum(np.sin(u), 1e-300)) + (2 * a - 1) * np.log(np.cos(u)) - log_b), 0, t)


def chi2_tail(x, k):
    s = k / 2
    with np.errstate(divide="ignore"):
        return 1 - integral(lambda u: 2 * np.exp((2 * s - 1) * np.log(np.maximum(u, 1e-300)) - u * u - math.lgamma(s)), 0, math.sqrt(x / 2))


def test_ln_gamma(spark):
    z = [1e-3, 0.5, 1.0, 2.5, 9.0, 50.0, 1e4, 1e8]
    got = spark.createDataFrame([(v,) for v in z], "z double").select("z", special.ln_gamma(F.col("z")).alias("g")).collect()
    assert all(r.g == pytest.approx(math.lgamma(r.z), rel=1e-13, abs=1e-11) for r in got)


def test_tails_agree_with_integration(spark):
    cases = [(f, d1, d2) for f in (0.05, 0.7, 1.0, 2.5, 9.0) for d1 in (1, 4, 30) for d2 in (2, 11, 400, 20_000)]
    got = special.with_f_tail(spark.createDataFrame(cases, "f double, d1 int, d2 int"), F.col("f"), F.col("d1"), F.col("d2"), "p").collect()
    for r in got:
        assert r.p == pytest.approx(f_tail(r.f, r.d1, r.d2), abs=1e-8)
    cases = [(x, k) for x in (0.01, 0.9, 4.0, 30.0, 250.0) for k in (1, 2, 7, 200)]
    got = special.with_chi2_tail(spark.createDataFrame(cases, "x double, k int"), F.col("x"), F.col("k"), "p").collect()
    for r in got:
        assert r.p == pytest.approx(chi2_tail(r.x, r.k), abs=1e-8)
    # two degrees of freedom have a closed form, also far out and with many rows
    far = special.with_chi2_tail(spark.createDataFrame([(600.0, 2)], "x double, k int"), F.col("x"), F.col("k"), "p").first().p
    assert far == pytest.approx(math.exp(-300), rel=1e-9)
    many = special.with_f_tail(spark.createDataFrame([(3.0, 2, 10_000_000)], "f double, d1 int, d2 int"), F.col("f"), F.col("d1"), F.col("d2"), "p").first().p
    assert many == pytest.approx(math.exp(-3), abs=1e-6)
    odd = special.with_f_tail(spark.createDataFrame([(None, 2, 3), (0.0, 2, 3), (1.0, 0, 3)], "f double, d1 int, d2 int"), F.col("f"), F.col("d1"), F.col("d2"), "p")
    assert [r.p for r in odd.collect()] == [None, 1.0, None]


def test_statistics_of_hypotheses(spark):
    rng = np.random.default_rng(3)
    rows = [(f"g{i % 3}", f"h{i % 4}", float(i % 3) * 0.5 + rng.normal(), float(rng.random() < (0.2 + 0.3 * (i % 3 == 0))), 1.0) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, h string, x double, y double, one double")
    spec = lambda i, key, target: {"id": i, "kind": "group_mean", "key": key, "target": target, "expected_direction": "none"}
    specs = [spec("A", "g", "x"), spec("B", "h", "x"), spec("C", "g", "y"), spec("D", "h", "y"), spec("E", "g", "one"), spec("F", "one", "x")]
    got = {r.id: r for r in hyp.test_statistics(df, specs).collect()}
    for name, j, t in (("A", 0, 2), ("B", 1, 2), ("C", 0, 3), ("D", 1, 3)):
        parts = [np.array([r[t] for r in rows if r[j] == g]) for g in sorted({r[j] for r in rows})]
        whole = np.concatenate(parts)
        among = sum(len(p) * (p.mean() - whole.mean()) ** 2 for p in parts)
        within = sum(((p - p.mean()) ** 2).sum() for p in parts)
        k, n = len(parts), len(whole)
        f = among / (k - 1) / (within / (n - k))
        assert got[name].f_stat == pytest.approx(f, rel=1e-9) and got[name].f_p == pytest.approx(f_tail(f, k - 1, n - k), abs=1e-8)
        if t == 3:
            chi2 = among / (whole.mean() * (1 - whole.mean()))
            assert got[name].chi2 == pytest.approx(chi2, rel=1e-9) and got[name].p_value == pytest.approx(chi2_tail(chi2, k - 1), abs=1e-8)
        else:
            assert got[name].chi2 is None and got[name].p_value == got[name].f_p
    assert got["E"].p_holm is None and got["F"].p_holm is None and got["E"].f_stat is None
    known = sorted((got[i].p_value, i) for i in "ABCD")
    worst = 0.0
    for rank, (p, i) in enumerate(known):
        worst = max(worst, min(1.0, p * (4 - rank)))
        assert got[i].p_holm == pytest.approx(worst, abs=1e-15)
    verdicts = {r.id: r.verdict for r in hyp.verdict_by_test(hyp.run_hypotheses(df, specs), hyp.test_statistics(df, specs), hyp.specs_frame(spark, specs)).collect()}
    assert verdicts == {"A": "TRUE", "B": "FALSE", "C": "TRUE", "D": "FALSE", "E": "INCONCLUSIVE", "F": "INCONCLUSIVE"}
    assert hyp.test_statistics(df, []).count() == 0


def test_nested_records_round_trip(spark):
    base = scratch(spark)
    rec = spark.createDataFrame([("late", "classification", ["a", 'say "b"\n', None])], files.TARGET_RECORD)
    files.write_records(rec, files.TARGET_RECORD, f"{base}/target")
    assert files.read_records(spark, f"{base}/target", files.TARGET_RECORD).collect() == rec.collect()
    plan = spark.sql("""select array('x') as selected, array(named_struct('name', 'r', 'expression', 'a / b')) as custom""")
    files.write_records(plan, files.STRATEGY_RECORD, f"{base}/strategy")
    back = files.read_records(spark, f"{base}/strategy", files.STRATEGY_RECORD).first()
    assert back.selected == ["x"] and back.custom[0].expression == "a / b" and back.standard is None and back.dropped is None
    with pytest.raises(ValueError, match="lost"):
        files.write_records(plan.selectExpr("selected", "1 as lost"), files.STRATEGY_RECORD, f"{base}/no")
    spark.createDataFrame([('{"target_col": ["no text"',)], "value string").write.text(f"{base}/broken")
    with pytest.raises(Exception):
        files.read_records(spark, f"{base}/broken", files.TARGET_RECORD).collect()
