"""p-value and Welch test against table values and a direct computation."""
import math

import pytest
from pyspark.sql import functions as F

from feedlens.functions.stats import (gamma_half_ratio, with_p_value,
                                      with_welch)

# (t, df) -> two-sided p from Student t tables (FIXTURES.md section 4)
TABLE = [(2.0, 10.0, 0.073388), (4.0, 5.0, 0.010323), (12.7062047, 1.0, 0.05),
         (636.619249, 1.0, 0.001), (9.9248432, 2.0, 0.01), (0.0, 5.0, 1.0)]


def test_p_value_table(spark):
    df = spark.createDataFrame([(t, d) for t, d, _ in TABLE], "t double, df double")
    rows = with_p_value(df).collect()
    for r, (_, _, expected) in zip(rows, TABLE):
        assert abs(r.p - expected) < 1e-6


def test_p_value_large_df_is_normal(spark):
    # df -> infinity: two-sided normal tail, 2 * (1 - Phi(1.96)) = 0.0499958
    df = spark.createDataFrame([(1.96, 1e7), (-1.96, 1e7), (50.0, 100.0)], "t double, df double")
    p = [r.p for r in with_p_value(df).collect()]
    assert abs(p[0] - 0.04999579) < 1e-6 and p[0] == p[1]
    assert p[2] < 1e-6


def test_p_value_nulls(spark):
    df = spark.createDataFrame([(None, 3.0), (1.0, None), (1.0, 0.0)], "t double, df double")
    assert [r.p for r in with_p_value(df).collect()] == [None, None, None]


@pytest.mark.parametrize("x", [0.5, 1.0, 2.5, 10.0, 123.4])
def test_gamma_ratio(spark, x):
    g = spark.createDataFrame([(x,)], "x double").select(gamma_half_ratio("x")).first()[0]
    exact = math.exp(math.lgamma(x + 0.5) - math.lgamma(x))
    assert abs(g - exact) / exact < 1e-9


def _welch_reference(a, b):
    na, nb = len(a), len(b)
    ma, mb = sum(a) / na, sum(b) / nb
    va = sum((x - ma) ** 2 for x in a) / (na - 1)
    vb = sum((x - mb) ** 2 for x in b) / (nb - 1)
    se2 = va / na + vb / nb
    t = (ma - mb) / math.sqrt(se2)
    dof = se2 ** 2 / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1))
    return t, dof


def test_welch_matches_formula(spark):
    a = [0.1, 0.25, 0.3, 0.12, 0.5, 0.33]
    b = [0.2, 0.22, 0.41, 0.38, 0.29]
    rows = [(1, x) for x in a] + [(2, x) for x in b]
    df = spark.createDataFrame(rows, "g int, x double")
    agg = df.agg(
        F.avg(F.when(F.col("g") == 1, F.col("x"))).alias("mean_a"),
        F.var_samp(F.when(F.col("g") == 1, F.col("x"))).alias("var_a"),
        F.count(F.when(F.col("g") == 1, F.col("x"))).alias("n_a"),
        F.avg(F.when(F.col("g") == 2, F.col("x"))).alias("mean_b"),
        F.var_samp(F.when(F.col("g") == 2, F.col("x"))).alias("var_b"),
        F.count(F.when(F.col("g") == 2, F.col("x"))).alias("n_b"))
    r = with_welch(agg).first()
    t, dof = _welch_reference(a, b)
    assert abs(r.t - t) < 1e-12 and abs(r.df - dof) < 1e-9
    assert 0 < r.p < 1


def test_welch_degenerate_arms(spark):
    # one-user arm and zero variance: t, df, p are NULL
    agg = spark.createDataFrame(
        [(0.5, None, 1, 0.4, 0.01, 10), (0.5, 0.0, 5, 0.5, 0.0, 5)],
        "mean_a double, var_a double, n_a long, mean_b double, var_b double, n_b long")
    for r in with_welch(agg).collect():
        assert r.t is None and r.df is None and r.p is None


def _p_reference(t, dof, steps=4000):
    """Two-sided p by a fine Simpson sum with an exact gamma ratio."""
    th0 = math.atan(abs(t) / math.sqrt(dof))
    h = th0 / steps
    s = sum((1 if k in (0, steps) else 4 if k % 2 else 2) * math.cos(k * h) ** (dof - 1)
            for k in range(steps + 1))
    g = math.exp(math.lgamma(dof / 2 + 0.5) - math.lgamma(dof / 2))
    return max(0.0, 1 - s * h / 3 * g * 2 / math.sqrt(math.pi))


def test_p_value_large_df_steps(spark):
    pts = [(t, d) for d in (31.0, 57.5, 200.0, 998.0, 5000.0)
           for t in (0.05, 0.7, 1.5, 2.2, 3.3, 5.0, 7.5)]
    df = spark.createDataFrame(pts, "t double, df double")
    for r in with_p_value(df).collect():
        assert abs(r.p - _p_reference(r.t, r.df)) < 1e-7


def test_grouped_welch_equals_single_tests(spark):
    from feedlens.operators import experiments
    rows = [(g, u, (u * 37 % 11) / 10.0) for g in (0, 1, 2, 3) for u in range(g * 100, g * 100 + 30)]
    users = spark.createDataFrame(rows, "exp_group int, user_id long, ctr double")
    tagged = experiments.tag_test(users, "x", 0, 3).unionByName(
        experiments.tag_test(users, "y", 1, 2))
    grouped = {r.test: r for r in experiments.welch_tests(tagged, "ctr").collect()}
    for test, (a, b) in (("x", (0, 3)), ("y", (1, 2))):
        single = experiments.welch_test(users, "ctr", a, b).first()
        for col in ("n_a", "n_b", "t", "df", "p", "reject"):
            assert getattr(grouped[test], col) == getattr(single, col)


def test_small_p_values_keep_relative_accuracy_and_order(spark):
    # normal tails by the complementary error function (df large)
    grid = [0.5, 2.0, 5.0, 8.0, 9.0, 12.0, 20.0, 30.0]
    r = with_p_value(spark.createDataFrame([(t, 1e12) for t in grid], "t double, df double")).orderBy("t").collect()
    for x in r:
        assert math.isclose(x.p, math.erfc(x.t / math.sqrt(2)), rel_tol=1e-5), x
    # df = 2 and df = 4 have closed forms
    for t in (0.0, 0.3, 3.0, 40.0, 1e4):
        two, four = (x.p for x in with_p_value(spark.createDataFrame([(t, 2.0), (t, 4.0)], "t double, df double")).orderBy("df").collect())
        c = t / math.sqrt(t * t + 2)
        assert math.isclose(two, 2 / (t * t + 2) / (1 + c), rel_tol=1e-6)
        assert t > 40 or math.isclose(four, 1 - (t / math.sqrt(4 + t * t)) * (1 + 2 / (4 + t * t)), rel_tol=1e-4, abs_tol=1e-9)
    # beyond the range of doubles the logarithm still falls
    far = [x.log10_p for x in with_p_value(spark.createDataFrame([(t, 1e5) for t in (30.0, 60.0, 90.0)], "t double, df double")).orderBy("t").collect()]
    assert far[0] > far[1] > far[2] and far[2] < -1500
