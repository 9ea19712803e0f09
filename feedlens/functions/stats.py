"""Welch's t-test and the Student t p-value as plain column expressions.

Everything here is a JVM-side expression: no Python UDF, no collect.  The
per-arm inputs (mean, sample variance, count) come from one ``groupBy`` and
the test itself is column arithmetic on the result, so one row per test (or
per simulation) is produced by the executors.

p-value (two-sided).  With ``u = sqrt(df) * tan(theta)`` the t density turns
into ``g/sqrt(pi) * cos(theta)^(df-1)``, so with ``b = |t| / sqrt(df)``

    p = (2 g / sqrt(pi)) * cos(theta0)^(df-1) * I,    theta0 = atan(b),
    I = integral_0^W (cos s - b sin s)^(df-1) ds,  g = Gamma(df/2 + 1/2) / Gamma(df/2).

The tail itself is integrated, so small p-values keep their relative
accuracy, and ``log10_p`` stays finite and ordered where p underflows.  W ends
at theta = pi/2 or where the integrand has fallen by e^-FALL.  The integral is
a Gauss-Legendre rule in v with s = W (1 - v^2), which smooths the end: one
``aggregate`` over a constant array of nodes and weights.  ``g`` is the asymptotic series of the gamma
ratio at ``x + 16`` brought back to ``x`` with sixteen recurrence factors (Spark
has no lgamma).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The integrand is followed until it has fallen by exp(-FALL).
FALL = 32
#: Nodes of the Gauss-Legendre rule on [0, 1].
NODES = 64
_SHIFT = 16
# coefficients of Gamma(y + 1/2) / Gamma(y) = sqrt(y) * (1 + c1/y + c2/y^2 + ...)
GAMMA_RATIO_SERIES = (1.0, -1.0 / 8, 1.0 / 128, 5.0 / 1024, -21.0 / 32768, -399.0 / 262144)


def _c(x) -> Column:
    """Column as given, a column name, or a literal value."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def gamma_half_ratio_sql(x: str) -> str:
    """SQL text of Gamma(x + 1/2) / Gamma(x) for x > 0 (``x`` is SQL).

    Series at y = x + 16, times the product of (x + i) / (x + i + 1/2) for
    i = 0..15, folded left to right by ``aggregate`` (a small expression
    tree: the planner analyses it quickly)."""
    y = f"({x} + {_SHIFT})"
    series = f"{GAMMA_RATIO_SERIES[-1]!r}D"
    for coef in reversed(GAMMA_RATIO_SERIES[:-1]):
        series = f"({series} / {y} + {coef!r}D)"
    product = (f"aggregate(sequence(0, {_SHIFT - 1}), 1D, "
               f"(acc, i) -> acc * (({x} + i) / ({x} + i + 0.5D)))")
    return f"((sqrt({y}) * {series}) * {product})"


def gamma_half_ratio(x: str) -> Column:
    """Gamma(x + 1/2) / Gamma(x) of a column (name) with values > 0."""
    return F.expr(gamma_half_ratio_sql(f"CAST(`{x}` AS DOUBLE)"))


def gauss_legendre(n: int) -> list[tuple[float, float]]:
    """Nodes and weights of the n-point Gauss-Legendre rule on [0, 1]: roots of
    the Legendre polynomial by Newton's method from the cosine estimate."""
    rule = []
    for i in range(n):
        x = math.cos(math.pi * (i + 0.75) / (n + 0.5))
        for _ in range(20):
            below, here = 1.0, x
            for k in range(2, n + 1):
                below, here = here, ((2 * k - 1) * x * here - (k - 1) * below) / k
            slope = n * (x * here - below) / (x * x - 1)
            x -= here / slope
        rule.append(((1 - x) / 2, 1 / ((1 - x * x) * slope * slope)))
    return rule


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` bound to ``value``, evaluated once per row
    wherever the optimizer moves the whole expression."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _log10_p(t: str, df: str) -> str:
    """SQL of the decimal logarithm of the two-sided p-value."""
    nodes = ", ".join(f"named_struct('v', {v!r}D, 'h', {h!r}D)" for v, h in gauss_legendre(NODES))
    fall = f"({2 * FALL}D / greatest(x.k, 1e-9D))"
    width = f"least(atan2(1D, x.b), {fall} / (x.b + sqrt(x.b * x.b + {fall})))"
    s = "(w * (1 - q.v * q.v))"
    integral = (f"aggregate(array({nodes}), 0D, (acc, q) -> acc + q.h * 2 * w * q.v * "
                f"coalesce(exp(x.k * log1p(-2 * pow(sin({s} / 2), 2) - x.b * sin({s}))), 0D))")
    tail = (f"least(0D, log10({integral} * x.g * {2.0 / math.sqrt(math.pi)!r}D) "
            f"- x.k / 2 * log1p(x.b * x.b) / {math.log(10)!r}D)")
    parts = (f"named_struct('b', abs({t}) / sqrt({df}), 'k', {df} - 1, "
             f"'g', {gamma_half_ratio_sql(f'({df} / 2)')})")
    return f"CASE WHEN {t} IS NOT NULL AND {df} > 0 THEN {_let(parts, 'x', _let(width, 'w', tail))} END"


def with_p_value(frame: DataFrame, t: str = "t", df: str = "df", out: str = "p") -> DataFrame:
    """Add the two-sided Student t p-value of columns ``t`` and ``df`` as
    ``out``, and its decimal logarithm as ``log10_<out>``.

    b, W and the factor before the integral are bound once per row inside the
    expression, so a filter on ``out`` that the optimizer pushes below other
    operators costs one more evaluation, not one per node.  NULL when t or df
    is NULL or df <= 0."""
    log10_p = F.expr(_log10_p(f"CAST(`{t}` AS DOUBLE)", f"CAST(`{df}` AS DOUBLE)"))
    cols = [F.col(f"`{c}`") for c in frame.columns]
    return (frame.select(*cols, log10_p.alias(f"log10_{out}"))
            .select(*cols, F.expr(f"pow(10D, `log10_{out}`)").alias(out), f"log10_{out}"))


def with_welch(frame: DataFrame, m1="mean_a", v1="var_a", n1="n_a", m2="mean_b",
               v2="var_b", n2="n_b") -> DataFrame:
    """Add t, df and p of Welch's unequal-variance t-test (first arm minus
    second) from per-arm mean, sample variance and count columns.

    NULL when an arm has fewer than two values or both variances are zero.
    """
    m1, v1, n1, m2, v2, n2 = map(_c, (m1, v1, n1, m2, v2, n2))
    a, b = F.col("_w_a"), F.col("_w_b")
    se2 = a + b
    ok = (n1 >= 2) & (n2 >= 2) & (se2 > 0)
    staged = frame.select("*", (v1 / n1).alias("_w_a"), (v2 / n2).alias("_w_b"))
    staged = staged.select(
        *[F.col(f"`{c}`") for c in frame.columns],
        F.when(ok, (m1 - m2) / F.sqrt(se2)).alias("t"),
        F.when(ok, se2 * se2 / (a * a / (n1 - 1) + b * b / (n2 - 1))).alias("df"))
    return with_p_value(staged)


def equal_width_bin(x, lo, hi, bins: int) -> Column:
    """1-based bin of ``x`` among ``bins`` equal bins of [lo, hi]; the last
    bin is closed on the right; a zero-width range puts everything in bin 1.
    NULL for NULL x."""
    x, lo, hi = _c(x), _c(lo), _c(hi)
    width = hi - lo
    raw = F.floor((x - lo) / width * bins) + 1
    b = F.when(width <= 0, F.lit(1)).otherwise(F.least(F.greatest(raw, F.lit(1)), F.lit(bins)))
    return F.when(x.isNotNull(), b.cast("int"))
