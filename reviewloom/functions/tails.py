"""Tail probabilities of test statistics as columns, so that planning a test runs no job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 400  # of the continued fraction; it has settled long before
SHIFT = 8
# Coefficients of Stirling's series.
STIRLING = [(1, 12), (-1, 360), (1, 1260), (-1, 1680), (1, 1188)]


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function for positive numbers, by Stirling's series at ``z + SHIFT``."""
    up = z + F.lit(float(SHIFT))
    series = sum((F.lit(a / b) / F.pow(up, F.lit(2.0 * k + 1)) for k, (a, b) in enumerate(STIRLING)),
                 F.lit(0.0))
    below = sum((F.ln(z + F.lit(float(k))) for k in range(SHIFT)), F.lit(0.0))
    half_log_tau = F.lit(0.9189385332046727)
    return (up - 0.5) * F.ln(up) - up + half_log_tau + series - below


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, from its start (Lentz's method)."""

    def turn(s: Column, step: Column) -> Column:
        d = F.lit(1.0) / (F.lit(1.0) + step * s["d"])
        c = F.lit(1.0) + step / s["c"]
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    def both(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + m * 2 - 1) * (a + m * 2))
        odd = -(a + m) * (a + b + m) * x / ((a + m * 2) * (a + m * 2 + 1))
        bound = F.transform(F.array(turn(s, even)), lambda t: turn(t, odd))
        return F.get(bound, F.lit(0))

    first = F.lit(1.0) / (F.lit(1.0) - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    steps = F.transform(F.sequence(F.lit(1), F.lit(STEPS)), lambda m: m.cast("double"))
    return F.aggregate(steps, start, both)["h"]


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta function."""
    a, b, x = (c.cast("double") for c in (a, b, x))
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(x) + b * F.log1p(-x))
    return (
        F.when(x <= 0, 0.0).when(x >= 1, 1.0)
        .when(x < (a + 1) / (a + b + 2), front * _fraction(a, b, x) / a)
        .otherwise(F.lit(1.0) - front * _fraction(b, a, F.lit(1.0) - x) / b)
    )


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p of a correlation from n pairs, by Student's t with n - 2 degrees; null for fewer
    than three pairs or no correlation."""
    p = incomplete_beta((n - 2) / F.lit(2.0), F.lit(0.5), F.lit(1.0) - r * r)
    return F.when((n >= 3) & r.isNotNull() & ~F.isnan(r), F.when(F.abs(r) >= 1, 0.0).otherwise(p))
