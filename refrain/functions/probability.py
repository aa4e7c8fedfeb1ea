"""Tail probabilities as column expressions (published approximations, no UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Abramowitz and Stegun, formula 7.1.26.
ERF_SCALE = 0.3275911
ERF_TERMS = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

# Normal quantiles for 95 % confidence and 80 % power.
Z_95 = 1.959964
Z_POWER_80 = 0.841621


def erfc(x: Column) -> Column:
    """1 - erf(x) for x >= 0, error below 1.5e-7."""
    t = 1 / (1 + ERF_SCALE * x)
    series = F.lit(0.0)
    for term in reversed(ERF_TERMS):
        series = (series + term) * t
    return series * F.exp(-x * x)


def normal_two_sided(z: Column) -> Column:
    return erfc(F.abs(z) / math.sqrt(2))


def normal_upper(z: Column) -> Column:
    tail = erfc(F.abs(z) / math.sqrt(2)) / 2
    return F.when(z >= 0, tail).otherwise(1 - tail)


def t_two_sided(t: Column, df: Column) -> Column:
    """Student's t through Wallace's normal approximation."""
    z = F.sqrt(df * F.log1p(t * t / df)) * (8 * df + 1) / (8 * df + 3)
    return normal_two_sided(z)


def chi2_one(x: Column) -> Column:
    """Upper tail of chi-square with one degree of freedom."""
    return normal_two_sided(F.sqrt(x))


def chi2_upper(x: Column, df: Column) -> Column:
    """Upper tail of chi-square through the Wilson-Hilferty cube root."""
    spread = F.lit(2.0) / (9 * df)
    return normal_upper((F.pow(x / df, F.lit(1.0 / 3)) - (1 - spread)) / F.sqrt(spread))


# The expansion of Hill's algorithm 396 for quantiles of Student's t.
HILL_B, HILL_C, HILL_D = 48.0, (20700.0, 98.0, 16.0, 96.36), (94.5, 3.0)


def t_quantile_95(df: Column) -> Column:
    """The value that Student's t exceeds in size with probability 0.05, for 1 or more degrees of freedom.

    Exact for one and two; Hill's expansion beyond (six digits from about five degrees on).
    """
    p, x = 0.05, -Z_95

    def once(value: Column, use) -> Column:
        """``use`` of a value that is computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def tail(c: Column, d: Column, n: Column, y: Column, a: Column, b: Column) -> Column:
        wide = F.when(n < 5, c + 0.3 * (n - 4.5) * (x + 0.6)).otherwise(c)
        wide = (((0.05 * d * x - 5) * x - 7) * x - 2) * x + b + wide
        far = (((((0.4 * x * x + 6.3) * x * x + 36) * x * x + 94.5) / wide - x * x - 3) / b + 1) * x
        near = ((1 / (((n + 6) / (n * y) - 0.089 * d - 0.822) * (n + 2) * 3) + 0.5 / (n + 4)) * y - 1) * (n + 1) / (n + 2) + 1 / y
        return F.sqrt(n * F.when(y > 0.05 + a, F.exp(a * far * far) - 1).otherwise(near))

    def expansion(n: Column) -> Column:
        a = 1 / (n - 0.5)
        b = HILL_B / (a * a)
        c = ((HILL_C[0] * a / b - HILL_C[1]) * a - HILL_C[2]) * a + HILL_C[3]
        d = ((HILL_D[0] / (b + c) - HILL_D[1]) / b + 1) * F.sqrt(a * (math.pi / 2)) * n
        return once(F.struct(c.alias("c"), d.alias("d"), F.pow(d * p, 2 / n).alias("y")), lambda v: tail(v["c"], v["d"], n, v["y"], a, b))

    n = df.cast("double")
    two = math.sqrt(2 / (p * (2 - p)) - 2)
    return F.when(n < 1.5, math.cos(p * math.pi / 2) / math.sin(p * math.pi / 2)).when(n == 2, two).otherwise(once(n, expansion))
