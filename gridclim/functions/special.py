"""Special functions as column expressions: fixed work per row, no Python."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos' approximation of the gamma function with g = 7 and nine terms.
LANCZOS_G = 7.0
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 0.5."""
    z = x - 1
    total = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:], 1):
        total = total + F.lit(c) / (z + k)
    t = z + LANCZOS_G + 0.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(total)


def _fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """The continued fraction of the incomplete beta function by Lentz' method.

    Converges within about the square root of the larger parameter where x < (a+1)/(a+b+2).
    """

    def term(k: Column) -> Column:
        m = F.floor(k / 2)
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(k % 2 == 0, even).otherwise(odd)

    tiny = F.lit(1e-300)  # keeps a vanishing denominator from ending the fraction
    kept = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)
    first = 1 / kept(1 - (a + b) * x / (a + 1))
    # The coefficients first, so each is worked out once and the fold stays small.
    terms = F.transform(F.sequence(F.lit(2), F.lit(steps)), term)

    def fold(s: Column, e: Column) -> Column:
        d, c = 1 / kept(1 + e * s["d"]), kept(1 + e / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(terms, start, fold, lambda s: s["h"])


def incomplete_beta(a: Column, b: Column, x: Column, steps: int = 400) -> Column:
    """The regularised incomplete beta function for a, b >= 0.5 and 0 <= x <= 1."""

    def side(a: Column, b: Column, x: Column) -> Column:
        front = log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(x) + b * F.ln(1 - x)
        return F.exp(front) * _fraction(a, b, x, steps) / a

    inside = F.when(x < (a + 1) / (a + b + 2), side(a, b, x)).otherwise(1 - side(b, a, 1 - x))
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(inside)


def correlation_p_value(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation of n pairs, n > 2, against none.

    Student's t with n - 2 degrees of freedom exceeds what r gives with probability
    I(1 - r²; (n - 2) / 2, 1/2).
    """
    x = (1 - r) * (1 + r)
    return incomplete_beta((n - 2).cast("double") / 2, F.lit(0.5), x)
