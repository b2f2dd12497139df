"""Two-by-two association measures as column expressions."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import EPSILON


def prr(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Proportional reporting ratio, with the small terms that keep it defined."""
    eps = F.lit(EPSILON)
    return (a / (a + b + eps)) / (c / (c + d + eps) + eps)


def chi2_yates(a: Column, b: Column, c: Column, d: Column, clamp: bool = False) -> Column:
    """Continuity-corrected chi-square.

    Without ``clamp`` a difference smaller than the correction is squared all
    the same, which gives a small positive value where the textbook has 0.
    """
    n = a + b + c + d
    gap = F.abs(a * d - b * c) - n / 2
    if clamp:
        gap = F.greatest(gap, F.lit(0.0))
    return n * gap * gap / ((a + b) * (c + d) * (a + c) * (b + d) + F.lit(EPSILON))


def ror(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Reporting odds ratio, null where it is undefined."""
    return F.try_divide(a * d, b * c)


# --- fixed values: W. J. Cody, "Rational Chebyshev approximations for the error
# function", Math. Comp. 23 (1969). Highest power first. ---------------------------
_SMALL_NUM = (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2,
              3.77485237685302021e2, 3.20937758913846947e3)
_SMALL_DEN = (1.0, 2.36012909523441209e1, 2.44024637934444173e2,
              1.28261652607737228e3, 2.84423683343917062e3)
_MID_NUM = (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0,
            6.61191906371416295e1, 2.98635138197400131e2, 8.81952221241769090e2,
            1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3)
_MID_DEN = (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2,
            1.62138957456669019e3, 3.29079923573345963e3, 4.36261909014324716e3,
            3.43936767414372164e3, 1.23033935480374942e3)
_TAIL_NUM = (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1,
             1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4)
_TAIL_DEN = (1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1,
             6.05183413124413191e-2, 2.33520497626869185e-3)
_ONE_OVER_SQRT_PI = 0.5641895835477563


def _horner(coefs, x: Column) -> Column:
    return functools.reduce(lambda acc, k: acc * x + F.lit(k), coefs[1:], F.lit(coefs[0]))


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0, inside generated code (no UDF)."""
    sq = x * x
    small = F.lit(1.0) - x * _horner(_SMALL_NUM, sq) / _horner(_SMALL_DEN, sq)
    mid = F.exp(-sq) * _horner(_MID_NUM, x) / _horner(_MID_DEN, x)
    safe = F.greatest(x, F.lit(1.0))
    inv = F.lit(1.0) / (safe * safe)
    tail = (
        F.exp(-sq) / safe
        * (F.lit(_ONE_OVER_SQRT_PI) - inv * _horner(_TAIL_NUM, inv) / _horner(_TAIL_DEN, inv))
    )
    return F.when(x <= 0.46875, small).when(x <= 4.0, mid).otherwise(tail)


def chi2_p_value(chi2: Column) -> Column:
    """Upper tail of chi-square with one degree of freedom."""
    return erfc(F.sqrt(F.greatest(chi2, F.lit(0.0)) / 2))


#: Terms of the asymptotic series of digamma in 1/x squared: Bernoulli numbers over their (even) index, highest first.
_DIGAMMA = (-1 / 12, 691 / 32760, -1 / 132, 1 / 240, -1 / 252, 1 / 120, -1 / 12)
_DIGAMMA_SHIFT = 6


def digamma(x: Column) -> Column:
    """The logarithmic derivative of the gamma function for x >= 1, inside generated code."""
    below = functools.reduce(Column.__add__, [F.lit(1.0) / (x + i) for i in range(_DIGAMMA_SHIFT)])
    big = x + float(_DIGAMMA_SHIFT)
    inv = F.lit(1.0) / (big * big)
    return F.log(big) - F.lit(0.5) / big + inv * _horner(_DIGAMMA, inv) - below
