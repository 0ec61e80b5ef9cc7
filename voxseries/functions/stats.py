"""Statistics as column expressions, with the one distribution Spark lacks."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxseries.functions.numbers import clamp


def pearson(x: Column, y: Column, min_n: int = 3) -> Column:
    """Aggregate: Pearson r over complete pairs.

    Null below ``min_n`` pairs or when a column is constant (the built-in ``corr`` raises
    there under ANSI mode).
    """
    spread = F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))
    r = F.try_divide(F.regr_sxy(y, x), spread)
    return F.when(F.regr_count(y, x) >= min_n, clamp(r, -1.0, 1.0))


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function for z > 0: Stirling's series ten places on, brought back by the recurrence."""
    far = z + 10
    series = 1 / (12 * far) - 1 / (360 * far**3) + 1 / (1260 * far**5) - 1 / (1680 * far**7) + 1 / (1188 * far**9)
    steps = sum((F.log(z + i) for i in range(1, 10)), F.log(z))
    return series + (far - 0.5) * F.log(far) - far + 0.5 * math.log(2 * math.pi) - steps


def beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta integral, evaluated from its tail upward.

    The coefficients are d(2m) = m(b-m)x / ((a+2m-1)(a+2m)) and
    d(2m+1) = -(a+m)(a+b+m)x / ((a+2m)(a+2m+1)). The terms needed grow with the root of the larger shape parameter; they
    are one per step of ``aggregate``, so nothing is capped.
    """
    steps = (200 + 4 * F.sqrt(F.greatest(a, b))).cast("int")

    def up(value, j):
        m = F.floor(j / 2)
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        return 1 + F.when(j % 2 == 1, odd).otherwise(even) / value

    return 1 / F.aggregate(F.sequence(steps, F.lit(1)), F.lit(1.0), up)


def _log_scale(half: Column) -> Column:
    """Logarithm of Gamma(half + 1/2) / (Gamma(half) * Gamma(1/2)); large arguments by their own series, as the difference
    of two logarithms would lose their digits."""
    near = log_gamma(half + 0.5) - log_gamma(half)
    far = F.log(half) / 2 - 1 / (8 * half) + 1 / (192 * half**3) - 1 / (640 * half**5)
    return F.when(half > 50, far).otherwise(near) - 0.5 * math.log(math.pi)


def _beta_tail(a: Column, b: Column, x: Column, rest: Column, scale: Column) -> Column:
    """Regularised incomplete beta function where its fraction converges fast; ``rest`` is 1 - x."""
    front = scale + a * F.log1p(-rest) + b * F.log(rest) - F.log(a)
    return F.when(x > 0, F.exp(front) * beta_fraction(a, b, x)).otherwise(0.0)


def t_pvalue(t: Column, freedom: Column) -> Column:
    """Two-sided tail probability of Student's t, for any positive degrees of freedom, without leaving the JVM.

    Null where either is null, not a number or infinite, or where there are no degrees of freedom.
    """
    half, own = freedom / 2, F.lit(0.5)
    x, rest = freedom / (freedom + t * t), t * t / (freedom + t * t)
    flip = x > (half + 1) / (half + own + 2)
    scale = _log_scale(half)
    tail = F.when(flip, 1 - _beta_tail(own, half, rest, x, scale)).otherwise(_beta_tail(half, own, x, rest, scale))
    known = ~F.isnan(t) & ~F.isnan(freedom) & (F.abs(t) != float("inf")) & (freedom != float("inf")) & (freedom > 0)
    return F.when(known, F.when(t == 0, 1.0).otherwise(tail))
