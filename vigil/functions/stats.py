"""Distribution tails used by the drift and promotion operators.

All of them are Spark SQL expressions, so they stay in the JVM; loops are
higher-order ``aggregate`` calls over short sequences.

* The two-sample KS tail is exact for samples of up to ``EXACT_ROWS`` rows and
  Smirnov's asymptotic series beyond.
* The chi-square and normal tails are the incomplete gamma function: a power
  series on the left, a continued fraction on the right, both summed from the
  last term so that the state of the loop is one number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number of terms of the Smirnov series; the tail is set to 1 below LAMBDA_MIN
# where the alternating series converges too slowly to be useful.
SMIRNOV_TERMS = 100
LAMBDA_MIN = 0.2
#: The larger sample's most rows for which the KS tail is exact.
EXACT_ROWS = 10_000
#: Tails whose Smirnov series is below this stay as the series gives them.
NEGLIGIBLE = 1e-18
# Above this shape the chi-square tail comes from its normal limit, whose error is below 1e-6 there.
LARGE_SHAPE = 1e5


def smirnov_pvalue(d: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sample KS p-value ``2 * sum (-1)^(k-1) exp(-2 k^2 lam^2)``.

    ``lam = D * sqrt(n*m / (n+m))``; clamped to ``[0, 1]``; 1 for ``lam < 0.2``
    or when either side has fewer than two values.
    """
    en = F.try_divide(n_ref.cast("double") * n_cur, n_ref + n_cur)
    lam = F.sqrt(en) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(SMIRNOV_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    return F.when((n_ref < 2) | (n_cur < 2) | lam.isNull() | (lam < LAMBDA_MIN), F.lit(1.0)).otherwise(p)


def ks_exact_pvalue(d: Column, n_ref: Column, n_cur: Column) -> Column:
    """Exact two-sample KS p-value: the share of lattice paths that reach a gap of ``d``.

    Every order of the pooled rows is a path from (0, 0) to (n_ref, n_cur), all
    equally likely. ``q`` of a point is the share of the paths to it that have
    touched the bound ``|i / n_ref - j / n_cur| >= d``: 1 on or beyond the bound,
    else the mean of its two predecessors weighted by their coordinates. Points
    are visited by diagonals ``i + j = k`` and only between the bounds, so a
    step holds an array as long as the band is wide. No tail cancels: p-values
    keep their relative precision.
    """
    m, n = n_ref.cast("long"), n_cur.cast("long")
    bound = F.round(d * m * n).cast("long")  # gaps are multiples of 1 / (m * n)
    # |i * (m + n) - k * m| < bound between low(k) and high(k)
    low = lambda k: F.greatest(F.lit(0), k - n, F.floor((k * m - bound) / (m + n).cast("double")) + 1)
    high = lambda k: F.least(k, m, F.ceil((k * m + bound) / (m + n).cast("double")) - 1)

    def step(state: Column, k: Column) -> Column:
        before = state["q"]
        at = lambda i: F.coalesce(F.get(before, (i - state["low"]).cast("int")), F.lit(1.0))
        inside = F.when(
            low(k) <= high(k),
            F.transform(F.sequence(low(k), high(k)), lambda i: at(i - 1) * (i / k.cast("double")) + at(i) * ((k - i) / k.cast("double"))),
        ).otherwise(F.array().cast("array<double>"))
        return F.struct(low(k).alias("low"), inside.alias("q"))

    start = F.struct(F.lit(0).cast("long").alias("low"), F.array(F.lit(0.0)).alias("q"))
    path = F.aggregate(F.sequence(F.lit(1).cast("long"), m + n), start, step, lambda state: F.coalesce(F.get(state["q"], F.lit(0)), F.lit(1.0)))
    return F.when(bound <= 0, F.lit(1.0)).otherwise(path)


def ks_pvalue(d: Column, n_ref: Column, n_cur: Column, *, exact_rows: int = EXACT_ROWS) -> Column:
    """Two-sample KS p-value: exact up to ``exact_rows`` rows on the larger side, Smirnov's series beyond.

    An exact tail costs about ``sqrt(n * m * (n + m))`` steps at most, as tails
    that the series puts below ``NEGLIGIBLE`` aren't refined. 1 when a side has
    fewer than two values.
    """
    series = smirnov_pvalue(d, n_ref, n_cur)
    exact = (F.greatest(n_ref, n_cur) <= exact_rows) & (n_ref >= 2) & (n_cur >= 2) & (series >= NEGLIGIBLE)
    return F.when(exact, ks_exact_pvalue(d, n_ref, n_cur)).otherwise(series)


def _log_gamma(a: Column) -> Column:
    """log of gamma(a) for a > 0: Stirling's series at a + 20, stepped down."""
    b = a + 20.0
    r = F.lit(1.0) / (b * b)
    stirling = (b - 0.5) * F.log(b) - b + 0.5 * math.log(2 * math.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / b
    return stirling - F.aggregate(F.sequence(F.lit(0), F.lit(19)), F.lit(0.0), lambda s, i: s + F.log(a + i))


def gamma_q(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function Q(a, x) for a > 0 and finite x > 0."""
    front = F.exp(a * F.log(x) - x - _log_gamma(a))
    # terms fall off like a normal density of deviation sqrt(a)
    terms = (F.lit(100) + 20 * F.sqrt(a)).cast("int")
    down = F.sequence(terms, F.lit(1), F.lit(-1))
    series = F.aggregate(down, F.lit(1.0), lambda s, k: F.lit(1.0) + s * x / (a + k))
    fraction = F.aggregate(down, x + 2.0 * terms + 1.0 - a, lambda f, k: x + 2.0 * k - 1.0 - a - (a * -k + k * k.cast("double")) / f)
    return F.when(x < a + 1.0, F.greatest(F.lit(1.0) - front * series / a, F.lit(0.0))).otherwise(F.least(front / fraction, F.lit(1.0)))


def norm_sf(z: Column) -> Column:
    """Standard normal upper tail, as half the upper incomplete gamma function of shape 1/2."""
    half = F.lit(0.5) * gamma_q(F.lit(0.5), z * z / 2.0)
    infinite = F.abs(z) == float("inf")
    return (
        F.when(z.isNull() | F.isnan(z), F.lit(None).cast("double"))
        .when(infinite, F.when(z > 0, 0.0).otherwise(1.0))
        .when(z == 0, F.lit(0.5))
        .when(z > 0, half)
        .otherwise(1.0 - half)
    )


def chi2_sf(x: Column, dof: Column) -> Column:
    """Chi-square upper tail; NULL without a positive ``dof`` or a number ``x``."""
    x, a = x.cast("double") / 2.0, dof.cast("double") / 2.0
    # Wilson-Hilferty: the cube root of a gamma variate is nearly normal
    limit = (F.cbrt(x / a) - 1.0 + 1.0 / (9.0 * a)) * 3.0 * F.sqrt(a)
    return (
        F.when(x.isNull() | F.isnan(x) | dof.isNull() | (a <= 0), F.lit(None).cast("double"))
        .when(x <= 0, F.lit(1.0))
        .when(x == float("inf"), F.lit(0.0))
        .when(a > LARGE_SHAPE, norm_sf(limit))
        .otherwise(gamma_q(a, x))
    )


def safe_pvalue(p: Column) -> Column:
    """NULL / NaN -> 1.0, then clamp to ``[0, 1]``."""
    cleaned = F.coalesce(F.nanvl(p.cast("double"), F.lit(1.0)), F.lit(1.0))
    return F.least(F.greatest(cleaned, F.lit(0.0)), F.lit(1.0))


__all__ = [
    "chi2_sf",
    "gamma_q",
    "ks_exact_pvalue",
    "ks_pvalue",
    "norm_sf",
    "safe_pvalue",
    "smirnov_pvalue",
]
