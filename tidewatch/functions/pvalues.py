"""p-value finishes for the drift tests.

The normal tail and Kolmogorov's limit distribution are Spark expressions, so
the drift report is one plan without Python.  The exact distribution of the KS
statistic (an explicit method) and the chi-square tail run on one row per
feature; only ``math``/``numpy`` are used (no scipy in the runtime).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Terms of the positive series of the error function, enough for any z that
# is cut off at NORMAL_MAX (beyond it the tail is below 1e-16).
ERF_TERMS, NORMAL_MAX = 160, 8.3


def normal_pvalue(z: Column) -> Column:
    """Two-sided tail of the standard normal distribution beyond ``z`` >= 0,
    clipped to [0, 1]: 1 - erf(x), x = z / sqrt(2), with erf(x) = 2 / sqrt(pi)
    exp(-x^2) sum 2^n x^(2n+1) / (2n+1)!!, whose terms are all positive."""
    x = F.least(F.greatest(z, F.lit(0.0)), F.lit(NORMAL_MAX)) / F.lit(math.sqrt(2.0))
    start = F.struct(x.alias("term"), x.alias("total"))
    step = lambda a, n: F.struct((a["term"] * 2 * x * x / (2 * n + 1)).alias("term"),
                                 (a["total"] + a["term"] * 2 * x * x / (2 * n + 1)).alias("total"))
    erf = F.aggregate(F.sequence(F.lit(1), F.lit(ERF_TERMS)), start, step,
                      lambda a: a["total"] * F.exp(-x * x) * F.lit(2.0 / math.sqrt(math.pi)))
    return F.when(z >= NORMAL_MAX, F.lit(0.0)).when(z.isNotNull(), F.least(F.greatest(1.0 - erf, F.lit(0.0)), F.lit(1.0)))


def chi2_pvalue(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution with a whole number of degrees
    of freedom, as its finite series: with h = x / 2, exp(-h) sum h^i / i! over
    i < dof / 2 if that is even, else the normal tail of sqrt(x) plus exp(-h)
    sum h^(i - 1/2) / Gamma(i + 1/2) over 1 <= i <= (dof - 1) / 2.  1 without
    degrees of freedom."""
    h, odd = x / 2.0, dof % 2 == 1
    first = F.when(odd, F.sqrt(h) / F.lit(math.gamma(1.5))).otherwise(F.lit(1.0))
    terms = F.floor(dof / 2).cast("int")
    step = lambda a, i: F.struct((a["term"] * h / (i + F.when(odd, 0.5).otherwise(0.0))).alias("term"),
                                 (a["total"] + a["term"]).alias("total"))
    # Each step adds the term of the one before and makes the next.
    series = F.aggregate(F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>")),
                         F.struct(first.alias("term"), F.lit(0.0).alias("total")),
                         step, lambda a: a["total"])
    tail = F.exp(-h) * series + F.when(odd, normal_pvalue(F.sqrt(x))).otherwise(0.0)
    return F.when(x.isNotNull() & dof.isNotNull(), F.when((dof <= 0) | (x <= 0), F.lit(1.0)).otherwise(
        F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0))))


def kolmogorov_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """Two-sided p of the two-sample KS statistic in Kolmogorov's limit: below
    z = 1 by the theta-function dual of the alternating series."""
    n1, n2 = n1.cast("double"), n2.cast("double")
    z = d * F.sqrt(F.try_divide(n1 * n2, n1 + n2))
    low = sum((F.exp(-F.pow(F.lit((2 * k - 1) * math.pi) / z, 2) / 8) for k in range(1, 6)), F.lit(0.0))
    high = sum((F.lit((-1.0) ** (k - 1)) * F.exp(-2 * F.pow(k * z, 2)) for k in range(1, 8)), F.lit(0.0))
    p = F.when(z <= 0, F.lit(1.0)).when(z < 1, 1.0 - F.lit(math.sqrt(2 * math.pi)) / z * low).otherwise(2 * high)
    return F.when(z.isNotNull(), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


# method="auto": observations per side up to which the exact distribution is
# computed (the usual switch point of statistics packages).
KS_EXACT_MAX_N = 10000


def ks_2samp_pvalue(d: float, n1: int, n2: int, method: str = "auto") -> float:
    """Two-sided p of the two-sample KS statistic ``d``.

    Exact: fraction of monotone lattice paths from (0,0) to (n1,n2) that
    leave the band ``|i*n2 - j*n1| < h*g``; computed as a probability
    recursion along anti-diagonals (values stay in [0,1], no overflow).
    ``method``: "exact", "asymptotic" (Kolmogorov's limit) or "auto", which
    is exact up to KS_EXACT_MAX_N observations per side."""
    if method not in ("auto", "exact", "asymptotic"):
        raise ValueError(f"unknown method {method!r}")
    if d is None or n1 is None or n2 is None or n1 <= 0 or n2 <= 0:
        return float("nan")
    n1, n2 = int(n1), int(n2)
    g = math.gcd(n1, n2)
    lcm = (n1 // g) * n2
    h = int(round(d * lcm))
    if h == 0:
        return 1.0
    if method == "asymptotic" or method == "auto" and max(n1, n2) > KS_EXACT_MAX_N:
        en = n1 * n2 / (n1 + n2)
        z = (h / lcm) * math.sqrt(en)
        return float(min(1.0, max(0.0, _kolmogorov_sf(z))))
    bound = h * g
    i_idx = np.arange(n1 + 1)
    prev = np.zeros(n1 + 1)
    prev[0] = 1.0
    for s in range(1, n1 + n2 + 1):
        j = s - i_idx
        valid = (j >= 0) & (j <= n2)
        cur = np.zeros(n1 + 1)
        # from (i-1, j): weight i/s ; from (i, j-1): weight j/s
        cur[1:] += prev[:-1] * (i_idx[1:] / s)
        cur += prev * (np.clip(j, 0, None) / s)
        inside = np.abs(i_idx * n2 - j * n1) < bound
        cur = np.where(valid & inside, cur, 0.0)
        prev = cur
    p = 1.0 - prev[n1]
    return float(min(1.0, max(0.0, p)))


def _kolmogorov_sf(z: float) -> float:
    """Upper tail of Kolmogorov's distribution.  Below z = 1 the alternating
    series is slow, so its theta-function dual is summed there; either needs
    a few terms only."""
    if z <= 0:
        return 1.0
    if z < 1.0:
        terms = (math.exp(-((2 * k - 1) * math.pi / z) ** 2 / 8) for k in range(1, 6))
        return 1.0 - math.sqrt(2 * math.pi) / z * sum(terms)
    return 2 * sum((-1) ** (k - 1) * math.exp(-2 * (k * z) ** 2) for k in range(1, 8))


def normal_two_sided(z: float) -> float:
    """``2 * sf(z)`` clipped to [0, 1] (``z`` already >= 0 by construction)."""
    if z is None or (isinstance(z, float) and math.isnan(z)):
        return float("nan")
    return float(min(1.0, max(0.0, math.erfc(z / math.sqrt(2.0)))))


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution = Q(dof/2, x/2)."""
    if x is None or dof is None or dof <= 0:
        return 1.0
    return float(_gammaincc(dof / 2.0, x / 2.0))


def _gammaincc(a: float, x: float) -> float:
    if x <= 0:
        return 1.0
    lg = math.lgamma(a)
    if x < a + 1:
        # series for P(a, x)
        term = 1.0 / a
        total = term
        ap = a
        for _ in range(100000):
            ap += 1
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        else:
            raise ArithmeticError("the incomplete gamma series did not converge")
        return max(0.0, 1.0 - total * math.exp(-x + a * math.log(x) - lg))
    # continued fraction for Q(a, x) (modified Lentz)
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    f = d
    for i in range(1, 100000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        delta = d * c
        f *= delta
        if abs(delta - 1) < 1e-15:
            break
    else:
        raise ArithmeticError("the incomplete gamma fraction did not converge")
    return math.exp(-x + a * math.log(x) - lg) * f


def ks_pvalue_udf(method: str):
    """Arrow UDF (statistic, n1, n2) -> p by :func:`ks_2samp_pvalue`."""
    @F.pandas_udf(DoubleType())
    def ks_pvalue(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        return pd.Series([ks_2samp_pvalue(a, b, c, method) if pd.notna(a) else None
                          for a, b, c in zip(d, n1, n2)], dtype="float64")
    return ks_pvalue
