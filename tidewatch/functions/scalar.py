"""Scalar column expressions.  All are built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical results.
RATIO_EPS = 1e-9
LABEL_FEAR = "fear"
LABEL_STABLE = "stable"
LABEL_GREED = "greed"
SENTIMENT_LABELS = ("stable", "fear", "greed")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_change(current: str | Column, previous: str | Column) -> Column:
    """``(x_t / x_{t-1} - 1) * 100``; a zero or missing base gives NULL."""
    return (F.try_divide(_c(current), _c(previous)) - F.lit(1.0)) * F.lit(100.0)


def safe_ratio(a: str | Column, b: str | Column, strict: bool = True) -> Column:
    """``a / (b + eps)``.  strict: a zero denominator becomes NULL first;
    loose: the zero stays and the ratio is huge (no ANSI error either way)."""
    den = _c(b).cast("double")
    if strict:
        den = F.nullif(den, F.lit(0.0))
    return F.try_divide(_c(a).cast("double"), den + F.lit(RATIO_EPS))


def threshold_label(value: str | Column, mu: Column, sigma: Column) -> Column:
    """fear above mu+sigma, greed below mu-sigma, stable otherwise, NULL for NULL
    (strict inequalities, so a value exactly on a boundary is stable)."""
    v = _c(value)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(v > mu + sigma, F.lit(LABEL_FEAR))
            .when(v < mu - sigma, F.lit(LABEL_GREED))
            .otherwise(F.lit(LABEL_STABLE)))


def clip(c: str | Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(_c(c), F.lit(lo)), F.lit(hi))


def pct_shift(cur: str | Column, ref: str | Column) -> Column:
    """Percent change of ``cur`` against ``ref``; NULL when ref is 0."""
    return F.try_divide(_c(cur) - _c(ref), _c(ref)) * F.lit(100.0)


def neg_log10(p: str | Column) -> Column:
    return -F.log10(_c(p))


def width_bin(value: str | Column, lo: Column, hi: Column, n_bins: int) -> Column:
    """1-based equal-width bin with the last bin closed on the right
    (``width_bucket`` puts the maximum into bin n+1; we clamp it to n).
    A zero-width range puts everything in bin 1."""
    v = _c(value)
    raw = F.when(hi > lo, F.width_bucket(v, lo, hi, F.lit(n_bins))).otherwise(F.lit(1))
    return F.when(v.isNull(), F.lit(None)).otherwise(F.least(F.greatest(raw, F.lit(1)),
                                                              F.lit(n_bins)))
