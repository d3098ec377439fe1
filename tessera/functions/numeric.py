"""Scalar numeric expressions Spark has no built-in for."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the published rational approximation of the
# normal quantile function (Acklam, 2003), relative error below 1.15e-9.
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00)
_P_LOW = 0.02425


def _poly(coefs, x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def probit(p) -> Column:
    """Inverse standard normal CDF as a Column expression (nulls stay null)."""
    p = F.col(p) if isinstance(p, str) else p
    q_mid = p - F.lit(0.5)
    r_mid = q_mid * q_mid
    mid = _poly(_A, r_mid) * q_mid / (_poly(_B, r_mid) * r_mid + F.lit(1.0))
    q_lo = F.sqrt(F.lit(-2.0) * F.log(p))
    lo = _poly(_C, q_lo) / (_poly(_D, q_lo) * q_lo + F.lit(1.0))
    q_hi = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    hi = -_poly(_C, q_hi) / (_poly(_D, q_hi) * q_hi + F.lit(1.0))
    return (F.when(p < _P_LOW, lo)
            .when(p > 1 - _P_LOW, hi)
            .otherwise(mid))


def clip(x, lo, hi) -> Column:
    """x within [lo, hi]; missing stays missing (greatest and least skip nulls)."""
    x = F.col(x) if isinstance(x, str) else x
    lo, hi = (v if isinstance(v, Column) else F.lit(v) for v in (lo, hi))
    return F.when(x.isNotNull(), F.least(F.greatest(x, lo), hi))


def soft_clip(x, lo, hi) -> Column:
    """max(x, lo - ln(1+|x|)) then min(a, hi + ln(1+|a|)) on the clipped a."""
    x = F.col(x) if isinstance(x, str) else x
    lo = F.lit(float(lo)) if not isinstance(lo, Column) else lo
    hi = F.lit(float(hi)) if not isinstance(hi, Column) else hi
    a = F.greatest(x, lo - F.log1p(F.abs(x)))
    return F.least(a, hi + F.log1p(F.abs(a)))


NORMAL_CLIP = (1e-7, 1 - 1e-7)
SQRT2 = math.sqrt(2.0)
