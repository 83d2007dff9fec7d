"""Tail probabilities for regression inference (driver-side scalars; no SciPy).

The regularized incomplete beta I_x(a, b) is evaluated by its continued
fraction (modified Lentz); Student-t and F tails follow from it.
"""

from __future__ import annotations

import math


def _betacf(a: float, b: float, x: float) -> float:
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value P(|T| > |t|) for Student's t with df degrees of freedom."""
    if not math.isfinite(t):
        return 0.0
    if df <= 0:
        return float("nan")
    return betainc(df / 2, 0.5, df / (df + t * t))


def norm_sf2(z: float) -> float:
    """Two-sided normal p-value."""
    return math.erfc(abs(z) / math.sqrt(2))


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F > f) for the F distribution."""
    if f <= 0:
        return 1.0
    return betainc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def t_ppf(q: float, df: float) -> float:
    """Quantile of Student's t (bisection on the two-sided tail)."""
    if q == 0.5:
        return 0.0
    target = 2 * (1 - q) if q > 0.5 else 2 * q
    lo, hi = 0.0, 1.0
    while t_sf2(hi, df) > target:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if t_sf2(mid, df) > target:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2 if q > 0.5 else -(lo + hi) / 2


def norm_ppf(q: float) -> float:
    lo, hi = -40.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if 0.5 * math.erfc(-mid / math.sqrt(2)) < q:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2
