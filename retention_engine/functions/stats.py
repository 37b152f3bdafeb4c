"""Small numeric helpers used inside Arrow-batched pandas UDFs (numpy only; no scipy).

They run on already-aggregated rows (one per group or per candidate), never on raw data.
"""
from __future__ import annotations

import math

import numpy as np


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, eps = 1e-300, 1e-15
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
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
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def beta_ppf(q: float, a: float, b: float) -> float:
    """Inverse of I_x(a, b) by bisection (monotone in x)."""
    lo, hi = 0.0, 1.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if betainc(a, b, mid) < q:
            lo = mid
        else:
            hi = mid
        if hi - lo < 1e-14:
            break
    return (lo + hi) / 2


def clopper_pearson(k: int, n: int, alpha: float = 0.05) -> tuple[float, float]:
    """Exact binomial CI: k = 0 → lower 0; k = n → upper 1; n = 0 → (nan, nan)."""
    if n == 0:
        return (float("nan"), float("nan"))
    lo = 0.0 if k == 0 else beta_ppf(alpha / 2, k, n - k + 1)
    hi = 1.0 if k == n else beta_ppf(1 - alpha / 2, k + 1, n - k)
    return (lo, hi)


def t_sf_two_sided(t: float, df: int) -> float:
    """Two-sided p-value of Student's t: I_{df/(df+t²)}(df/2, 1/2)."""
    if df <= 0 or math.isnan(t):
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def normal_sf_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def wilcoxon_zsplit(d: np.ndarray) -> tuple[float, float]:
    """Wilcoxon signed-rank statistic and normal-approximation p-value, zero differences split
    between the two rank sums (``zero_method='zsplit'``), tie correction on the variance."""
    d = np.asarray(d, dtype=float)
    n = d.size
    if n == 0:
        return (float("nan"), float("nan"))
    a = np.abs(d)
    order = np.argsort(a, kind="mergesort")
    ranks = np.empty(n)
    sa = a[order]
    i = 0
    while i < n:
        j = i
        while j + 1 < n and sa[j + 1] == sa[i]:
            j += 1
        ranks[order[i:j + 1]] = (i + j) / 2.0 + 1.0
        i = j + 1
    r_plus = ranks[d > 0].sum() + ranks[d == 0].sum() / 2.0
    r_minus = ranks[d < 0].sum() + ranks[d == 0].sum() / 2.0
    t = min(r_plus, r_minus)
    mn = n * (n + 1) / 4.0
    var = n * (n + 1) * (2 * n + 1) / 24.0
    _, counts = np.unique(a, return_counts=True)
    var -= (counts ** 3 - counts).sum() / 48.0
    if var <= 0:
        return (t, float("nan"))
    z = (t - mn) / math.sqrt(var)
    return (t, normal_sf_two_sided(z))
