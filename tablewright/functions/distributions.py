"""Small distribution functions for test statistics (no scipy at hand)."""

from __future__ import annotations

import math

import numpy as np


def normal_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _t_density(x: np.ndarray, df: float) -> np.ndarray:
    log_c = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
    return np.exp(log_c - (df + 1) / 2 * np.log1p(x * x / df))


def t_two_sided_p(t: float, df: float) -> float:
    """P(|T| > |t|), by Gauss-Legendre quadrature of the density over an angle."""
    if not math.isfinite(t) or df <= 0:
        return float("nan")
    nodes, weights = np.polynomial.legendre.leggauss(64)
    if df > 100:  # nearly normal: panels over the part of the tail that counts
        ends = abs(t) + np.linspace(0, 40, 17)
        half, mid = (ends[1:] - ends[:-1]) / 2, (ends[1:] + ends[:-1]) / 2
        x = mid[:, None] + half[:, None] * nodes
        return float(min(1.0, 2 * np.sum(half[:, None] * weights * _t_density(x, df))))
    # x = sqrt(df) * tan(a) maps the tail to a finite range with a smooth integrand.
    start = math.atan(abs(t) / math.sqrt(df))
    half = (math.pi / 2 - start) / 2
    a = start + half * (nodes + 1)
    x = math.sqrt(df) * np.tan(a)
    jac = math.sqrt(df) / np.cos(a) ** 2
    return float(min(1.0, 2 * half * np.sum(weights * _t_density(x, df) * jac)))


def t_quantile(p: float, df: float) -> float:
    """The t with P(T <= t) = p, for p > 0.5, by bisection."""
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        if 1 - t_two_sided_p(mid, df) / 2 < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2
