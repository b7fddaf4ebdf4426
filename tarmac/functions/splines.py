"""Natural cubic spline basis (no intercept) for a small set of values.

Used to turn the hour of day (24 values) into a broadcastable lookup table;
the knots come from train quantiles computed on Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def _bspline(x: np.ndarray, t: np.ndarray, order: int, deriv: int = 0) -> np.ndarray:
    """B-spline basis (columns = len(t) - order) or its ``deriv``-th derivative."""
    if deriv > 0:
        lower = _bspline(x, t, order - 1, deriv - 1)
        n = len(t) - order
        out = np.zeros((len(x), n))
        for i in range(n):
            d1 = t[i + order - 1] - t[i]
            d2 = t[i + order] - t[i + 1]
            a = lower[:, i] / d1 if d1 > 0 else 0.0
            b = lower[:, i + 1] / d2 if d2 > 0 else 0.0
            out[:, i] = (order - 1) * (a - b)
        return out
    m = len(t) - 1
    b = np.zeros((len(x), m))
    for i in range(m):
        if t[i] < t[i + 1]:
            b[:, i] = (x >= t[i]) & (x < t[i + 1])
    last = max(i for i in range(m) if t[i] < t[i + 1])
    b[x == t[-1], last] = 1.0          # right boundary belongs to the last span
    for k in range(2, order + 1):
        nb = np.zeros((len(x), len(t) - k))
        for i in range(len(t) - k):
            d1 = t[i + k - 1] - t[i]
            d2 = t[i + k] - t[i + 1]
            left = (x - t[i]) / d1 * b[:, i] if d1 > 0 else 0.0
            right = (t[i + k] - x) / d2 * b[:, i + 1] if d2 > 0 else 0.0
            nb[:, i] = left + right
        b = nb
    return b


def natural_spline_basis(x: Sequence[float], knots: Sequence[float],
                         boundary: tuple[float, float]) -> np.ndarray:
    """Rows of the natural spline basis at ``x`` (linear beyond the boundary)."""
    x = np.asarray(x, dtype=float)
    lb, ub = float(boundary[0]), float(boundary[1])
    t = np.sort(np.concatenate([[lb] * 4, np.asarray(knots, float), [ub] * 4]))
    basis = np.zeros((len(x), len(t) - 4))
    inside = (x >= lb) & (x <= ub)
    if inside.any():
        basis[inside] = _bspline(x[inside], t, 4)
    for side, mask in ((lb, x < lb), (ub, x > ub)):
        if mask.any():
            piv = np.array([side])
            v0, v1 = _bspline(piv, t, 4), _bspline(piv, t, 4, 1)
            basis[mask] = v0 + (x[mask] - side)[:, None] * v1
    const = _bspline(np.array([lb, ub]), t, 4, 2)
    basis, const = basis[:, 1:], const[:, 1:]
    q, _ = np.linalg.qr(const.T, mode="complete")
    return (q.T @ basis.T).T[:, 2:]
