"""Singular values and right singular vectors of a small matrix by way of its bidiagonal form.

Householder reflections reduce the matrix to an upper bidiagonal B. The squared entries of B are a
qd array, whose differential transforms with shifts (dqds) drop off one squared singular value
after the other without subtracting. A vector comes from a twisted factorisation of B'B minus its
value: the stationary transform from the top and the progressive one from the bottom meet where
their residual is least.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(np.float64).eps)
TINY = float(np.finfo(np.float64).tiny)
#: Vectors of values nearer than this share of the largest are made orthogonal to each other.
CLUSTER = 1e-3


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit ``v`` and ``alpha`` with ``x - 2 v (v'x) = alpha e1``."""
    scale = float(np.abs(x).max(initial=0.0))
    v = x / scale if scale else x.copy()
    size = float(np.sqrt((v * v).sum()))
    if not size:
        return np.zeros_like(x), 0.0
    alpha = -math.copysign(size, v[0])
    v = v.copy()
    v[0] -= alpha
    return v / np.sqrt((v * v).sum()), alpha * scale


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of ``U'rP``, and the orthogonal ``P``."""
    a = np.array(r, dtype=np.float64)
    d = a.shape[1]
    p = np.eye(d)
    diagonal, upper = np.zeros(d), np.zeros(max(d - 1, 0))
    for k in range(d):
        v, diagonal[k] = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 1:
            v, upper[k] = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return diagonal, upper, p


# ---------------------------------------------------------------- dqds


def _transform(q: list[float], e: list[float], shift: float):
    """One dqds step: the new arrays, or None and whether only the last value went below zero."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None, False, d
        new_q[i] = d + e[i]
        if new_q[i] > TINY:
            ratio = q[i + 1] / new_q[i]
            new_e[i] = e[i] * ratio
            d = d * ratio - shift
        else:  # a zero row: the rest starts anew
            new_e[i] = 0.0
            d = q[i + 1] - shift
    new_q[-1] = d
    return (None, True, d) if d < 0 else ((new_q, new_e), True, d)


def _smaller_value(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last two rows: a guess of the least one of all."""
    a, b, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), e[-1], q[-1]
    # [[a, s], [s, b + c]] with s*s = q[-2] * e[-1], of determinant a*c + (a - q[-2])*b.
    trace, determinant = a + b + c, a * c + (a - q[-2]) * b
    root = math.sqrt(max(trace * trace / 4 - determinant, 0.0))
    return determinant / (trace / 2 + root) if trace > 0 else 0.0


def qd_values(q: list[float], e: list[float], sigma: float = 0.0) -> list[float]:
    """All eigenvalues of the matrix a qd array stands for, plus ``sigma``; in no order."""
    found: list[float] = []
    todo = [(list(q), list(e), sigma)]
    while todo:
        q, e, sigma = todo.pop()
        while len(q) > 1:
            limit = EPS * EPS * (sigma + max(q))
            cut = next(
                (i for i in range(len(e) - 1, -1, -1)
                 if e[i] <= max(EPS * EPS * (sigma + q[i + 1]), limit * EPS)),
                None,
            )
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1]:  # the small end belongs to the bottom
                q.reverse()
                e.reverse()
            shift = min(_smaller_value(q, e), min(q))
            while True:
                step, late, rest = _transform(q, e, shift)
                if step is not None:
                    break
                shift = max(shift + rest, 0.0) if late and shift + rest > 0 else shift / 4
                if shift <= EPS * EPS * min(q):
                    shift = 0.0
            q, e = step
            sigma += shift
        found.extend(sigma + value for value in q)
    return found


# ---------------------------------------------------------------- twisted factorisation


def _safe(value: float, scale: float) -> float:
    return value if abs(value) > EPS * EPS * scale else math.copysign(EPS * EPS * scale + TINY, value)


def _twisted(q: np.ndarray, e: np.ndarray, off: np.ndarray, value: float, scale: float):
    """Both factorisations of B'B - value: pivots from the top, from the bottom, and residuals."""
    n = len(q)
    s, p = np.empty(n), np.empty(n)
    top, bottom = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    s[0], p[-1] = -value, q[-1] - value
    for i in range(n - 1):
        top[i] = _safe(q[i] + s[i], scale)
        s[i + 1] = e[i] * s[i] / top[i] - value
    for i in range(n - 2, -1, -1):
        bottom[i] = _safe(e[i] + p[i + 1], scale)
        p[i] = p[i + 1] * q[i] / bottom[i] - value
    return top, bottom, s + p + value


def _vector_at(k: int, off: np.ndarray, top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    n = len(off) + 1
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -off[i] / top[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -off[i] / bottom[i] * z[i]
        if abs(z[i + 1]) > 1e150:
            z /= abs(z[i + 1])
    return z / np.sqrt((z * z).sum())


def right_vectors(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Squares of the ``count`` largest singular values of ``r``, their right vectors (columns),
    and the sum of all squares. Values that rounding cannot tell from zero are left out."""
    r = np.asarray(r, dtype=np.float64)
    d = r.shape[1]
    total = float((r * r).sum())
    if not d or not total:
        return np.zeros(0), np.zeros((d, 0)), total
    scale = float(np.abs(r).max())
    diagonal, upper, p = bidiagonalised(r / scale)
    q, e, off = diagonal**2, upper**2, diagonal[:-1] * upper
    values = sorted(qd_values(q.tolist(), e.tolist()), reverse=True)
    values = [v for v in values[:count] if v > (d * EPS) ** 2 * values[0] * 100]
    tridiagonal = np.diag(q + np.append(0.0, e)) + np.diag(off, 1) + np.diag(off, -1)
    vectors: list[np.ndarray] = []
    for value in values:
        near = [z for z, v in zip(vectors, values, strict=False) if v - value <= CLUSTER * values[0]]
        top, bottom, residual = _twisted(q, e, off, value, values[0])
        best, best_rest = None, math.inf
        for k in np.argsort(np.abs(residual), kind="stable"):
            z = _vector_at(int(k), off, top, bottom)
            for _ in range(2):
                for other in near:
                    z = z - (other @ z) * other
            size = float(np.sqrt((z * z).sum()))
            if size < 1e-2:  # it lay in the span of the others
                continue
            z /= size
            rest = float(np.abs(tridiagonal @ z - value * z).max())
            if rest < best_rest:
                best, best_rest = z, rest
            if rest <= 8 * d * EPS * values[0]:
                break
        vectors.append(best)
    columns = p @ np.stack(vectors, axis=1)
    return np.array(values) * scale * scale, columns / np.sqrt((columns**2).sum(0)), total
