"""Leading eigenvectors of a symmetric matrix: Householder tridiagonalisation,
bisection on Sturm counts, inverse iteration with reorthogonalisation inside
clusters of eigenvalues. The matrix has the size of a vector, not of a table."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
# Eigenvalues nearer than this share of the norm are one cluster.
CLUSTER = 1e-3
ITERATIONS = 12


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and reflectors ``v`` (unit; the matrix is Q T Q', Q the
    product of I - 2 v v' in order) of a symmetric matrix."""
    a = np.array(a, dtype=np.float64)
    n = len(a)
    reflectors: list[np.ndarray | None] = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            reflectors.append(None)
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        sub = a[k + 1 :, k + 1 :]
        p = sub @ x
        q = 2 * (p - (x @ p) * x)
        sub -= np.outer(x, q) + np.outer(q, x)
        tail = a[k + 1 :, k]
        tail -= 2 * (x @ tail) * x
        a[k, k + 1 :] = tail
        reflectors.append(x)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def back(reflectors: list[np.ndarray | None], vectors: np.ndarray) -> np.ndarray:
    """Rows ``vectors`` of the tridiagonal matrix as rows of the full one."""
    out = vectors.copy()
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        if v is not None:
            out[:, k + 1 :] -= 2 * np.outer(out[:, k + 1 :] @ v, v)
    return out


def counts_below(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each of ``x``."""
    tiny = EPS * EPS * max(1.0, float(np.max(e * e, initial=0.0)))
    n = np.zeros(len(x), dtype=np.int64)
    q = d[0] - x
    for i in range(len(d)):
        if i:
            q = d[i] - x - e[i - 1] ** 2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        n += q < 0
    return n


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection."""
    reach = np.r_[np.abs(e), 0.0] + np.r_[0.0, np.abs(e)]
    low, high = float(np.min(d - reach)), float(np.max(d + reach))
    margin = 4 * EPS * max(abs(low), abs(high)) + np.finfo(np.float64).tiny
    lo, hi = np.full(k, low - margin), np.full(k, high + margin)
    want = len(d) - 1 - np.arange(k)  # index from below of the j-th largest
    for _ in range(120):
        mid = (lo + hi) / 2
        below = counts_below(d, e, mid) > want
        lo, hi = np.where(below, lo, mid), np.where(below, mid, hi)
        if np.all(hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)) + margin * EPS):
            break
    return (lo + hi) / 2


class _Shifted:
    """LU factors with row exchanges of a tridiagonal matrix less a shift."""

    def __init__(self, d: np.ndarray, e: np.ndarray, shift: float, scale: float):
        n = len(d)
        self.n, least = n, EPS * scale
        diag, up, up2 = d - shift, np.r_[e, 0.0], np.zeros(n)
        self.swap, self.factor = np.zeros(n, dtype=bool), np.zeros(n)
        for i in range(n - 1):
            below = e[i]
            if abs(diag[i]) >= abs(below):
                if abs(diag[i]) < least:
                    diag[i] = least
                self.factor[i] = below / diag[i]
                diag[i + 1] -= self.factor[i] * up[i]
            else:
                self.swap[i] = True
                self.factor[i] = diag[i] / below
                next_diag, next_up = diag[i + 1], up[i + 1]
                diag[i], rest = below, up[i]
                up[i], up2[i] = next_diag, next_up
                diag[i + 1] = rest - self.factor[i] * next_diag
                up[i + 1] = -self.factor[i] * next_up
        if abs(diag[-1]) < least:
            diag[-1] = least
        self.diag, self.up, self.up2 = diag, up, up2

    def solve(self, b: np.ndarray) -> np.ndarray:
        x, n = b.copy(), self.n
        for i in range(n - 1):
            if self.swap[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= self.factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                x[i] -= self.up[i] * x[i + 1]
            if i + 2 < n:
                x[i] -= self.up2[i] * x[i + 2]
            x[i] /= self.diag[i]
        return x


def _apart(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for o in others:
            x = x - (o @ x) * o
    return x


def vectors_of(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of falling ``values`` by inverse iteration."""
    rng, found = np.random.default_rng(1), []
    scale = max(float(np.max(np.abs(values))), float(np.max(np.abs(d))), float(np.max(np.abs(e), initial=0.0)), np.finfo(np.float64).tiny)
    shift, first = np.inf, 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * scale:
            first = j
        # shifts of a cluster are kept a little apart, as equal ones give the same vector
        shift = value if j == first else min(value, shift - 10 * EPS * scale)
        factors, x = _Shifted(d, e, shift, scale), rng.standard_normal(len(d))
        x /= np.linalg.norm(x)
        steady = 0
        for _ in range(ITERATIONS):
            y = factors.solve(x)
            y = _apart(y / np.max(np.abs(y)), found[first:])
            size = np.linalg.norm(y)
            if size < 1e-8:  # nothing left beside the cluster: another start
                y = _apart(rng.standard_normal(len(d)), found[first:])
                size = np.linalg.norm(y)
            y = _apart(y / size, found[first:])
            y /= np.linalg.norm(y)
            steady = steady + 1 if abs(abs(x @ y) - 1) < 4 * EPS else 0
            x = y
            if steady == 2:
                break
        found.append(x)
    return np.array(found).reshape(len(values), len(d))


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit
    eigenvectors as rows, largest entry positive."""
    n = len(a)
    k = min(k, n)
    scale = float(np.max(np.abs(a), initial=0.0))
    if k == 0 or scale == 0:
        return np.zeros(k), np.eye(n)[:k]
    d, e, reflectors = tridiagonal(a / scale)
    values = leading_values(d, e, k)
    rows = back(reflectors, vectors_of(d, e, values))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    at = np.argmax(np.abs(rows), axis=1)
    rows *= np.sign(rows[np.arange(k), at])[:, None]
    return values * scale, rows
