"""Leading eigenpairs of a small symmetric matrix: tridiagonal form, bisection, inverse iteration.

The matrix has one row and column per dimension of a vector, whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of the tridiagonal matrix that Householder reflections turn ``a`` into.

    Reflector k is a unit vector over the places after k, or empty where nothing had to be reflected.
    """
    a = a.copy()
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        column = a[k + 1 :, k]
        length = np.linalg.norm(column)
        v = column.copy()
        v[0] += length if v[0] >= 0 else -length
        size = np.linalg.norm(v)
        if np.linalg.norm(column[1:]) == 0 or size == 0:
            reflectors.append(np.empty(0))
            continue
        v /= size
        reflectors.append(v)
        rest = a[k + 1 :, k + 1 :]
        w = rest @ v
        w -= v * (v @ w)
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = -length if column[0] >= 0 else length
        a[k + 2 :, k] = a[k, k + 2 :] = 0
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value of ``at`` the number of eigenvalues below it, by the signs of the Sturm sequence."""
    square = np.concatenate([[0.0], off * off])
    least = np.finfo(float).tiny / EPS + EPS * np.abs(off).max(initial=0) ** 2 * EPS
    below = np.zeros(len(at), int)
    q = np.ones(len(at))
    for d, s in zip(diagonal, square, strict=True):
        q = d - at - s / q
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues of a tridiagonal matrix, falling, each bisected until no double lies between its bounds."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    margin = 4 * EPS * np.abs(diagonal).max(initial=0) + 4 * np.finfo(float).tiny
    low = np.full(k, (diagonal - reach).min() - margin)
    high = np.full(k, (diagonal + reach).max() + margin)
    rank = n - 1 - np.arange(k)  # so many eigenvalues are smaller
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        above = count_below(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)


class _Shifted:
    """The tridiagonal matrix minus a shift, as LU with partial pivoting; pivots that vanish are replaced by ``tiny``."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, shift: float, tiny: float):
        n = len(diagonal)
        self.main, self.upper, self.second = diagonal - shift, np.append(off, 0.0), np.zeros(n)
        self.factor, self.swapped = np.zeros(n), np.zeros(n, bool)
        lower = off.copy()
        for i in range(n - 1):
            if abs(lower[i]) > abs(self.main[i]):
                self.swapped[i] = True
                self.main[i], lower[i] = lower[i], self.main[i]
                self.upper[i], self.main[i + 1] = self.main[i + 1], self.upper[i]
                self.second[i], self.upper[i + 1] = self.upper[i + 1], 0.0
            if self.main[i] == 0:
                self.main[i] = tiny
            self.factor[i] = lower[i] / self.main[i]
            self.main[i + 1] -= self.factor[i] * self.upper[i]
            self.upper[i + 1] -= self.factor[i] * self.second[i]
        self.main = np.where(np.abs(self.main) < tiny, tiny, self.main)

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b.copy()
        n = len(x)
        for i in range(n - 1):
            if self.swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= self.factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            later = self.upper[i] * x[i + 1] if i + 1 < n else 0.0
            later += self.second[i] * x[i + 2] if i + 2 < n else 0.0
            x[i] = (x[i] - later) / self.main[i]
        return x


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Unit eigenvectors as columns, by inverse iteration; those of close eigenvalues are made orthogonal in every round.

    A cluster is a run of values each of which is close to the one before; shifts in it are spread by a few roundings, so that
    equal values still give different systems.
    """
    n, norm = len(diagonal), max(np.abs(diagonal).max(initial=0) + 2 * np.abs(off).max(initial=0), np.finfo(float).tiny)
    start = np.random.default_rng(n)
    out = np.zeros((n, len(values)))
    first, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        shift = min(value, shift - 2 * EPS * norm) if k > first else value
        system = _Shifted(diagonal, off, shift, EPS * norm)
        cluster = out[:, first:k]
        x = start.uniform(-1, 1, n)
        for _ in range(rounds):
            for _ in range(2):  # twice: the first pass leaves roundings of what it removed
                x -= cluster @ (cluster.T @ x)
            x /= np.abs(x).max()
            x = system.solve(x)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= cluster @ (cluster.T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def leading_pairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    scale = np.abs(a).max(initial=0) or 1.0
    diagonal, off, reflectors = tridiagonal(a / scale)
    values = leading_values(diagonal, off, k)
    vectors = tridiagonal_vectors(diagonal, off, values)
    for i in range(len(reflectors) - 1, -1, -1):
        if len(v := reflectors[i]):
            vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    return values * scale, vectors
