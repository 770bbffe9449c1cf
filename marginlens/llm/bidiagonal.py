"""Singular values and right singular vectors of a triangular factor.

Householder bidiagonalisation, the differential quotient-difference algorithm
with shifts (dqds) for the singular values to high relative accuracy, and
twisted factorisations for the vectors. Vectors of close singular values are
found as a group: inverse iteration through the twisted factors from a common
orthonormal start, then one-sided Jacobi rotations inside the group.

Sizes are those of the vectors' dimension, never of the data.
"""
from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny / EPS
#: Values closer than this (relative) get their vectors as a group.
CLOSE = 1e-3
#: Share of the largest square under which a square counts as zero.
RANK = 1e-20
#: Relative distance of the shift from a group's values in the last iterations.
BESIDE = 1e-5


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a, b, w`` with ``r = u @ B @ w.T``: B has diagonal ``a`` and superdiagonal ``b``."""
    m = np.array(r, float)
    n = m.shape[0]
    w = np.eye(n)

    def reflector(x):
        """``v, beta`` so that ``(I - beta v v') x`` is zero below its first entry."""
        scale = np.abs(x).max(initial=0.0)
        if scale == 0.0:
            return None
        v = x / scale
        norm = np.sqrt(v @ v)
        v[0] += np.copysign(norm, v[0])
        return v, 2.0 / (v @ v)

    for k in range(n):
        left = reflector(m[k:, k].copy())
        if left:
            v, beta = left
            m[k:, k:] -= np.outer(beta * v, v @ m[k:, k:])
        if k < n - 2:
            right = reflector(m[k, k + 1:].copy())
            if right:
                v, beta = right
                m[k:, k + 1:] -= np.outer(m[k:, k + 1:] @ v, beta * v)
                w[:, k + 1:] -= np.outer(w[:, k + 1:] @ v, beta * v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), w


def _dqds_step(q: np.ndarray, e: np.ndarray, shift: float):
    """One transform; None when the shift is above the least eigenvalue."""
    n = len(q)
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    for k in range(n - 1):
        if d < 0:
            return None
        new_q[k] = d + e[k]
        t = q[k + 1] / new_q[k] if new_q[k] > 0 else 1.0
        new_e[k] = e[k] * t
        d = d * t - shift
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal (a, b), falling (dqds)."""
    n = len(a)
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if n == 0 or scale == 0.0:
        return np.zeros(n)
    done: list[float] = []
    todo = [((a / scale) ** 2, (b / scale) ** 2, 0.0)]  # segments with their accumulated shift
    while todo:
        q, e, moved = todo.pop()
        while True:
            n = len(q)
            if n == 1:
                done.append(q[0] + moved)
                break
            small = e <= (EPS * EPS) * (np.minimum(q[:-1], q[1:]) + moved) + TINY
            if small[-1]:  # the last value has converged
                done.append(q[-1] + moved)
                q, e = q[:-1], e[:-1]
                continue
            if small.any():  # two separate segments
                cut = int(np.flatnonzero(small)[-1]) + 1
                todo.append((q[:cut], e[:cut - 1], moved))
                q, e = q[cut:], e[cut:]
                continue
            if 1.5 * q[0] < q[-1]:  # large values first, so that the small ones converge at the end
                q, e = q[::-1].copy(), e[::-1].copy()
            # the smaller eigenvalue of the last two rows is an upper bound of the least one
            last = q[-1]
            half = (q[-2] + e[-1] + last) / 2
            low = q[-2] * last / (half + np.sqrt(max(half * half - q[-2] * last, 0.0)))
            shift, step = 0.98 * min(low, q.min()), None
            for _ in range(6):
                step = _dqds_step(q, e, shift)
                if step or shift == 0.0:
                    break
                shift *= 0.25
            if step is None:
                shift, step = 0.0, _dqds_step(q, e, 0.0)
            q, e = step
            moved += shift
    return np.sort(np.array(done))[::-1] * scale * scale


class Twisted:
    """``L D L' - value I`` of ``B'B = L D L'``, factored from both ends and
    joined where the pivot is least."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = len(a)
        floor = TINY + EPS * EPS * max(value, float(np.max(a * a, initial=0.0)))
        d, off = a * a, a[:-1] * b
        safe = np.where(a[:-1] != 0, a[:-1], np.sqrt(floor))
        low = b / safe
        pad = lambda x: x if abs(x) > floor else floor
        self.down, self.up = np.zeros(n), np.zeros(n)
        s, p = np.zeros(n), np.zeros(n)
        s[0] = -value
        down_pivot, up_pivot = np.zeros(n), np.zeros(n)
        for i in range(n - 1):
            down_pivot[i] = pad(s[i] + d[i])
            self.down[i] = off[i] / down_pivot[i]
            s[i + 1] = self.down[i] * low[i] * s[i] - value
        down_pivot[n - 1] = s[n - 1] + d[n - 1]
        p[n - 1] = d[n - 1] - value
        for i in range(n - 2, -1, -1):
            up_pivot[i + 1] = pad(d[i] * low[i] ** 2 + p[i + 1])
            self.up[i] = off[i] / up_pivot[i + 1]
            p[i] = p[i + 1] * d[i] / up_pivot[i + 1] - value
        gamma = s + p + value
        self.at = int(np.argmin(np.abs(gamma)))
        self.pivot = np.where(np.arange(n) < self.at, down_pivot, up_pivot)
        self.pivot[self.at] = pad(gamma[self.at])

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.pivot))
        z[self.at] = 1.0
        return _unit(self._outwards(z))

    def _outwards(self, z: np.ndarray) -> np.ndarray:
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.down[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] -= self.up[i] * z[i]
        return z

    def solve(self, x: np.ndarray) -> np.ndarray:
        """A vector along the solution of ``(L D L' - value I) y = x``."""
        y = x.copy()
        for i in range(self.at):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(len(y) - 1, self.at, -1):
            y[i - 1] -= self.up[i - 1] * y[i]
        return _unit(self._outwards(_unit(y / self.pivot)))


def _unit(z: np.ndarray) -> np.ndarray:
    z = z / np.abs(z).max()
    return z / np.linalg.norm(z)


def _rotated(x: np.ndarray, image: np.ndarray) -> np.ndarray:
    """Orthonormal columns ``x`` turned until their images are orthogonal (one-sided
    Jacobi), by falling length of the image."""
    x, image = x.copy(), image.copy()
    m = x.shape[1]
    for _ in range(40):
        turned = False
        for i in range(m - 1):
            for j in range(i + 1, m):
                p, q, r = image[:, i] @ image[:, i], image[:, j] @ image[:, j], image[:, i] @ image[:, j]
                if abs(r) <= 4 * EPS * np.sqrt(p * q):
                    continue
                turned = True
                z = (q - p) / (2 * r)
                t = np.copysign(1.0, z) / (abs(z) + np.hypot(1.0, z))
                c = 1 / np.hypot(1.0, t)
                for y in (x, image):
                    y[:, [i, j]] = np.column_stack((c * y[:, i] - c * t * y[:, j], c * t * y[:, i] + c * y[:, j]))
        if not turned:
            break
    order = np.argsort(-np.einsum("ij,ij->j", image, image), kind="stable")
    return x[:, order]


def _image(a: np.ndarray, b: np.ndarray, z: np.ndarray) -> np.ndarray:
    """``B @ z``"""
    out = a[:, None] * z
    out[:-1] += b[:, None] * z[1:]
    return out


def right_singular_vectors(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The squares of all singular values of ``r``, falling, and the right
    vectors (columns) of the first ``k``. A value under ``RANK`` of the largest
    is rounding noise of a missing direction and gets no vector."""
    n = r.shape[0]
    a, b, w = bidiagonalise(r)
    squares = squared_singular_values(a, b)
    k = min(k, int(np.count_nonzero(squares > RANK * squares.max(initial=0.0))))
    vectors = np.zeros((n, k))
    start = np.random.default_rng(7).standard_normal((n, n))
    first = 0
    while first < k:
        last = first + 1
        while last < n and squares[last] >= squares[last - 1] * (1 - CLOSE):
            last += 1
        if last - first == 1:
            z = Twisted(a, b, squares[first]).vector()[:, None]
        else:
            z = start[:, first:last]
            # at the values themselves the group's space is found at once, but its columns come out
            # nearly parallel; beside them all members grow alike and the rest dies out
            for beside in (0.0, 0.0, BESIDE, BESIDE, BESIDE, BESIDE):
                if beside:
                    z = _rotated(z, _image(a, b, z))
                z = np.column_stack([Twisted(a, b, squares[first + j] * (1 + beside)).solve(z[:, j])
                                     for j in range(last - first)])
                z = np.linalg.qr(z)[0]
            z = _rotated(z, _image(a, b, z))
        take = min(last, k) - first
        vectors[:, first:first + take] = z[:, :take]
        first = last
    return squares, w @ vectors
