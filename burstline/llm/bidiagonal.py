"""Singular values and right vectors of a triangular factor: Householder bidiagonalisation, dqds for
the values, twisted factorisations for the vectors.

All work is on one matrix as wide as the vectors are, whatever the number of rows.
"""

from __future__ import annotations

import math

import numpy as np

_EPS = np.finfo(np.float64).eps
_TINY = np.finfo(np.float64).tiny
_TRIES = 60  # sweeps per value; a handful are needed


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of an upper bidiagonal ``b``, and ``v`` with r = u b v'."""
    a = r.astype(np.float64).copy()
    n = a.shape[1]
    v = np.eye(n)
    for k in range(n):
        reflector = _householder(a[k:, k])
        a[k:, k:] -= np.outer(reflector, 2 * (reflector @ a[k:, k:]))
        if k + 2 < n:
            reflector = _householder(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(2 * (a[k:, k + 1 :] @ reflector), reflector)
            v[:, k + 1 :] -= np.outer(2 * (v[:, k + 1 :] @ reflector), reflector)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _householder(x: np.ndarray) -> np.ndarray:
    """A unit vector whose reflection takes ``x`` to its first axis; zero for a zero ``x``."""
    largest = np.abs(x).max(initial=0.0)
    if largest == 0 or not x[1:].any():
        return np.zeros_like(x)
    w = x / largest
    w[0] += math.copysign(math.sqrt(w @ w), w[0])
    return w / math.sqrt(w @ w)


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One differential qd step with a shift, and the sum of the inverses of its ``d``, which
    without a shift bounds the smallest eigenvalue from below. Negative ``d`` give no sum."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    inverses = 0.0
    for k in range(n - 1):
        if d < 0:
            return new_q, new_e, -1.0
        inverses += 1 / d if d > _TINY else math.inf
        new_q[k] = d + e[k]
        if new_q[k] == 0:
            ratio = 0.0
            d = -shift + q[k + 1]
        else:
            ratio = q[k + 1] / new_q[k]
            d = d * ratio - shift
        new_e[k] = e[k] * ratio
    if d < 0:
        return new_q, new_e, -1.0
    new_q[-1] = d
    return new_q, new_e, inverses + (1 / d if d > _TINY else math.inf)


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, largest first, by dqds: each
    to high relative accuracy, as no step subtracts but the shift."""
    q, e = (diagonal**2).tolist(), (above**2).tolist()
    found: list[float] = []
    shifted = 0.0
    for _ in range(_TRIES * max(1, len(q))):
        while q and (len(q) == 1 or e[-1] <= _EPS**2 * (shifted + q[-1])):
            found.append(shifted + q.pop())
            if e:
                e.pop()
        if not q:
            break
        # A step without shift costs nothing in accuracy and tells how far a shift may go.
        q, e, inverses = _sweep(q, e, 0.0)
        shift = 1 / inverses if inverses > 0 else 0.0
        while shift > _EPS * shifted and shift > 0:
            new_q, new_e, sound = _sweep(q, e, shift)
            if sound >= 0:
                q, e = new_q, new_e
                shifted += shift
                break
            shift *= 0.9
        else:
            e[-1] = 0.0 if e[-1] <= _EPS * (shifted + q[-1]) else e[-1]
    else:
        raise ArithmeticError("dqds has not come to an end")
    return np.sort(np.array(found))[::-1]


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of b'b = L D L' for an eigenvalue: stationary factors from the top,
    progressive ones from the bottom, joined where their pivot is smallest."""
    n = len(diagonal)
    largest = float(np.abs(diagonal).max())
    d = np.maximum(diagonal**2, (_EPS * largest) ** 2 + _TINY)
    root = np.where(diagonal < 0, -np.sqrt(d), np.sqrt(d))
    low = above / root[:-1]
    s, plus, down = np.empty(n), np.empty(n), np.empty(max(n - 1, 0))
    s[0] = -value
    for k in range(n - 1):
        plus[k] = s[k] + d[k] or _TINY
        down[k] = d[k] * low[k] / plus[k]
        s[k + 1] = down[k] * low[k] * s[k] - value
    p, up = np.empty(n), np.empty(max(n - 1, 0))
    p[-1] = d[-1] - value
    for k in range(n - 2, -1, -1):
        minus = d[k] * low[k] ** 2 + p[k + 1] or _TINY
        up[k] = low[k] * d[k] / minus
        p[k] = p[k + 1] * d[k] / minus - value
    twist = int(np.nanargmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[twist] = 1
    for k in range(twist - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -up[k] * z[k]
    return z / math.sqrt(z @ z)


def _orthogonal(vectors: list[np.ndarray], z: np.ndarray) -> tuple[np.ndarray, float]:
    """``z`` without its parts along ``vectors``, as a unit vector, and how long what was left is."""
    for _ in range(2):
        for other in vectors:
            z = z - other * (other @ z)
    left = math.sqrt(z @ z)
    return z / (left or 1.0), left


def right_vectors(
    diagonal: np.ndarray, above: np.ndarray, values: np.ndarray
) -> list[np.ndarray]:
    """Orthonormal eigenvectors of b'b for its largest eigenvalues, given largest first.

    Values that agree to many digits have vectors that the twisted factorisation cannot tell apart:
    those start from what is orthogonal to the ones before, by inverse iteration."""
    n = len(diagonal)
    matrix = np.diag(diagonal) + np.diag(above, 1)
    matrix = matrix.T @ matrix
    scale = max(float(np.abs(matrix).max(initial=0.0)), _TINY)
    rng = np.random.default_rng(n)
    found: list[np.ndarray] = []
    for value in values.tolist():
        z = _twisted(diagonal, above, value)
        z, left = _orthogonal(found, z)
        residual = np.abs(matrix @ z - value * z).max()
        if not (left > 0.5 and residual <= 1e-12 * scale * n):
            z, _ = _orthogonal(found, rng.standard_normal(n))
            near = matrix - (value + 64 * n * _EPS * scale) * np.eye(n)  # not singular
            for _ in range(4):
                z, _ = _orthogonal(found, np.linalg.solve(near, z))
        found.append(z)
    return found


def principal(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of ``r`` and their right vectors, one per row.

    Values that are zero to working accuracy are left out.
    """
    if not r.any():
        return np.zeros(0), np.zeros((0, r.shape[1]))
    scale = 2.0 ** math.frexp(float(np.abs(r).max()))[1]
    diagonal, above, v = bidiagonalise(r / scale)
    # What cannot be told from zero cuts the matrix in parts, each with values of its own.
    small = np.abs(above) <= _EPS * (np.abs(diagonal[:-1]) + np.abs(diagonal[1:]))
    cuts = [0, *(np.flatnonzero(small) + 1).tolist(), len(diagonal)]
    pairs = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = diagonal[a:b], above[a : b - 1]
        values = squared_singular_values(*part)
        pairs += [(value, a, b, k) for k, value in enumerate(values.tolist())]
    pairs.sort(key=lambda x: (-x[0], x[1], x[3]))
    least = (_EPS * len(diagonal)) ** 2 * pairs[0][0]
    chosen = [x for x in pairs[:most] if x[0] > least]
    vectors = {}
    for a, b in {(a, b) for _, a, b, _ in chosen}:
        own = [x for x in chosen if x[1:3] == (a, b)]
        values = np.array([x[0] for x in own])
        for x, z in zip(own, right_vectors(diagonal[a:b], above[a : b - 1], values)):
            vectors[x] = v[:, a:b] @ z
    values = np.array([x[0] for x in chosen]) * scale**2
    return values, np.array([vectors[x] for x in chosen]).reshape(len(chosen), r.shape[1])
