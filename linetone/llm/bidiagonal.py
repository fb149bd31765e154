"""Right singular vectors and values of a small upper triangle: Householder, dqds, twisted factors."""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(float).eps)

# Squared singular values of a block closer than this, as a share, are treated as a cluster.
CLUSTER = 1e-3


def bidiagonalise(triangle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, P)``: diagonal and superdiagonal of ``U' R P``, and the orthogonal ``P``."""
    work = np.array(triangle, float)
    size = work.shape[1]
    right = np.eye(size)
    for k in range(size):
        v = _reflector(work[k:, k])
        work[k:, k:] -= np.outer(v, 2.0 * (v @ work[k:, k:]))
        if k + 2 < size:
            v = _reflector(work[k, k + 1 :])
            work[k:, k + 1 :] -= np.outer(2.0 * (work[k:, k + 1 :] @ v), v)
            right[:, k + 1 :] -= np.outer(2.0 * (right[:, k + 1 :] @ v), v)
    return np.diagonal(work).copy(), np.diagonal(work, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """Unit ``v`` such that ``x - 2 v (v'x)`` is zero but for its first entry."""
    scale = np.abs(x).max()
    if scale == 0.0:
        return np.zeros_like(x)
    v = x / scale
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, from the squared diagonal and superdiagonal.

    Sums, products and quotients of non-negative numbers only, but for the shift, which is a
    lower bound of the smallest value left: small values come out as accurate as large ones.
    """
    values: list[float] = []
    blocks = [([float(x) for x in q], [float(x) for x in e], 0.0)]
    while blocks:
        q, e, taken = blocks.pop()
        while q:
            if len(q) == 1 or e[-1] <= EPS * EPS * (taken + q[-1]):
                values.append(taken + q.pop())
                e = e[: max(0, len(q) - 1)]
                continue
            cut = next((i for i in range(len(e)) if e[i] <= EPS * EPS * q[i]), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], taken))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q.reverse()
                e.reverse()
            shift = _lower_bound(q, e)
            swept = _sweep(q, e, shift)
            while swept is None:
                shift = shift / 2 if shift > EPS * EPS * taken else 0.0
                swept = _sweep(q, e, shift)
            taken += shift
            q, e = swept
    return np.array(sorted(values, reverse=True))


def _lower_bound(q: list[float], e: list[float]) -> float:
    """One Newton step from 0: the reciprocal of the summed reciprocals of all values."""
    column = total = 0.0
    before = 0.0
    for i, x in enumerate(q):
        if x <= 0.0:
            return 0.0
        column = (1.0 + before * column) / x
        total += column
        before = e[i] if i < len(e) else 0.0
    return (1.0 - 8 * len(q) * EPS) / total if 0.0 < total < math.inf else 0.0


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential quotient-difference transformation; none if the shift was too large."""
    new_q, new_e = [], []
    d = q[0] - shift
    for i, off in enumerate(e):
        if d < 0.0:
            return None
        head = d + off
        ratio = q[i + 1] / head if head > 0.0 else 0.0
        new_q.append(head)
        new_e.append(off * ratio)
        d = (d * ratio if head > 0.0 else q[i + 1]) - shift
    if d < 0.0:
        return None
    new_q.append(d)
    return new_q, new_e


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit vector for the squared singular value ``value`` of the bidiagonal ``a``, ``b``.

    The shifted product is factored from the top and from the bottom; where both meet with
    the smallest remainder, the vector starts with 1 and follows the factors both ways.
    """
    n = len(a)
    q, e, off = a * a, b * b, a[:-1] * b
    tiny = EPS * EPS * (float(q.max()) + value) or 1.0
    down, up = np.zeros(n), np.zeros(n)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        down[i] = q[i] + s[i] or tiny
        s[i + 1] = e[i] * (s[i] / down[i]) - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        up[i + 1] = e[i] + p[i + 1] or tiny
        p[i] = p[i + 1] * (q[i] / up[i + 1]) - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -(off[i] / down[i]) * z[i + 1]
        if abs(z[i]) > 1e150:
            z /= abs(z[i])
    for i in range(k, n - 1):
        z[i + 1] = -(off[i] / up[i + 1]) * z[i]
        if abs(z[i + 1]) > 1e150:
            z /= abs(z[i + 1])
    return z / np.linalg.norm(z)


def _improved(
    a: np.ndarray, b: np.ndarray, value: float, start: np.ndarray, others: list[np.ndarray]
) -> np.ndarray:
    """Inverse iteration that stays orthogonal to ``others``, for members of a cluster."""
    n = len(a)
    matrix = np.zeros((n, n))
    np.fill_diagonal(matrix, a)
    matrix[np.arange(n - 1), np.arange(1, n)] = b
    shifted = matrix.T @ matrix - np.eye(n) * (value * (1.0 + 2 * EPS))
    shifted[np.diag_indices(n)] += np.where(np.diagonal(shifted) == 0.0, EPS * value, 0.0)
    z = start + 1e-3 * np.random.default_rng(len(others)).standard_normal(n)
    for _ in range(4):
        z = _orthogonal(z, others)
        try:
            z = np.linalg.solve(shifted, z)
        except np.linalg.LinAlgError:
            break
    return _orthogonal(z, others)


def _orthogonal(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            z = z - other * (other @ z)
        z = z / (np.linalg.norm(z) or 1.0)
    return z


def principal_directions(triangle: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values, falling, and unit right singular vectors for the first ``most``.

    Each vector's entry of largest size is positive. Values below the rounding of the largest
    are 0. Blocks between negligible superdiagonals are solved on their own, so that a value
    that several of them have gets a vector from each.
    """
    size = triangle.shape[1]
    scale = float(np.abs(triangle).max()) if triangle.size else 0.0
    if scale == 0.0:
        return np.zeros(size), np.eye(size)[:most]
    a, b, right = bidiagonalise(triangle / scale)
    off = np.abs(b)
    ends = np.flatnonzero((off <= EPS * np.abs(a[:-1])) & (off <= EPS * np.abs(a[1:])))
    found = []
    for start, end in zip([0, *(ends + 1)], [*(ends + 1), size], strict=True):
        values = dqds(a[start:end] ** 2, b[start : end - 1] ** 2)
        found += [(float(v), start, end) for v in values]
    found.sort(key=lambda f: -f[0])
    values = np.array([f[0] for f in found])
    values[values <= (size * EPS) ** 2 * values[0]] = 0.0
    vectors: list[np.ndarray] = []
    for i, (value, start, end) in enumerate(found[:most]):
        part = slice(start, end)
        diagonal, above = a[part], b[start : end - 1]
        z = np.zeros(size)
        z[part] = twisted_vector(diagonal, above, value)
        near = [j for j in range(i) if found[j][1] == start and found[j][0] - value <= CLUSTER * found[j][0]]
        close = [vectors[j][part] for j in near]
        if any(abs(v @ z[part]) > 8 * EPS for v in close):
            z[part] = _improved(diagonal, above, value, z[part], close)
        vectors.append(z)
    directions = np.array(vectors).reshape(-1, size) @ right.T
    largest = directions[np.arange(len(directions)), np.abs(directions).argmax(axis=1)]
    return values * scale * scale, directions * np.sign(largest)[:, None]
