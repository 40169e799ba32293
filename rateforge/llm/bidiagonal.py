"""Singular values and right singular vectors of a small square matrix by qd arithmetic.

Householder reflections from both sides make the matrix upper bidiagonal; the
differential qd transform with shifts (dqds) finds the squares of its singular
values to high relative accuracy; a twisted factorisation of ``B^T B - x I``
at each of them gives its vector without iterating. Values closer to each
other than CLOSE are told apart by inverse iteration, each against those of
its cluster already found.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
TINY = 1e-290
TOLERANCE = (10 * EPS) ** 2
#: Relative gap below which the vectors of neighbouring values are made orthogonal.
CLOSE = 1e-3


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """The unit vector v for which (I - 2 v v^T) x is a multiple of the first axis."""
    size = np.linalg.norm(x)
    if size == 0:
        return None
    v = x / size
    v[0] += 1.0 if v[0] >= 0 else -1.0
    return v / np.linalg.norm(v)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with ``r = U B V^T``, B upper bidiagonal."""
    b = np.array(r, dtype=np.float64)
    d = len(b)
    right = np.eye(d)
    for k in range(d):
        v = _reflector(b[k:, k])
        if v is not None:
            b[k:, k:] -= 2 * np.outer(v, v @ b[k:, k:])
        if k + 2 <= d - 1:
            v = _reflector(b[k, k + 1 :])
            if v is not None:
                b[k:, k + 1 :] -= 2 * np.outer(b[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diagonal(b).copy(), np.diagonal(b, 1).copy(), right


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, bool]:
    """One transform: new q and e, the least d, and whether only the last d is negative."""
    new_q, new_e = [], []
    d = q[0] - shift
    least = d
    for i in range(len(e)):
        if d < 0:
            return new_q, new_e, d, False
        x = d + e[i]
        if x < TINY:
            x = TINY
        ratio = q[i + 1] / x
        new_q.append(x)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    new_q.append(d)
    return new_q, new_e, least, True


def _pair(q1: float, e1: float, q2: float) -> tuple[float, float]:
    """The larger and the smaller eigenvalue of a block of two."""
    root = ((q1 - q2 + e1) ** 2 + 4 * e1 * q2) ** 0.5
    large = (q1 + q2 + e1 + root) / 2
    return large, q1 * (q2 / large) if large > 0 else 0.0


def singular_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squares of the singular values of a bidiagonal matrix, falling."""
    scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if scale == 0:
        return np.zeros(len(a))
    q = [max(float(x), TINY) for x in (a / scale) ** 2]
    e = [float(x) for x in (b / scale) ** 2]
    found: list[float] = []
    blocks = [(q, e, 0.0)]
    sweeps = 0
    while blocks:
        q, e, base = blocks.pop()
        while True:
            n = len(q)
            if n == 1:
                found.append(q[0] + base)
                break
            if n == 2:
                found += [x + base for x in _pair(q[0], e[0], q[1])]
                break
            if e[-1] <= TOLERANCE * (base + q[-1]):
                found.append(q.pop() + base)
                e.pop()
                continue
            cut = next((i for i in range(n - 1) if e[i] <= TOLERANCE * (base + min(q[i], q[i + 1]))), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], base))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            sweeps += 1
            if sweeps > 200 * (len(a) + 1):
                raise ArithmeticError("dqds does not converge")
            # The last two rows' smaller value is a bound from above: it is tried a little below.
            shift = _pair(q[-2], e[-1], q[-1])[1] * (1 - 1e-3)
            for _ in range(4):
                new_q, new_e, least, late = _dqds(q, e, shift)
                if least >= 0:
                    break
                shift = max(shift + least, 0.0) * (1 - 4 * EPS) if late else shift / 4
            else:
                shift = 0.0
                new_q, new_e, least, _ = _dqds(q, e, 0.0)
            q, e, base = [max(x, TINY) for x in new_q], new_e, base + shift
    return np.sort(np.array(found))[::-1] * scale**2


def twisted_vectors(a: np.ndarray, b: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """The unit eigenvectors of ``B^T B`` at the given eigenvalues, as columns.

    All eigenvalues go through the recurrences together, a lane each: the
    stationary transform from the top, the progressive one from the bottom,
    and the twist where the two leave the least remainder.
    """
    d, m = len(a), len(squares)
    a = np.where(a == 0, TINY, a)
    diagonal = a * a
    lower = b / a[:-1]

    def safe(x: np.ndarray) -> np.ndarray:
        return np.where(np.abs(x) < TINY, TINY, x)

    s, down = np.empty((d, m)), np.empty((d - 1, m))
    s[0] = -squares
    for i in range(d - 1):
        down[i] = diagonal[i] * lower[i] / safe(s[i] + diagonal[i])
        s[i + 1] = down[i] * lower[i] * s[i] - squares
    p, up = np.empty((d, m)), np.empty((d - 1, m))
    p[-1] = diagonal[-1] - squares
    for i in range(d - 2, -1, -1):
        ratio = diagonal[i] / safe(diagonal[i] * lower[i] ** 2 + p[i + 1])
        up[i] = lower[i] * ratio
        p[i] = p[i + 1] * ratio - squares
    # s and p both hold the shift; the remainder of a twist at k counts it once.
    gamma = s.copy()
    gamma[-1] = s[-1] + diagonal[-1]
    for i in range(d - 1):
        gamma[i] = s[i] + diagonal[i] / safe(diagonal[i] * lower[i] ** 2 + p[i + 1]) * p[i + 1]
    twist = np.abs(np.where(np.isfinite(gamma), gamma, np.inf)).argmin(axis=0)
    z = np.zeros((d, m))
    z[twist, np.arange(m)] = 1.0
    for i in range(d - 2, -1, -1):
        z[i] = np.where(i < twist, -down[i] * z[i + 1], z[i])
    for i in range(d - 1):
        z[i + 1] = np.where(i >= twist, -up[i] * z[i], z[i + 1])
    return z / np.linalg.norm(z, axis=0)


def _separate(a: np.ndarray, b: np.ndarray, squares: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of a cluster: inverse iteration, each against those before it."""
    t = np.diag(a * a) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    t[1:, 1:] += np.diag(b * b)
    drawn = np.random.default_rng(len(a))
    done = np.empty((len(a), 0))
    for j, x in enumerate(squares):
        shifted = t - x * (1 + 4 * EPS * (j + 1)) * np.eye(len(a))
        v = z[:, j]
        for _ in range(5):
            v = v - done @ (done.T @ v)
            if np.linalg.norm(v) < 0.1:
                v = drawn.standard_normal(len(a))
                v -= done @ (done.T @ v)
            v = np.linalg.solve(shifted, v / np.linalg.norm(v))
            v /= np.linalg.norm(v)
        for _ in range(2):
            v = v - done @ (done.T @ v)
        done = np.column_stack([done, v / np.linalg.norm(v)])
    return done


def right_singular(r: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(squares of the singular values, right singular vectors as columns), falling.

    Values of at most ``least`` times the largest are left out. A vector's
    largest entry is positive.
    """
    a, b, right = bidiagonalise(r)
    squares = singular_squares(a, b)
    squares = squares[(squares > 0) & (squares > least**2 * squares.max(initial=0))]
    if not len(squares):
        return squares, np.empty((len(r), 0))
    z = twisted_vectors(a, b, squares)
    apart = np.flatnonzero(squares[:-1] - squares[1:] > CLOSE * squares[:-1]) + 1
    for cluster in np.split(np.arange(len(squares)), apart):
        if len(cluster) > 1:
            z[:, cluster] = _separate(a, b, squares[cluster], z[:, cluster])
    v = right @ z
    return squares, v * np.where(np.take_along_axis(v, np.abs(v).argmax(axis=0)[None], axis=0) < 0, -1.0, 1.0)
