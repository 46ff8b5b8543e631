"""Singular values and right singular vectors of a small square matrix by its bidiagonal form.

Householder reflections make the matrix upper bidiagonal; dqds (differential quotient difference with
shifts; Fernando and Parlett) finds the squares of the singular values from the smallest on, each with high relative
accuracy; twisted factorisations of the tridiagonal B'B (Parlett and Dhillon) give a vector for each; neighbours that are close
are made orthogonal by inverse iteration.  All of it costs the square of the dimension, the reflections its cube.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
TINY = float(np.finfo(np.float64).tiny)
#: Eigenvalues nearer than this part of the larger are one cluster, whose vectors need each other.
CLOSE = 1e-3


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, V): diagonal and upper diagonal of B with matrix = U B V'."""
    work, n = np.array(matrix, np.float64), len(matrix)
    right = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.abs(x).max(initial=0)
        if not size or not np.abs(x[1:]).any():
            return None
        v = x / size
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(work[k:, k])
        if v is not None:
            work[k:, k:] -= 2 * np.outer(v, v @ work[k:, k:])
        v = reflector(work[k, k + 1 :]) if k + 2 < n else None
        if v is not None:
            work[k:, k + 1 :] -= 2 * np.outer(work[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(work).copy(), np.diag(work, 1).copy(), right


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One transform by a shift: (q, e, least d); nothing where the shift is above the least eigenvalue."""
    d, least, new_q, new_e = q[0] - shift, q[0] - shift, [], []
    for above, below in zip(e, q[1:], strict=True):
        if d < 0:
            return None
        total = d + above
        if total <= TINY:
            new_q.append(0.0)
            new_e.append(0.0)
            d = below - shift
        else:
            ratio = below / total
            new_q.append(total)
            new_e.append(above * ratio)
            d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, least


def _dqds(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B of one block, given the squares of B's diagonal and upper diagonal."""
    if q[0] < q[-1]:
        q, e = q[::-1], e[::-1]
    found, moved, guess = [], 0.0, 0.0
    for _ in range(100 * len(q) + 100):
        # the smallest comes off the end; small couplings inside split the block
        while len(q) > 1 and e[-1] <= EPS * EPS * (moved + q[-1]):
            found.append(moved + q.pop())
            e.pop()
            guess = 0.0
        if len(q) == 1:
            return [*found, moved + q[0]]
        cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * min(q[k], q[k + 1])), None)
        if cut is not None:
            parts = _dqds(q[: cut + 1], e[:cut]) + _dqds(q[cut + 1 :], e[cut + 1 :])
            return found + [moved + x for x in parts]
        step = None
        while guess > 0 and step is None:
            step = _qd_step(q, e, guess)
            if step is None:
                guess = guess / 4 if guess > EPS * moved else 0.0
        if step is None:
            guess, step = 0.0, _qd_step(q, e, 0.0)
        if step is None:
            break
        moved += guess
        q, e, least = step
        # the lower end of the last two rows, safely below the least eigenvalue once these stand apart
        a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), (q[-2] * e[-1]) ** 0.5, q[-1] + e[-1]
        corner = (a + c) / 2 - (((a - c) / 2) ** 2 + b * b) ** 0.5
        guess = max(min(least, corner) * (1 - 8 * EPS) - EPS * moved, 0.0)
    raise ArithmeticError("dqds did not converge")


def blocks(a: np.ndarray, b: np.ndarray) -> list[slice]:
    """Parts of the bidiagonal matrix whose couplings are above the rounding of their neighbours."""
    cuts = np.flatnonzero(np.abs(b) <= EPS * np.minimum(np.abs(a[:-1]), np.abs(a[1:]))) + 1
    bounds = [0, *cuts.tolist(), len(a)]
    return [slice(first, end) for first, end in zip(bounds[:-1], bounds[1:], strict=True)]


def eigenvalues(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of one block, falling."""
    return np.sort(np.array(_dqds((a * a).tolist(), (b * b).tolist())))[::-1]


def _nonzero(x: float) -> float:
    return x if abs(x) > TINY else TINY


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """(unit vector, correction of the value) by the best twisted factorisation of B'B - value.

    The stationary transform goes down, the progressive one up, both in differential form, so that
    small eigenvalues keep their digits; they meet where they leave the least.
    """
    n, square, couple = len(a), (a * a).tolist(), (b * b).tolist()
    s, down, p, up = [-value], [], [square[-1] - value], []
    for k in range(n - 1):
        down.append(_nonzero(s[k] + square[k]))
        s.append(couple[k] / down[k] * s[k] - value)
        up.append(_nonzero(couple[n - 2 - k] + p[k]))
        p.append(square[n - 2 - k] / up[k] * p[k] - value)
    up.reverse()
    twist = np.array(s) + np.array(p[::-1]) + value
    at = int(np.argmin(np.abs(twist)))
    both, vector = (a[:-1] * b).tolist(), [0.0] * n
    vector[at] = 1.0
    for k in range(at - 1, -1, -1):
        vector[k] = -both[k] / down[k] * vector[k + 1]
    for k in range(at, n - 1):
        vector[k + 1] = -both[k] / up[k] * vector[k]
    size = float(np.linalg.norm(vector))
    return np.array(vector) / size, float(twist[at]) / (size * size)


def _solve(diagonal: np.ndarray, off: np.ndarray, value: float, right: np.ndarray) -> np.ndarray:
    """x of (T - value) x = right, by a factorisation with row exchanges."""
    n = len(diagonal)
    floor = EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), TINY)
    main, upper, second, x = diagonal - value, np.append(off, 0.0), np.zeros(n), right.copy()
    for k in range(n - 1):
        low = off[k]
        if abs(low) > abs(main[k]):
            main[k], upper[k], second[k], low, main[k + 1], upper[k + 1] = low, main[k + 1], upper[k + 1], main[k], upper[k], 0.0
            x[k], x[k + 1] = x[k + 1], x[k]
        pivot = main[k] if abs(main[k]) > floor else np.copysign(floor, main[k])
        factor = low / pivot
        main[k + 1] -= factor * upper[k]
        upper[k + 1] -= factor * second[k]
        x[k + 1] -= factor * x[k]
    for k in range(n - 1, -1, -1):
        pivot = main[k] if abs(main[k]) > floor else np.copysign(floor, main[k])
        rest = (upper[k] * x[k + 1] if k + 1 < n else 0) + (second[k] * x[k + 2] if k + 2 < n else 0)
        x[k] = (x[k] - rest) / pivot
    return x / np.linalg.norm(x)


def vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of B'B of one block, a column for each of the given eigenvalues (falling)."""
    n = len(a)
    diagonal = a * a
    diagonal[1:] += b * b
    off = a[:-1] * b
    rng = np.random.default_rng(5)
    result, cluster = np.zeros((n, len(values))), 0
    for k, value in enumerate(values.tolist()):
        vector, shift = twisted_vector(a, b, value)
        for _ in range(3):
            if abs(shift) <= EPS * abs(value):
                break
            vector, shift = twisted_vector(a, b, value + shift)
        if k and values[k - 1] - value > CLOSE * values[k - 1]:
            cluster = k
        near = result[:, cluster:k]
        if near.shape[1]:
            for _ in range(8):
                vector, size = _apart(vector, near)
                if size > 1 - 1e-8:
                    break
                if size < 0.1:  # the vector of a neighbour again
                    vector, _ = _apart(rng.normal(size=n), near)
                vector = _solve(diagonal, off, value, vector)
            vector, _ = _apart(vector, near)
        result[:, k] = vector
    return result


def _apart(vector: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, float]:
    """The unit vector of what is orthogonal to the columns of ``near``, and how much of the vector that is."""
    rest = vector - near @ (near.T @ vector)
    size = np.linalg.norm(rest) / np.linalg.norm(vector)
    rest -= near @ (near.T @ rest)
    return rest / max(np.linalg.norm(rest), TINY), float(size)


def singular(matrix: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(squares of all singular values, falling; right singular vectors of the ``most`` largest, as columns)."""
    if not len(matrix):
        return np.zeros(0), np.zeros((0, 0))
    size = np.abs(matrix).max()
    if not size:
        return np.zeros(len(matrix)), np.eye(len(matrix))[:, :most]
    a, b, right = bidiagonalise(matrix / size)
    parts = blocks(a, b)
    own = [eigenvalues(a[part], b[part][: part.stop - part.start - 1]) for part in parts]
    values = np.concatenate(own)
    place = np.repeat(np.arange(len(parts)), [len(v) for v in own])
    order = np.argsort(-values, kind="stable")
    chosen, columns = order[:most], np.zeros((len(a), len(order[:most])))
    for number, part in enumerate(parts):
        wanted = np.flatnonzero(place[chosen] == number)
        if len(wanted):
            inside = vectors(a[part], b[part][: part.stop - part.start - 1], values[chosen[wanted]])
            columns[part, wanted] = inside
    return values[order] * size * size, right @ columns
