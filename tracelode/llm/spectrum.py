"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

``above`` counts the eigenvalues over a shift from the signs in an LDLᵀ factorisation of the shifted matrix (Sylvester's law
of inertia). Bisection on these counts isolates each wanted eigenvalue in an interval of its own. Rayleigh quotient iteration,
started in the interval, then converges cubically; a pair whose eigenvalue lies outside the interval is thrown away and the
interval is cut further. At last counts just above and below each eigenvalue certify its number.

Eigenvalues closer than the matrix can tell apart (``CLOSE`` times its norm) stay in one interval. Their vectors are made one
after another, each kept orthogonal to those already found: any orthonormal basis of their space is right.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Eigenvalues nearer to each other than this share of the norm count as equal.
CLOSE = 64 * np.finfo(float).eps
_ALPHA = (1 + 17**0.5) / 8


class Pairs(NamedTuple):
    values: np.ndarray
    #: One unit vector a column; the entry of largest magnitude is positive.
    vectors: np.ndarray
    #: Each value's number is certified: so many eigenvalues are over it, and it is the next.
    certified: np.ndarray


def above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues over ``shift``: positive pivots of a symmetrically pivoted LDLᵀ factorisation."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(a), 0, 0
    tiny = np.finfo(float).tiny
    while k < n:
        rest = a[k:, k:]
        column = np.abs(rest[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        largest = column[r - 1] if r else 0.0
        size = 1
        if abs(rest[0, 0]) < _ALPHA * largest:
            other = np.abs(rest[:, r])
            other[r] = 0
            widest = other.max()
            if abs(rest[0, 0]) * widest >= _ALPHA * largest**2:
                r = 0
            elif abs(rest[r, r]) < _ALPHA * widest:
                size = 2
        else:
            r = 0
        swap = size - 1
        if r != swap and not (size == 1 and r == 0):
            rest[[swap, r]] = rest[[r, swap]]
            rest[:, [swap, r]] = rest[:, [r, swap]]
        if size == 1:
            pivot = rest[0, 0]
            positive += pivot > 0
            if abs(pivot) > tiny:
                low = rest[1:, 0].copy()
                rest[1:, 1:] -= np.outer(low, low / pivot)
        else:
            positive += 1  # such a block has one positive and one negative eigenvalue
            low = rest[2:, :2].copy()
            rest[2:, 2:] -= low @ np.linalg.solve(rest[:2, :2], low.T)
        k += size
    return int(positive)


def _refined(matrix: np.ndarray, value: float, known: np.ndarray, norm: float, seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from a shift, orthogonal to the columns of ``known``."""
    n = len(matrix)

    def unit(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - known @ (known.T @ v)
        size = np.linalg.norm(v)
        return v / size if size > 0 else v

    v, shift = unit(np.random.default_rng(seed).standard_normal(n)), value
    best, least = (value, v), np.inf
    for step in range(24):
        try:
            w = np.linalg.solve(matrix - shift * np.eye(n), v)
        except np.linalg.LinAlgError:
            w = np.linalg.solve(matrix - (shift + CLOSE * norm) * np.eye(n), v)
        if not np.isfinite(w).all():
            break
        v = unit(w)
        quotient = float(v @ matrix @ v)
        wrong = float(np.linalg.norm(matrix @ v - quotient * v))
        if wrong < least:
            best, least = (quotient, v), wrong
        elif step > 3 and least <= CLOSE * norm:
            break
        shift = quotient if step else value  # twice from the start: the vector must first turn to this interval's
    return best


def leading(matrix: np.ndarray, count: int) -> Pairs:
    """The ``count`` largest eigenvalues, falling, with their vectors."""
    n = len(matrix)
    count = min(count, n)
    if not count:
        return Pairs(np.zeros(0), np.zeros((n, 0)), np.zeros(0, bool))
    radius = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
    high, low = float((np.diag(matrix) + radius).max()), float((np.diag(matrix) - radius).min())
    norm = max(abs(high), abs(low), np.finfo(float).tiny)
    high, low, close = high + CLOSE * norm, low - CLOSE * norm, CLOSE * norm

    values, vectors = np.zeros(count), np.zeros((n, count))
    # (low, high, eigenvalues over high, eigenvalues over low), the highest interval last
    open_ = [(low, high, 0, n)]
    done = 0
    while open_ and done < count:
        lo, hi, before, upto = open_.pop()
        if before >= count or before == upto:
            continue
        middle = (lo + hi) / 2
        if upto - before == 1:
            value, vector = _refined(matrix, middle, vectors[:, :done], norm, seed=before)
            inside = lo - close <= value <= hi + close
            if inside and np.linalg.norm(matrix @ vector - value * vector) <= 8 * close:
                values[done], vectors[:, done] = value, vector
                done += 1
                continue
        if hi - lo <= close:  # as many as cannot be told apart
            for _ in range(min(upto, count) - before):
                values[done], vectors[:, done] = _refined(matrix, middle, vectors[:, :done], norm, seed=done)
                done += 1
            continue
        split = above(matrix, middle)
        split = min(max(split, before), upto)
        open_ += [(lo, middle, split, upto), (middle, hi, before, split)]
    values, vectors = values[:done], vectors[:, :done]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(done)])
    slack = 16 * close
    certified = np.array([above(matrix, e + slack) <= i < above(matrix, e - slack) for i, e in enumerate(values)], bool)
    return Pairs(values, vectors * np.where(signs == 0, 1, signs), certified)
