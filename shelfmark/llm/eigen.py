"""Leading eigenvectors of a symmetric matrix: Householder, Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
#: Eigenvalues nearer to each other than this share of the matrix's size are one cluster.
CLUSTER = 1e-3
_ROUNDS = 8


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, side diagonal and the unit Householder vectors that lead there.

    Reflection ``k`` clears column ``k`` below the side diagonal; its vector acts
    on rows ``k + 1`` and later.
    """
    a = np.array(matrix, dtype=np.float64)
    size = len(a)
    reflections = []
    for k in range(size - 2):
        x = a[k + 1:, k]
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(v)
        if length == 0:
            reflections.append(np.zeros_like(v))
            continue
        v /= length
        reflections.append(v)
        part = a[k + 1:, k + 1:]
        p = part @ v
        w = p - (v @ p) * v
        part -= 2 * (np.outer(v, w) + np.outer(w, v))
        rest = x - 2 * v * (v @ x)
        a[k + 1:, k] = a[k, k + 1:] = rest
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def count_below(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues are less than each of ``values``."""
    least = np.finfo(np.float64).tiny
    below = np.zeros(len(values), dtype=np.int64)
    q = np.ones(len(values))
    squares = np.concatenate([[0.0], side * side])
    for d, s in zip(diagonal, squares):
        q = d - values - s / q
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, side: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection down to neighbouring numbers."""
    size = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(side)]) + np.concatenate([np.abs(side), [0.0]])
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    margin = 2 * _EPS * max(abs(low[0]), abs(high[0]))
    low, high = low - margin, high + margin
    wanted = size - 1 - np.arange(count)  # so many eigenvalues are less than it
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        above = count_below(diagonal, side, middle) > wanted
        high = np.where(open_ & above, middle, high)
        low = np.where(open_ & ~above, middle, low)


def _solve(diagonal: np.ndarray, side: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """``(T - shift) x = right`` by elimination with row exchanges; a pivot of zero counts as one rounding."""
    size = len(diagonal)
    # Each row of the upper triangle has three entries.
    first, second, third = diagonal - shift, np.append(side, 0.0), np.zeros(size)
    x = right.copy()
    for k in range(size - 1):
        lower = side[k]
        if abs(lower) > abs(first[k]):
            row = lower, first[k + 1], second[k + 1]
            old = first[k], second[k], third[k]
            first[k], second[k], third[k] = row
            factor = old[0] / lower
            first[k + 1], second[k + 1] = old[1] - factor * row[1], old[2] - factor * row[2]
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            if abs(first[k]) < _EPS:
                first[k] = _EPS
            factor = lower / first[k]
            first[k + 1] -= factor * second[k]
            second[k + 1] -= factor * third[k]
            x[k + 1] -= factor * x[k]
    if abs(first[-1]) < _EPS:
        first[-1] = _EPS
    for k in range(size - 1, -1, -1):
        rest = x[k] - (second[k] * x[k + 1] if k + 1 < size else 0.0) - (third[k] * x[k + 2] if k + 2 < size else 0.0)
        x[k] = rest / first[k]
    return x


def _vectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """Unit eigenvectors of the tridiagonal matrix; those of a cluster are orthogonalised in every round."""
    rng = np.random.default_rng(0)
    found: list[np.ndarray] = []
    cluster: list[np.ndarray] = []
    used = None
    for k, value in enumerate(values):
        if k and abs(values[k - 1] - value) > CLUSTER:
            cluster, used = [], None
        # Equal eigenvalues are told apart by a step of rounding size.
        shift = value if used is None else min(value, used - 10 * _EPS)
        used = shift
        x = rng.standard_normal(len(diagonal))
        for _ in range(_ROUNDS):
            x /= np.abs(x).max()
            x = _solve(diagonal, side, shift, x)
            x /= np.linalg.norm(x)
            for _ in range(2):
                for other in cluster:
                    x -= (other @ x) * other
                x /= np.linalg.norm(x)
        cluster.append(x)
        found.append(x)
    return found


def _blocks(diagonal: np.ndarray, side: np.ndarray) -> list[slice]:
    """Runs between side entries that are zero within rounding."""
    cuts = [0, *(np.nonzero(np.abs(side) <= _EPS)[0] + 1), len(diagonal)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as rows.

    The matrix is scaled to entries of at most one, by a power of two. Its
    tridiagonal form is worked on in the blocks between zero side entries, so that
    vectors of different blocks are orthogonal as they are.
    """
    largest = np.abs(matrix).max(initial=0.0)
    scale = 2.0 ** np.ceil(np.log2(largest)) if largest > 0 else 1.0
    diagonal, side, reflections = tridiagonal(np.asarray(matrix) / scale)
    size = len(diagonal)
    pairs = []
    for block in _blocks(diagonal, side):
        d, s = diagonal[block], side[block.start:block.stop - 1]
        values = leading_eigenvalues(d, s, min(count, len(d)))
        for value, vector in zip(values, _vectors(d, s, values)):
            whole = np.zeros(size)
            whole[block] = vector
            pairs.append((value, whole))
    pairs.sort(key=lambda p: -p[0])
    vectors = []
    for _, x in pairs[:count]:
        for k in range(size - 3, -1, -1):
            v = reflections[k]
            x[k + 1:] -= 2 * v * (v @ x[k + 1:])
        vectors.append(x / np.linalg.norm(x))
    return scale * np.array([value for value, _ in pairs[:count]]), np.array(vectors).reshape(-1, size)
