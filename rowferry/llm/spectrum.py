"""Leading eigenvectors of a symmetric matrix by slicing its spectrum.

Pivots of an LDL' factorisation of ``matrix - shift`` have as many positive
signs as the matrix has eigenvalues above ``shift``. Counts at halved
intervals isolate each eigenvalue; Rayleigh quotient iteration from inside the
interval converges cubically; counts just above and below the quotient certify
its number. Eigenvalues that no shift separates are one cluster, whose
vectors come from one subspace.
"""

from __future__ import annotations

import numpy as np

# Relative distance at which two eigenvalues are one cluster, and a bound on
# steps that is never met by the halving of double precision numbers.
CLUSTER_WIDTH = 1e-12
MOST_HALVINGS = 200
MOST_STEPS = 30

# Growth bound of pivots of one row against pivots of two, fixed by theory.
_PIVOT = (1 + 17 ** 0.5) / 8


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above ``shift``, by the inertia of ``matrix - shift``.

    Symmetric pivots of one row or two, the largest diagonal entry first, keep
    the factors bounded for indefinite matrices.
    """
    rest = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(rest):
        diagonal = np.abs(np.diagonal(rest))
        at = int(diagonal.argmax())
        off = np.abs(rest - np.diag(np.diagonal(rest)))
        if diagonal[at] >= _PIVOT * off.max():
            if not diagonal[at]:
                break  # what is left is zero
            positive += rest[at, at] > 0
            row = np.delete(rest[at], at)
            rest = np.delete(np.delete(rest, at, 0), at, 1) - np.outer(row, row) / rest[at, at]
        else:
            # A block of two whose determinant is negative: one eigenvalue of each sign.
            pair = list(np.unravel_index(off.argmax(), off.shape))
            positive += 1
            block, rows = rest[np.ix_(pair, pair)], np.delete(rest[pair], pair, 1)
            rest = np.delete(np.delete(rest, pair, 0), pair, 1) - rows.T @ np.linalg.solve(block, rows)
    return positive


def _isolated(matrix: np.ndarray, number: int, low: float, high: float, width: float) -> tuple[float, float, int]:
    """An interval with eigenvalue ``number`` and as few others as halving can leave, and how many it holds.

    ``low`` has at least ``number`` eigenvalues above it, ``high`` fewer.
    """
    below, over = above(matrix, low), above(matrix, high)
    for _ in range(MOST_HALVINGS):
        if below - over == 1 or high - low <= width:
            break
        middle = (low + high) / 2
        count = above(matrix, middle)
        if count >= number:
            low, below = middle, count
        else:
            high, over = middle, count
    return low, high, below - over


def _refined(matrix: np.ndarray, shift: float, vectors: np.ndarray) -> np.ndarray:
    """One step of inverse iteration, orthonormal."""
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        found = np.linalg.solve(shifted, vectors)
    except np.linalg.LinAlgError:  # an exact eigenvalue; next to it the vector is the same
        found = np.linalg.solve(shifted + np.spacing(np.abs(matrix).max()) * len(matrix) * np.eye(len(matrix)), vectors)
    return np.linalg.qr(found)[0]


def _quotient(matrix: np.ndarray, vector: np.ndarray) -> float:
    return float(vector @ (matrix @ vector))


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit vectors as columns."""
    size = len(matrix)
    count = min(count, size)
    radius = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0
    if not radius:
        return np.zeros(count), np.eye(size)[:, :count]
    width = CLUSTER_WIDTH * radius
    values, vectors = [], np.zeros((size, 0))
    while len(values) < count:
        number = len(values) + 1
        top = radius * 1.01 if not values else values[-1] + width
        low, high, held = _isolated(matrix, number, -radius * 1.01, top, width)
        # The interval's own eigenvalues, and those of the vectors already found that the margin of a cluster holds.
        held = max(1, min(held, size - len(values)))
        found = _vectors(matrix, low, high, number, held, vectors)
        own = [_quotient(matrix, found[:, i]) for i in range(found.shape[1])]
        order = np.argsort(own)[::-1]
        values += [own[i] for i in order]
        vectors = np.column_stack([vectors, found[:, order]])
    return np.array(values[:count]), vectors[:, :count]


def _vectors(matrix: np.ndarray, low: float, high: float, number: int, held: int, known: np.ndarray) -> np.ndarray:
    """Vectors of the ``held`` eigenvalues between ``low`` and ``high``, at right angles to ``known``."""
    size = len(matrix)
    start = np.random.default_rng(number).standard_normal((size, held))
    for attempt in range(MOST_HALVINGS):
        found, shift = start, (low + high) / 2
        for step in range(MOST_STEPS):
            found = found - known @ (known.T @ found)
            found = _refined(matrix, shift, found)
            if held > 1:  # a cluster: its subspace, at one shift
                if step >= 4:
                    break
                continue
            last, shift = shift, _quotient(matrix, found[:, 0])
            if not low <= shift <= high:
                break
            if abs(shift - last) <= 4 * np.finfo(float).eps * abs(shift):
                break
        found = np.linalg.qr(found - known @ (known.T @ found))[0]
        if held > 1:
            own = found.T @ matrix @ found
            return found @ np.linalg.eigh(own)[1]
        if low <= shift <= high and certified(matrix, shift, number):
            return found
        middle = (low + high) / 2
        low, high = (middle, high) if above(matrix, middle) >= number else (low, middle)
    return found


def certified(matrix: np.ndarray, value: float, number: int) -> bool:
    """Whether ``value`` is eigenvalue ``number``: fewer lie above its margin, at least as many above its lower one."""
    margin = 16 * len(matrix) * np.finfo(float).eps * float(np.abs(matrix).sum(axis=1).max())
    return above(matrix, value + margin) < number <= above(matrix, value - margin)
