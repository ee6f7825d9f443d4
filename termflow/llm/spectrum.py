"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The signs of D in A - sI = LDLᵀ say how many eigenvalues lie above s (Sylvester).
Halving by these counts isolates the eigenvalue of a given number; Rayleigh
quotient iteration then converges to it cubically, and counts on both sides of
the result certify its number. Each eigenpair is found alone, so they can be
dealt to tasks.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
ALPHA = (1 + 17**0.5) / 8
#: Eigenvalues closer than this share of the norm are found as one cluster.
CLUSTER = 1e-9
RANDOM = 11


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``matrix`` over ``shift``: positive signs of D.

    Pivots are blocks of one or two rows (Bunch and Kaufman); a block of two has
    one eigenvalue of each sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        below = np.abs(a[1:, 0])
        most = below.max(initial=0.0)
        if most == 0:
            above += a[0, 0] > 0
            a = a[1:, 1:]
            continue
        r = 1 + int(below.argmax())
        pivot, size = abs(a[0, 0]), 1
        if pivot < ALPHA * most:
            beside = np.abs(a[r])
            beside[r] = 0
            widest = beside.max()
            if pivot * widest < ALPHA * most * most:
                if abs(a[r, r]) >= ALPHA * widest:
                    swap = 0
                else:
                    swap, size = 1, 2
                order = np.arange(len(a))
                order[[swap, r]] = r, swap
                a = a[np.ix_(order, order)]
        block, side = a[:size, :size], a[size:, :size]
        above += 1 if size == 2 else int(block[0, 0] > 0)
        a = a[size:, size:] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return int(above)


def towards(matrix: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    """An orthonormal basis of (matrix - shift I)^-1 x."""
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        y = np.linalg.solve(shifted, x)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
        nudge = EPS * max(np.abs(matrix).max(), 1e-300)
        y = np.linalg.solve(shifted - nudge * np.eye(len(matrix)), x)
    return np.linalg.qr(y / np.abs(y).max())[0]


def eigenpair(
    matrix: np.ndarray, number: int
) -> tuple[float, np.ndarray | None]:
    """The eigenvalue with that number, falling from 1, and its unit vector.

    No vector if rounding cannot tell the eigenvalue from another.
    """
    n, norm = len(matrix), float(np.linalg.norm(matrix))
    fuzz = 8 * n * EPS * norm
    low, high = -norm - fuzz, norm + fuzz
    over_low, over_high = n, 0  # counts above both ends

    def halve() -> None:
        nonlocal low, high, over_low, over_high
        middle = (low + high) / 2
        over = count_above(matrix, middle)
        if over >= number:
            low, over_low = middle, over
        else:
            high, over_high = middle, over

    x = np.linalg.qr(np.random.default_rng(RANDOM).normal(size=(n, 1)))[0]
    while high - low > fuzz:
        if over_low - over_high > 1:
            halve()
            continue
        for _ in range(2):
            x = towards(matrix, (low + high) / 2, x)
        value = quotient(matrix, x)
        for _ in range(12):
            if not low <= value <= high:
                break
            residual = float(np.linalg.norm(matrix @ x - value * x))
            x = towards(matrix, value, x)
            value = quotient(matrix, x)
            if residual <= fuzz:
                break
        # Certified: the number is reached between both sides of the value.
        if (
            low <= value <= high
            and count_above(matrix, value - 4 * fuzz) >= number
            and count_above(matrix, value + 4 * fuzz) < number
        ):
            return value, signed(x[:, 0])
        halve()
    return (low + high) / 2, None


def quotient(matrix: np.ndarray, x: np.ndarray) -> float:
    return float((x.T @ matrix @ x)[0, 0])


def with_clusters(
    matrix: np.ndarray, pairs: list[tuple[float, np.ndarray | None]]
) -> list[tuple[float, np.ndarray]]:
    """The pairs, with an orthonormal basis for eigenvalues that lie close.

    A cluster may go on after the last pair; its whole basis is then found.
    """
    n, norm = len(matrix), float(np.linalg.norm(matrix))
    values = [value for value, _ in pairs]
    out, at = [], 0
    while at < len(pairs):
        end = at + 1
        while end < n:
            if end == len(values):
                values.append(eigenpair(matrix, end + 1)[0])
            if values[end - 1] - values[end] > CLUSTER * norm:
                break
            end += 1
        if end - at == 1 and pairs[at][1] is not None:
            out.append(pairs[at])
        else:
            out += _cluster(matrix, sum(values[at:end]) / (end - at), end - at)
        at = end
    return out[: len(pairs)]


def _cluster(
    matrix: np.ndarray, centre: float, size: int
) -> list[tuple[float, np.ndarray]]:
    """Orthonormal eigenvectors of the ``size`` eigenvalues around ``centre``."""
    random = np.random.default_rng(RANDOM).normal(size=(len(matrix), size))
    x = np.linalg.qr(random)[0]
    for _ in range(6):
        x = towards(matrix, centre, x)
    values, turn = np.linalg.eigh(x.T @ matrix @ x)
    found = zip(values[::-1].tolist(), (x @ turn).T[::-1])
    return [(value, signed(axis)) for value, axis in found]


def signed(x: np.ndarray) -> np.ndarray:
    """The unit vector whose greatest component is positive."""
    x = x / np.linalg.norm(x)
    return x if x[np.abs(x).argmax()] > 0 else -x
