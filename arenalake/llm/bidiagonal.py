"""Eigenvectors of R'R for a triangular R, without forming R'R.

Householder reflections make R bidiagonal, B. The shifted quotient-difference algorithm (dqds) finds
the squares of B's singular values to high relative accuracy. Each direction comes from the twisted
factorisation of B'B - lambda at the index where its middle pivot is smallest.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and the right reflections V with R = U B V'."""
    a, n = r.astype(float).copy(), r.shape[1]
    right = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray:
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(v)
        return v / size if size else v

    for k in range(n):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def dqds_sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One transform of the qd array; its least pivot; nothing if the shift was too large."""
    d, least, new_q, new_e = q[0] - shift, q[0] - shift, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        top = d + e[k]
        ratio = q[k + 1] / top if top else 0.0
        new_q.append(top)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    return [*new_q, d], new_e, least


def dqds(diagonal: np.ndarray, superdiagonal: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling."""
    found: list[float] = []
    parts = [((diagonal * diagonal).tolist(), (superdiagonal * superdiagonal).tolist(), 0.0)]
    while parts:
        q, e, moved = parts.pop()
        while q:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * (moved + min(q[k], q[k + 1]))), None)
            if cut is not None and cut < len(e) - 1:  # falls into two
                parts.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if len(q) == 1 or cut is not None:  # the last value stands alone
                found.append(moved + q.pop())
                e = e[:-1]
                continue
            if q[0] < q[-1]:  # small values converge at the end
                q, e = q[::-1], e[::-1]
            # The smaller eigenvalue of the last two rows, less what couples them to the rest.
            mean, product = (q[-1] + q[-2] + e[-1]) / 2, q[-1] * q[-2]
            root = np.sqrt(max(mean * mean - product, 0.0))
            shift = product / (mean + root) if mean + root else 0.0
            shift = float(max(0.0, shift - (np.sqrt(e[-2] * shift) if len(e) > 1 else 0.0)))
            while (done := dqds_sweep(q, e, shift)) is None:
                shift = shift / 4 if shift > EPS * (moved + q[-1]) else 0.0
            q, e, _ = done
            moved += shift
    return np.array(sorted(found, reverse=True))


def twisted(diagonal: np.ndarray, superdiagonal: np.ndarray, value: float, choice: int = 0) -> np.ndarray:
    """Unit eigenvector of B'B for ``value``; ``choice`` takes the next best index to twist at."""
    n = len(diagonal)
    tiny = EPS * EPS * max(float(np.abs(diagonal).max()), 1e-150)
    a = np.where(np.abs(diagonal) < tiny, tiny, diagonal)
    d, low = a * a, superdiagonal / a[:-1]
    scale = EPS * EPS * max(float(d.max()), value)

    def pivot(x: float) -> float:
        return x if abs(x) > scale else float(np.copysign(scale, x))

    for _ in range(3):
        s, p, down, up = np.empty(n), np.empty(n), np.empty(n - 1), np.empty(n - 1)
        s[0], p[-1] = -value, d[-1] - value
        for i in range(n - 1):  # stationary, from the top
            down[i] = d[i] * low[i] / pivot(s[i] + d[i])
            s[i + 1] = down[i] * low[i] * s[i] - value
        for i in range(n - 2, -1, -1):  # progressive, from the bottom
            ratio = d[i] / pivot(d[i] * low[i] * low[i] + p[i + 1])
            up[i] = low[i] * ratio
            p[i] = p[i + 1] * ratio - value
        gamma = s + p + value
        at = int(np.argsort(np.abs(gamma), kind="stable")[min(choice, n - 1)])
        z = np.zeros(n)
        z[at] = 1.0
        for i in range(at - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(at, n - 1):
            z[i + 1] = -up[i] * z[i]
        size = float(z @ z)
        step = float(gamma[at]) / size
        if choice or abs(step) <= 4 * EPS * value:
            break
        value += step  # Rayleigh's correction
    return z / np.sqrt(size)


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``count`` greatest eigenvalues of R'R, unit eigenvectors as columns, and the trace.

    Values of no more than the rounding of the greatest one are left out: R has no direction there.
    """
    scale = float(np.abs(r).max()) if r.size else 0.0
    n = r.shape[1]
    if not scale:
        return np.empty(0), np.empty((n, 0)), 0.0
    square = np.linalg.qr(r / scale, mode="r")
    square = np.vstack([square, np.zeros((n - len(square), n))]) if len(square) < n else square
    diagonal, superdiagonal, right = bidiagonalise(square)
    limit = EPS * float(max(np.abs(diagonal).max(), np.abs(superdiagonal).max(initial=0)))
    ends = [0, *(k + 1 for k in range(n - 1) if abs(superdiagonal[k]) <= limit), n]
    pairs = []  # a matrix that falls apart is solved part by part
    for begin, end in zip(ends, ends[1:]):
        pairs += [(value, begin, end) for value in dqds(diagonal[begin:end], superdiagonal[begin : end - 1])]
    pairs.sort(key=lambda x: (-x[0], x[1]))
    greatest = pairs[0][0]
    values, vectors = [], []
    for value, begin, end in pairs[:count]:
        if value <= n * EPS * greatest:
            break
        for choice in range(end - begin):
            z = np.zeros(n)
            z[begin:end] = twisted(diagonal[begin:end], superdiagonal[begin : end - 1], value, choice)
            for _ in range(2):  # equal values share a space of directions
                for known in vectors:
                    z -= known * (known @ z)
            if (left := np.linalg.norm(z)) > 0.1:
                break
        values.append(value)
        vectors.append(z / left)
    found = right @ np.array(vectors).T
    return np.array(values) * scale**2, found, float((square**2).sum()) * scale**2
