"""Eigenpairs of a symmetric matrix by contour integration (FEAST), counted by inertia.

``top_pairs`` cuts the upper end of the spectrum into intervals of a few eigenvalues each, by
bisection on inertia: the signs of the pivots of ``A - m I`` tell how many eigenvalues lie
above ``m``.  For each interval, a quadrature of ``(z I - A)^-1 Y`` around a circle through
its ends projects ``Y`` onto the interval's eigenvectors, Rayleigh-Ritz extracts them, and the
round is repeated until as many pairs as the inertia counts have converged.
"""

from __future__ import annotations

import numpy as np

ALPHA = (1 + 17 ** 0.5) / 8  # pivot bound of Bunch and Parlett


def above(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``a`` over ``shift``: positive pivots of the LDL factors of ``a - shift I``."""
    m = a - shift * np.eye(len(a))
    count = 0
    while len(m):
        diagonal = np.abs(np.diag(m))
        r = int(diagonal.argmax())
        off = np.abs(m - np.diag(np.diag(m)))
        p, q = divmod(int(off.argmax()), len(m))
        if diagonal[r] >= ALPHA * off[p, q]:
            gone, pivot = [r], m[r, r]
            count += pivot > 0
            rest = np.delete(np.arange(len(m)), gone)
            v = m[rest, r]
            m = m[np.ix_(rest, rest)] - (np.outer(v, v) / pivot if pivot else 0)
        else:  # a pivot block with one positive and one negative eigenvalue
            gone = [p, q]
            count += 1
            rest = np.delete(np.arange(len(m)), gone)
            v = m[np.ix_(rest, gone)]
            m = m[np.ix_(rest, rest)] - v @ np.linalg.solve(m[np.ix_(gone, gone)], v.T)
    return count


def _clear_edge(a: np.ndarray, at: float, margin: float) -> tuple[float, int]:
    """A shift near ``at`` with no eigenvalue within ``margin``, and the eigenvalues over it."""
    for k in range(2 * len(a) + 2):
        edge = at + margin * 3 * (k // 2 + 1) * (-1) ** k if k else at
        low, high = above(a, edge + margin), above(a, edge - margin)
        if low == high:
            return edge, low
    return at, above(a, at)


def _intervals(a: np.ndarray, wanted: int, least: float, most: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), highest first, until ``wanted`` eigenvalues over ``least`` are covered."""
    top = float(np.abs(a).sum(axis=1).max()) * 1.0001
    bottom, total = _clear_edge(a, least, least * 1e-3)
    todo, out, covered = [(bottom, top, 0, total)], [], 0
    while todo and covered < wanted:
        low, high, over_high, over_low = todo.pop()
        inside = over_low - over_high
        if inside == 0:
            continue
        if inside <= most or high - low <= 1e-9 * top:
            out.append((low, high, inside))
            covered += inside
            continue
        # eigenvalues fall off geometrically: split near the geometric mean of the ends
        middle, over_middle = _clear_edge(a, (low * high) ** 0.5 if high > 4 * low else (low + high) / 2, (high - low) * 1e-6)
        if not low < middle < high:
            middle, over_middle = (low + high) / 2, above(a, (low + high) / 2)
        todo += [(low, middle, over_middle, over_low), (middle, high, over_high, over_middle)]
    return out


def _orthonormal(x: np.ndarray) -> np.ndarray:
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    return u[:, s > 1e-13 * s[0]]


def interval_pairs(a: np.ndarray, low: float, high: float, count: int, nodes: int = 8,
                   rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs between ``low`` and ``high``; a wider subspace is tried if some are missed."""
    d, scale = len(a), float(np.abs(a).sum(axis=1).max())
    x, weight = np.polynomial.legendre.leggauss(nodes)
    angle = -np.pi / 2 * (x - 1)
    middle, radius = (low + high) / 2, (high - low) / 2
    size = min(d, max(2 * count, count + 6))
    while True:
        y = np.random.default_rng(17).normal(size=(d, size))
        for _ in range(rounds):
            q = np.zeros_like(y)
            for t, w in zip(angle, weight):
                turn = radius * np.exp(1j * t)
                q += w / 2 * (turn * np.linalg.solve((middle + turn) * np.eye(d) - a, y.astype(complex))).real
            basis = _orthonormal(q)
            values, small = np.linalg.eigh(basis.T @ a @ basis)  # Rayleigh-Ritz
            y = basis @ small
            inside = np.flatnonzero((values > low) & (values < high))
            residual = np.linalg.norm(a @ y[:, inside] - y[:, inside] * values[inside], axis=0)
            good = inside[residual <= 4e-14 * scale * d ** 0.5]
            if len(good) == count == len(inside):
                return values[good], y[:, good]
        if size == d:
            raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, {len(good)} were found")
        size = min(d, 2 * size)


def top_pairs(a: np.ndarray, wanted: int, least: float, most: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues over ``least``, falling, and their unit eigenvectors as columns."""
    d = len(a)
    found = [interval_pairs(a, low, high, n) for low, high, n in _intervals(a, wanted, least, most)]
    if not found:
        return np.zeros(0), np.zeros((d, 0))
    # vectors of neighbouring intervals are made orthogonal by one more Rayleigh-Ritz over all of them
    basis, _ = np.linalg.qr(np.concatenate([v for _, v in found], axis=1))
    values, small = np.linalg.eigh(basis.T @ a @ basis)
    order = np.argsort(-values)[:wanted]
    return values[order], basis @ small[:, order]
