"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST).

An interval of the spectrum is enclosed by a circle. Quadrature of the resolvent
around it, a few complex shifted solves, projects a random block onto the
eigenvectors inside; Rayleigh-Ritz on the projected block gives eigenpairs, and
the block is projected again until their residuals vanish. The inertia of
shifted matrices says beforehand how many eigenvalues each interval holds, so
none can be missed: a count that differs enlarges the block or fails.
"""

from __future__ import annotations

import numpy as np

NODES = 8  # quadrature nodes on the upper half circle
ROUNDS = 40
EXACT = 5e-14  # residual, relative to the matrix and the root of its order
FINE, TIGHT = 1e-12, 1e-8  # precision of the bisection; gap that parts two clusters


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix (Householder)."""
    a = np.array(a, dtype=np.float64)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            continue
        x[0] += size if x[0] >= 0 else -size
        x /= np.linalg.norm(x)
        p = a[k + 1:, k + 1:] @ x
        w = 2 * (p - (x @ p) * x)
        a[k + 1:, k + 1:] -= np.outer(x, w) + np.outer(w, x)
        a[k + 1, k] = -np.copysign(size, x[0])
        a[k + 2:, k] = 0
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``: the positive pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, pivot = 0, 1.0
    for k in range(len(diagonal)):
        pivot = diagonal[k] - shift - (off[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


def intervals(count, n: int, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) for each cluster among the ``wanted`` largest
    eigenvalues of a matrix of norm 1, the last cluster whole.

    Inertia counts place the eigenvalues by bisection. A bound lies half a gap
    away from its cluster, so everything outside the circle is at least about
    two radii from its centre and is damped by 2^(2 NODES) a round.
    """
    found: list[float] = []
    while len(found) < n and (len(found) <= wanted or found[-2] - found[-1] <= TIGHT):
        low, high = -1.1, 1.1
        while high - low > FINE:
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) > len(found) else (low, middle)
        found.append((low + high) / 2)
    starts = [k for k in range(len(found)) if not k or found[k - 1] - found[k] > TIGHT]
    out = []
    for start, end in zip(starts, [*starts[1:], len(found)]):
        if start < wanted:
            gaps = [found[start - 1] - found[start]] if start else []
            gaps += [found[end - 1] - found[end]] if end < len(found) else []
            gap = min(gaps, default=1.0) / 2
            low, high = found[end - 1] - gap, found[start] + gap
            if count(low) - count(high) != end - start:
                raise ArithmeticError(f"{count(low) - count(high)} eigenvalues between {low} and {high}, {end - start} by bisection")
            out.append((low, high, end - start))
    return out


def _inside(a: np.ndarray, low: float, high: float, inside: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``inside`` eigenpairs between low and high of a matrix of norm 1."""
    n = len(a)
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi / 2 * (x + 1))  # the upper half circle; the lower one gives the conjugate
    nodes, weights = (low + high) / 2 + (high - low) / 2 * turn, (high - low) / 4 * w * turn
    rng = np.random.default_rng(seed)
    basis, last = rng.standard_normal((n, min(n, inside + 2))), np.inf
    for _ in range(ROUNDS):
        projected = sum((weight * np.linalg.solve(z * np.eye(n) - a, basis)).real for z, weight in zip(nodes, weights))
        basis, _ = np.linalg.qr(projected)
        small = basis.T @ (a @ basis)
        values, rotation = np.linalg.eigh((small + small.T) / 2)
        basis = basis @ rotation
        here = np.flatnonzero((values > low) & (values < high))
        residual = np.linalg.norm(a @ basis[:, here] - basis[:, here] * values[here], axis=0).max(initial=0.0)
        if len(here) == inside and residual <= EXACT * np.sqrt(n) and residual >= last / 2:  # falls no more
            return values[here], basis[:, here] / np.linalg.norm(basis[:, here], axis=0)
        last = residual if len(here) == inside else np.inf
        if len(here) < inside and basis.shape[1] < n:  # the inertia counts more than the block has found
            basis = np.hstack([basis, rng.standard_normal((n, min(4, n - basis.shape[1])))])
    raise ArithmeticError(f"{len(here)} eigenpairs between {low} and {high}, {inside} by inertia, residual {residual}")


def largest(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    n = len(a)
    wanted = min(wanted, n)
    size = float(np.abs(a).sum(axis=1).max(initial=0.0))
    if not wanted or size == 0:
        return np.zeros(wanted), np.eye(n)[:, :wanted]
    scaled = a / size
    diagonal, off = tridiagonal(scaled)
    found = intervals(lambda shift: above(diagonal, off, shift), n, wanted)
    basis, _ = np.linalg.qr(np.hstack([_inside(scaled, *x, seed)[1] for seed, x in enumerate(found)]))
    small = basis.T @ (scaled @ basis)  # once more over all clusters, which makes them orthogonal
    values, rotation = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order] * size, (basis @ rotation)[:, order]
