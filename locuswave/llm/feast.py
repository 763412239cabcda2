"""Largest eigenpairs of a small symmetric matrix by FEAST contour integration (numpy, one d x d matrix).

Inertia counts of shifted matrices (symmetric elimination with 1x1 and 2x2 pivots) bisect the axis into an interval that
holds the wanted eigenvalues and no other.  A trial subspace is filtered by Gauss-Legendre quadrature of complex shifted
solves on a circle around the interval, Rayleigh-Ritz takes the eigenpairs of the filtered space, and both repeat until
the residuals are at rounding level.  The number of pairs found has to equal the inertia count: none is missed.
"""

from __future__ import annotations

import numpy as np

NODES = 16
SWEEPS = 30
# Bisection ends when an edge is known this well relative to the spectrum.
EDGE = 1e-13
# Residual relative to the spectrum that needs no further sweep.
SMALL = 1e-15


def above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of ``a`` greater than ``shift``, by Sylvester's law from the pivots of a - shift."""
    m = a - shift * np.eye(len(a))
    count = 0
    ratio = (1 + np.sqrt(17.0)) / 8  # balances the growth of 1x1 and 2x2 pivots
    while len(m):
        size = np.abs(m)
        diagonal = size.diagonal()
        p = int(diagonal.argmax())
        i, j = np.unravel_index(int(size.argmax()), size.shape)
        if size[i, j] == 0:
            break
        if diagonal[p] >= ratio * size[i, j]:
            pivots = [p]
            count += m[p, p] > 0
        else:  # an indefinite pair: one eigenvalue on either side
            pivots = [int(i), int(j)]
            count += 1
        rest = np.setdiff1d(np.arange(len(m)), pivots)
        side = m[np.ix_(rest, pivots)]
        m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(m[np.ix_(pivots, pivots)], side.T)
        m = (m + m.T) / 2
    return int(count)


def _bisect(a: np.ndarray, low: float, high: float, enough, width: float) -> tuple[float, float]:
    """Narrows (low, high), where ``enough(above(low))`` holds and ``enough(above(high))`` does not."""
    while high - low > width:
        middle = (low + high) / 2
        if not low < middle < high:
            break
        low, high = (middle, high) if enough(above(a, middle)) else (low, middle)
    return low, high


def interval(a: np.ndarray, wanted: int, floor: float) -> tuple[float, float, int]:
    """(low, high, inside): the ``wanted`` largest eigenvalues above ``floor``, and those equal to the last of them."""
    top = float(np.abs(a).sum(axis=1).max()) * (1 + 1e-9) + np.finfo(float).tiny
    held = above(a, floor)
    if not held:
        return floor, top, 0
    wanted = min(wanted, held)
    # The wanted-th eigenvalue from below; then the gap beneath it.
    edge, _ = _bisect(a, floor, top, lambda n: n >= wanted, EDGE * top)
    inside = above(a, edge)
    if inside == held:
        return (floor + edge) / 2, top, held
    # Greatest shift with more eigenvalues above it than inside: the next one lies there.
    next_one, _ = _bisect(a, floor, edge, lambda n: n > inside, 1e-3 * (edge - floor))
    return (next_one + edge) / 2, top, inside


def eigenpairs(a: np.ndarray, wanted: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above ``floor``, at most ``wanted``, falling, with unit eigenvectors as columns."""
    low, high, inside = interval(a, wanted, floor)
    if not inside:
        return np.zeros(0), np.zeros((len(a), 0))
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 - points)  # upper half circle; the lower half is its conjugate
    size = min(len(a), 2 * inside + 8)
    basis = np.random.default_rng(0).standard_normal((len(a), size))
    norm = max(abs(low), abs(high))
    previous = np.inf
    for _ in range(SWEEPS):
        filtered = np.zeros_like(basis)
        for angle, weight in zip(angles, weights):
            turn = np.exp(1j * angle)
            solved = np.linalg.solve((centre + radius * turn) * np.eye(len(a)) - a, basis.astype(complex))
            filtered += weight / 2 * (radius * turn * solved).real
        basis, _ = np.linalg.qr(filtered)
        values, turns = np.linalg.eigh(basis.T @ a @ basis)
        basis = basis @ turns
        within = np.flatnonzero((values > low) & (values <= high))
        vectors = basis[:, within]
        residual = float(np.abs(a @ vectors - vectors * values[within]).max()) if len(within) else np.inf
        # At rounding level the residual stops falling.
        if len(within) == inside and (residual <= 1e-10 * norm and residual >= previous / 4 or residual <= SMALL * norm):
            order = within[np.argsort(-values[within], kind="stable")][:wanted]
            return values[order], basis[:, order]
        previous = residual
    raise ArithmeticError(f"contour integration found {len(within)} of {inside} eigenvalues, residual {residual:g}")
