"""The largest eigenpairs of a symmetric matrix that is known by its products only.

Block Jacobi-Davidson: Rayleigh-Ritz in a subspace gives approximations; for each that is not yet good the correction
equation, projected off all approximations, is solved roughly by MINRES and its solution joins the subspace. All
equations take their steps together, so that a step is one product with a block of vectors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

Product = Callable[[np.ndarray], np.ndarray]

EPS = np.finfo(np.float64).eps
#: A residual is good when it is at most so many units of rounding of the largest eigenvalue.
UNITS = 64
#: Steps of MINRES for one correction.
INNER_STEPS = 4
#: The subspace is cut back to the best approximations when it has this many times the wanted vectors.
ROOM = 6
#: The method stops with an error when so many rounds did not bring all residuals down.
ROUNDS = 200


@dataclass(frozen=True)
class Eigenpairs:
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    rounds: int
    products: int


def _orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal ``basis``."""
    sizes = np.linalg.norm(new, axis=0)
    kept = new[:, sizes > 0] / sizes[sizes > 0]
    for _ in range(3):
        kept = kept - basis @ (basis.T @ kept)
        if not kept.shape[1]:
            break
        kept, strength, _ = np.linalg.svd(kept, full_matrices=False)
        # What is left of a vector that lies in the basis is rounding.
        kept = kept[:, strength > 1e-10 * max(strength[0], 1e-4)]
    return kept


def minres(product: Product, shifts: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions t of (A - shift) t = right, for each column by itself; ``product`` gives A times a block.

    Lanczos vectors and Givens rotations of all columns go forward together. A column that is solved stands still.
    """
    n, m = right.shape
    beta = np.linalg.norm(right, axis=0)
    alive = beta > 0
    v_old, v = np.zeros((n, m)), right / np.where(alive, beta, 1)
    solution, w_old, w_older = np.zeros((n, m)), np.zeros((n, m)), np.zeros((n, m))
    cos_old, cos, sin_old, sin = np.ones(m), np.ones(m), np.zeros(m), np.zeros(m)
    eta, next_beta = beta.copy(), np.zeros(m)
    first = beta.copy()
    for _ in range(steps):
        if not alive.any():
            break
        image = product(v * alive) - shifts * v
        alpha = (v * image).sum(axis=0)
        image = image - alpha * v - next_beta * v_old
        beta_new = np.linalg.norm(image, axis=0)
        # The last column of the triangle: two earlier rotations, then the one that clears beta_new.
        rho_plain = cos * alpha - cos_old * sin * next_beta
        rho = np.hypot(rho_plain, beta_new)
        rho_1 = sin * alpha + cos_old * cos * next_beta
        rho_2 = sin_old * next_beta
        alive = alive & (rho > 0)
        safe = np.where(rho > 0, rho, 1)
        w = (v - rho_2 * w_older - rho_1 * w_old) / safe
        cos_old, sin_old = cos, sin
        cos, sin = rho_plain / safe, beta_new / safe
        solution = solution + np.where(alive, cos * eta, 0) * w
        eta = -sin * eta
        w_older, w_old = w_old, w
        alive = alive & (beta_new > 1e-14 * np.abs(alpha)) & (np.abs(eta) > 1e-14 * first)
        v_old, v = v, image / np.where(beta_new > 0, beta_new, 1)
        next_beta = beta_new
    return solution


def largest_eigenpairs(product: Product, dims: int, count: int, steps: int = INNER_STEPS, seed: int = 0) -> Eigenpairs:
    """The ``count`` largest eigenvalues (falling) and unit eigenvectors of a symmetric matrix of ``dims`` rows.

    ``product`` gives the matrix times a block of columns. Approximations whose residual is at rounding (``UNITS``) are
    locked: they stay in the subspace and are projected off all corrections, but get none themselves. Ends when all are.
    Held in memory: two blocks of ``dims`` by ``ROOM`` * ``count`` numbers.
    """
    count = min(count, dims)
    made = 0

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal made
        made += 1
        return product(block)

    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.standard_normal((dims, min(dims, 2 * count))))[0]
    images = times(basis)
    for rounds in range(1, ROUNDS + 1):
        small = basis.T @ images
        values, inside = np.linalg.eigh((small + small.T) / 2)
        values, inside = values[::-1], inside[:, ::-1]
        ritz, moved = basis @ inside[:, :count], images @ inside[:, :count]
        theta = values[:count]
        left = moved - ritz * theta
        residuals = np.linalg.norm(left, axis=0)
        bad = residuals > UNITS * EPS * max(abs(values[0]), np.finfo(np.float64).tiny)
        if not bad.any():
            return Eigenpairs(theta, ritz, residuals, rounds, made)
        if basis.shape[1] > (ROOM - 1) * count and basis.shape[1] < dims:
            kept = inside[:, : 2 * count]
            basis, images = basis @ kept, images @ kept
        off = lambda block: block - ritz @ (ritz.T @ block)  # noqa: E731, B023
        found = minres(lambda block: off(times(off(block))), theta[bad], -off(left[:, bad]), steps)
        # Where a correction adds nothing new, the residual itself may.
        more = _orthonormal(np.hstack([found, left[:, bad]]) if basis.shape[1] + 2 * bad.sum() <= dims else found, basis)
        if not more.shape[1]:
            # The subspace is everything that products can reach: only rounding is left. Once more from clean images.
            basis = np.linalg.qr(ritz if basis.shape[1] < dims else basis)[0]
            images = times(basis)
            continue
        basis, images = np.hstack([basis, more]), np.hstack([images, times(more)])
    raise ArithmeticError(f"{int(bad.sum())} of {count} residuals are above rounding after {ROUNDS} rounds: {residuals.max():.3g} of {values[0]:.3g}")
