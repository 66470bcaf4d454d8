"""Eigenvectors of a symmetric matrix by spectral divide and conquer over polar decompositions.

The polar factor of a shifted matrix tells eigenvalues above the shift from those below. It gives a
projector on the upper ones, an orthonormal basis of both invariant subspaces, and two smaller
matrices to go on with. Polar factors come from the dynamically weighted Halley iteration in its
inverse-free form (a QR decomposition a step).

The matrices are as wide as vectors are long, however many vectors there are.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: A singular value this small against the largest is as good as none.
LEAST = 1e-18
MAX_STEPS = 30
#: What may be left between two subspaces, against the norm of the whole, without another shift.
LEFT_OVER = 64 * EPS


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: its eigenvalues turned to 1 and -1."""
    k = len(a)
    scale = np.linalg.norm(a)  # at least the largest singular value
    if scale == 0:
        return np.eye(k)
    x, low = a / scale, LEAST
    for _ in range(MAX_STEPS):
        # Weights that raise the least singular value the most, from a lower bound of it.
        d = np.cbrt(4 * (1 - low * low) / low**4)
        root = np.sqrt(1 + d)
        h = root + np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * root), 0)) / 2
        h_2 = (h - 1) ** 2 / 4
        c = h + h_2 - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(k)]))
        after = (h_2 / c) * x + (h - h_2 / c) / np.sqrt(c) * (q[:k] @ q[k:].T)
        after = (after + after.T) / 2
        low = min(low * (h + h_2 * low * low) / (1 + c * low * low), 1.0)
        moved = np.linalg.norm(after - x)
        x = after
        if 1 - low < 8 * EPS and moved <= np.cbrt(EPS):
            break
    return x


def _shifts(a: np.ndarray):
    """Shifts to try, the likeliest to halve the spectrum first. The mean of the diagonal always
    lies between the least and the greatest eigenvalue."""
    diagonal = np.sort(np.diag(a))
    yield float(np.median(diagonal))
    yield float(diagonal.mean())
    gaps = np.argsort(np.diff(diagonal))[::-1]
    for g in gaps[:8]:
        yield float((diagonal[g] + diagonal[g + 1]) / 2)
    radius = np.abs(a).sum(axis=1).max()
    for part in (0.25, 0.75, 0.1, 0.9):
        yield float(diagonal.mean() + (part - 0.5) * radius)


def _split(a: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the upper and the lower invariant subspace; None if no shift parts them."""
    k, best, least = len(a), None, np.inf
    start = np.random.default_rng(k).standard_normal((k, k))
    for shift in _shifts(a):
        u = polar_factor(a - shift * np.eye(k))
        upper = round((np.trace(u) + k) / 2)
        if not 0 < upper < k:
            continue
        projector = (u + np.eye(k)) / 2
        # A start at random and one more step: the range of the projector, then what is normal to it.
        basis = np.linalg.qr(projector @ start[:, :upper])[0]
        full = np.linalg.qr(projector @ basis, mode="complete")[0]
        above, below = full[:, :upper], full[:, upper:]
        left = np.linalg.norm(below.T @ a @ above)
        if left < least:
            best, least = (above, below), left
        if left <= LEFT_OVER * norm:
            break
    return best


def leading_eigenvectors(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors
    as columns (all, if there are fewer). Subspaces below the wanted ones are not split further."""
    a = (a + a.T) / 2
    norm = float(np.linalg.norm(a))
    k, values, vectors = len(a), [], []

    def descend(part: np.ndarray, basis: np.ndarray) -> None:
        """Eigenpairs of ``part``, the matrix within the columns of ``basis``, from the greatest on."""
        size = len(part)
        if len(values) >= count or not size:
            return
        mean = np.trace(part) / size
        halves = None
        if size > 1 and np.linalg.norm(part - mean * np.eye(size)) > 8 * EPS * norm:
            halves = _split(part, norm)
        if halves is None:  # one vector, or a subspace of equal eigenvalues, where any basis will do
            values.extend(np.diag(part))
            vectors.extend(basis.T)
            return
        for half in halves:
            inner = half.T @ part @ half
            descend((inner + inner.T) / 2, basis @ half)

    descend(a, np.eye(k))
    order = np.argsort(values, kind="stable")[::-1][:count]
    w = np.array(vectors).reshape(len(values), k)[order].T
    return np.array(values, dtype=np.float64)[order], w
