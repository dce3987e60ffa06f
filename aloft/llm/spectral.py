"""Eigenvectors of a symmetric matrix by QDWH spectral divide and conquer (Nakatsukasa and Higham).

The polar factor U of A - shift*I has eigenvalue 1 where A's eigenvalue lies above the
shift and -1 where it lies below, so (U + I)/2 is the projector on the upper invariant
subspace.  An orthonormal basis of it and of its complement split A into two
smaller matrices, which are split in the same way until they are multiples of I.
The polar factor comes from the dynamically weighted Halley iteration, which needs
a QR decomposition a step and at most about six steps.

The matrix is as large as the vectors are long; it never grows with the rows.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix."""
    n = len(a)
    top = np.linalg.norm(a)
    if not top:
        return np.eye(n)
    x = a / top
    r = np.linalg.qr(x, mode="r")
    if np.abs(np.diag(r)).min() > EPS * EPS:
        low = 1 / (np.sqrt(n) * np.linalg.norm(np.linalg.inv(r), 1))     # not above the least singular value
    else:
        low = 0.0
    low = min(1.0, max(low, EPS * EPS))
    for _ in range(40):
        if 1 - low < 10 * EPS:
            break
        d = np.cbrt(4 * (1 - low * low) / low**4)
        h = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(n)]))[0]
        x = (b / c) * x + (h - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        x = (x + x.T) / 2
        low = min(1.0, low * (h + b * low * low) / (1 + c * low * low))
    # a last Newton-Schulz step: orthogonal to the last bit also where the bound was too good
    return x @ (3 * np.eye(n) - x @ x) / 2


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below ``shift``, if the shift separates them."""
    n = len(a)
    upper = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = np.trace(upper)
    k = int(round(rank))
    if abs(rank - k) > 1e-8 * n or not 0 < k < n:
        return None
    basis = np.random.default_rng(n).normal(size=(n, k))
    for _ in range(2):                                        # the second pass takes out what the first left
        basis = np.linalg.qr(upper @ basis)[0]
    whole = np.linalg.qr(basis, mode="complete")[0]
    high, rest = whole[:, :k], whole[:, k:]
    if np.linalg.norm(rest.T @ a @ high) > 1e-12 * n * np.linalg.norm(a):
        return None
    return high, rest


def _divide(a: np.ndarray, scale: float) -> np.ndarray:
    n = len(a)
    mean = np.trace(a) / n
    spread = a - mean * np.eye(n)
    if n == 1 or np.linalg.norm(spread) <= n * EPS * scale:
        return np.eye(n)
    # shifts to try: the middle of the diagonal for balance, the mean (always strictly inside), and near it
    step = np.linalg.norm(spread) / n
    for shift in (float(np.median(np.diag(a))), mean, mean + step / 7, mean - step / 7, mean + step / 3, mean - step / 3):
        parts = _split(a, shift)
        if parts is not None:
            out = []
            for basis in parts:
                inner = basis.T @ a @ basis
                out.append(basis @ _divide((inner + inner.T) / 2, scale))
            return np.hstack(out)
    raise np.linalg.LinAlgError("no shift separates the spectrum")


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): falling eigenvalues of a symmetric matrix and unit eigenvectors as columns."""
    a = np.asarray(a, dtype=float)
    if not len(a):
        return np.zeros(0), np.zeros((0, 0))
    vectors = _divide((a + a.T) / 2, float(np.linalg.norm(a)))
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]
