"""Hashed byte n-gram counts and small linear models, in numpy."""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def byte_table(mapping) -> bytes:
    """A ``bytes.translate`` table from a function of byte values."""
    return bytes(mapping(b) for b in range(256))


def gram_counts(text: str, table: bytes, order: int, bits: int) -> np.ndarray:
    """Counts of the text's n-grams in 2**bits slots; the text is framed by one blank.

    Long texts go through in pieces, so that memory stays bounded.
    """
    raw = b" " + text.encode("utf-8", "replace").translate(table) + b" "
    counts = np.zeros(1 << bits, np.int64)
    for at in range(0, max(1, len(raw) - order + 1), PIECE):
        part = np.frombuffer(raw, np.uint8, min(PIECE + order - 1, len(raw) - at), at).astype(np.uint32)
        n = len(part) - order + 1
        if n < 1:
            break
        code = np.zeros(n, np.uint32)
        for k in range(order):
            code += part[k : k + n] * np.uint32(_MIX[k])
        code ^= code >> np.uint32(15)
        code *= np.uint32(_MIX[0])
        counts += np.bincount(code >> np.uint32(32 - bits), minlength=1 << bits)
    return counts


def root_shares(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares: a unit vector, less ruled by the commonest grams."""
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def packed(vector: np.ndarray) -> tuple[bytes, bytes]:
    """Positions and values of the non-zero entries."""
    at = np.flatnonzero(vector)
    return at.astype(np.uint32).tobytes(), vector[at].astype(np.float32).tobytes()


def unpacked(rows, size: int) -> np.ndarray:
    """A dense matrix of rows written by :func:`packed`."""
    matrix = np.zeros((len(rows), size), np.float32)
    for i, (at, values) in enumerate(rows):
        matrix[i, np.frombuffer(at, np.uint32)] = np.frombuffer(values, np.float32)
    return matrix


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def descend(gradient, size: int, rounds: int, step: float) -> np.ndarray:
    """Minimise by Nesterov's accelerated steps from zero."""
    w = np.zeros(size, np.float64)
    ahead = w.copy()
    for t in range(rounds):
        new = ahead - step * gradient(ahead)
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 200) -> np.ndarray:
    """Weights and, last, the intercept of an L2 linear SVM with squared hinge; y is +1 or -1.

    Both classes weigh the same in total, whatever their sizes. Rows of x have unit length.
    """
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))

    def gradient(w):
        slack = np.maximum(0, 1 - y * (x @ w[:-1].astype(np.float32) + w[-1]))
        pull = -2 * weight * y * slack
        return np.append(x.T @ pull.astype(np.float32) + penalty * w[:-1], pull.sum())

    return descend(gradient, x.shape[1] + 1, rounds, 0.25)


def platt(margins: np.ndarray, y: np.ndarray, rounds: int = 50, rows: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset for sigmoid(slope * margin + offset), by damped Newton steps; y is 0 or 1.

    The targets are pulled in from 0 and 1, so the slope stays finite on separable data.
    ``rows`` says how many rows each margin stands for.
    """
    rows = np.ones(len(y)) if rows is None else rows
    up, down = rows[y == 1].sum(), rows[y == 0].sum()
    t = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * margins + b)
        off = rows * (p - t)
        g = np.array([(off * margins).sum(), off.sum()])
        v = rows * p * (1 - p)
        h = np.array([[(v * margins**2).sum(), (v * margins).sum()], [(v * margins).sum(), v.sum()]]) + 1e-3 * np.eye(2)
        change = np.linalg.solve(h, g)
        change *= min(1, 2 / max(1e-12, np.abs(change).max()))
        a, b = a - change[0], b - change[1]
    return float(a), float(b)
