"""Gradient, weight and row counts per (node, feature, bin), and the splits they give.

Shared by boosted trees and forests, whether tasks count their share of a large table or
one task counts a small one.
"""

from __future__ import annotations

import numpy as np

# Splits must gain more than this, whatever the split penalty.
LEAST_GAIN = 1e-6
# Gains this close, relative to the best, are equal: sums differ in the last digits with their order.
TIE = 1e-9
GRAD, WEIGHT, ROWS = range(3)


def count_cells(offsets: np.ndarray, at: np.ndarray, grad: np.ndarray, weight: np.ndarray | None, nodes: int, shape: tuple[int, int]) -> np.ndarray:
    """(node, measure, feature, bin) of rows at node ``at``. ``offsets`` holds feature * bins
    + bin per row and feature; without ``weight`` every row weighs one."""
    features, bins = shape
    cell = (at[:, None] * (features * bins) + offsets).ravel()
    size = nodes * features * bins

    def summed(values: np.ndarray | None) -> np.ndarray:
        return np.bincount(cell, None if values is None else np.repeat(values, features), size)

    rows = summed(None).astype(float)
    found = np.stack([summed(grad), rows if weight is None else summed(weight), rows])
    return found.reshape(3, nodes, features, bins).swapaxes(0, 1)


def best_splits(
    cells: np.ndarray, lam: float = 0.0, alpha: float = 0.0, least: float = 1.0, allowed: np.ndarray | None = None, least_gain: float = LEAST_GAIN
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature slot, bin, gain, measures to the left) of each node's best split; the slot
    is -1 if none gains. The first feature and the lowest bin win a tie. ``allowed`` masks
    (node, feature)."""
    left = cells.cumsum(axis=3)
    whole = left[:, :, :1, -1:]
    right = whole - left

    def score(m):
        shrunk = np.abs(m[:, GRAD])
        if alpha:
            shrunk = np.maximum(shrunk - alpha, 0.0)  # the sign is lost to the square
        weight = m[:, WEIGHT] + lam
        return np.divide(shrunk * shrunk, weight, out=np.zeros_like(shrunk), where=weight > 0)

    gain = score(left) + score(right) - score(whole)
    fits = (left[:, ROWS] >= max(least, 0.5)) & (right[:, ROWS] >= max(least, 0.5))
    if allowed is not None:
        fits &= allowed[:, :, None]
    gain = np.where(fits, gain, -np.inf).reshape(len(cells), -1)
    most = gain.max(axis=1)
    tied = gain >= (most - TIE * np.abs(most))[:, None]
    chosen = tied.argmax(axis=1)
    slot, place = np.divmod(chosen, cells.shape[3])
    nodes = np.arange(len(cells))
    slot = np.where(most > least_gain, slot, -1)
    return slot, place, gain[nodes, chosen], left[nodes, :, slot, place]
