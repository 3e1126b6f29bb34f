"""An FM-index over a sequence of small integers, in numpy.

All queries are vectorised: many patterns take their backward steps together.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by prefix doubling; a shorter suffix comes first."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    while n and step < 2 * n:
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        sorted_key = key[order]
        fresh[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank = fresh
        if rank.max() == n - 1:
            break
        step *= 2
    return order


class WaveletRanks:
    """A wavelet matrix: per bit level the bits' running counts, so that a rank costs one
    lookup per level."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.bits = max(1, int(size - 1).bit_length())
        current = symbols
        for level in reversed(range(self.bits)):
            bit = (current >> level) & 1
            zeros_before = np.concatenate(([0], np.cumsum(bit == 0))).astype(np.int32)
            self.levels.append((zeros_before, int(zeros_before[-1])))
            current = np.concatenate((current[bit == 0], current[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before position ``at``."""
        low, high = np.zeros_like(at), at
        for level, (zeros, split) in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - level)) & 1) == 1
            low_zeros, high_zeros = zeros[low], zeros[high]
            low = np.where(one, split + low - low_zeros, low_zeros)
            high = np.where(one, split + high - high_zeros, high_zeros)
        return high - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        """The symbol at each position."""
        value = np.zeros_like(at)
        for zeros, split in self.levels:
            here = zeros[at]
            one = zeros[at + 1] == here
            value = 2 * value + one
            at = np.where(one, split + at - here, here)
        return value


class FMIndex:
    """Counts and finds patterns in ``symbols``, integers from 1 to ``size`` - 1 (0 may
    stand in the text as a break, but not in a pattern)."""

    def __init__(self, symbols: np.ndarray, size: int, sample: int = 8):
        n = len(symbols)
        rotations = np.concatenate(([n], suffix_array(symbols)))  # the empty suffix comes first
        shifted = symbols.astype(np.int64) + 1  # 0 is now the end mark
        before = np.where(rotations > 0, shifted[rotations - 1] if n else 0, 0)
        self.ranks = WaveletRanks(before, size + 1)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(before, minlength=size + 1)))).astype(np.int64)
        marked = rotations % sample == 0
        self.marked = marked
        self.marked_before = np.concatenate(([0], np.cumsum(marked)))
        self.sampled = rotations[marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row interval [low, high) of each pattern; patterns are aligned to the right."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.first[-1], np.int64)
        width = patterns.shape[1]
        for back in range(1, width + 1):
            at = np.flatnonzero((lengths >= back) & (low < high))
            if not len(at):
                break
            c = patterns[at, width - back].astype(np.int64) + 1
            low[at] = self.first[c] + self.ranks.rank(c, low[at])
            high[at] = self.first[c] + self.ranks.rank(c, high[at])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back until a sampled row is met."""
        rows = rows.astype(np.int64).copy()
        steps = np.zeros(len(rows), np.int64)
        going = np.flatnonzero(~self.marked[rows])
        while len(going):
            c = self.ranks.symbol(rows[going])
            rows[going] = self.first[c] + self.ranks.rank(c, rows[going])
            steps[going] += 1
            going = going[~self.marked[rows[going]]]
        return self.sampled[self.marked_before[rows]] + steps
