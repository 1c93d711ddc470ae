"""Counts of spots in many windows at once: a wavelet matrix over ranks, in NumPy."""

from __future__ import annotations

import numpy as np


class SpotCounts:
    """Spots with weights; :meth:`inside` sums the weights strictly inside windows, in log(spots) steps each."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        order = np.argsort(x, kind="stable")
        self.x, self.y = x[order], np.sort(y)
        # the rank of each spot's y, in the order of x; equal ones in any order
        rank = np.empty(len(y), np.int64)
        rank[np.argsort(y[order], kind="stable")] = np.arange(len(y))
        weight = weight[order]
        self.levels = []
        for bit in reversed(range(max(len(y).bit_length(), 1))):
            high = (rank >> bit) & 1
            zeros = np.r_[0, np.cumsum(1 - high)]
            # weights of the spots whose bit is 0 up to each place
            self.levels.append((bit, zeros, np.r_[0, np.cumsum(weight * (1 - high))]))
            by_bit = np.argsort(high, kind="stable")
            rank, weight = rank[by_bit], weight[by_bit]

    def _below(self, start: np.ndarray, end: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Weights of the spots at places ``start`` to ``end`` in the order of x whose rank is below ``limit``."""
        total = np.zeros(len(limit), np.int64)
        for bit, zeros, weights in self.levels:
            high = ((limit >> bit) & 1).astype(bool)
            total += np.where(high, weights[end] - weights[start], 0)
            start, end = (np.where(high, zeros[-1] + at - zeros[at], zeros[at]) for at in (start, end))
        return total

    def inside(self, minx: np.ndarray, miny: np.ndarray, maxx: np.ndarray, maxy: np.ndarray) -> np.ndarray:
        start = np.searchsorted(self.x, minx, "right")
        end = np.maximum(np.searchsorted(self.x, maxx, "left"), start)
        low = np.searchsorted(self.y, miny, "right")
        high = np.maximum(np.searchsorted(self.y, maxy, "left"), low)
        return self._below(start, end, high) - self._below(start, end, low)
