"""A minimal perfect hash of 128-bit digests: every digest of a set has a slot of its own, and there are no others."""

from __future__ import annotations

import numpy as np

from linkrank.llm.shingles import mix

#: Bits a level has for each digest it gets.
SPREAD = 1.5
MOST_LEVELS = 100


class PerfectHash:
    """Slots 0 to n - 1 for n digests, given as two columns of 64-bit numbers.

    A level is a row of bits. Digests that hash to a bit of their own in the first level are
    placed there, the others go to the next, smaller one, until none is left. A digest's slot
    is the rank of its bit. A digest that is not of the set may find a bit too, so the set's
    digests are kept by slot, and ``find`` compares them.
    """

    def __init__(self, digests: np.ndarray):
        digests = digests.astype(np.uint64, copy=False)
        self.levels: list[tuple[int, np.ndarray]] = []
        left, placed = digests, 0
        while len(left):
            if len(self.levels) == MOST_LEVELS:
                raise ValueError("digests repeat")
            size = max(4, int(SPREAD * len(left)))
            at = self._places(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            # The slot of a bit that is set, else -1.
            slots = np.where(alone, placed + np.cumsum(alone) - 1, -1)
            self.levels.append((size, slots))
            placed += int(alone.sum())
            left = left[~alone[at]]
        self.digests = np.zeros_like(digests)
        if len(digests):
            self.digests[self._slots(digests)] = digests

    @staticmethod
    def _places(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(digests[:, 0] ^ mix(digests[:, 1], 31 + level), 57 + level) % np.uint64(size)).astype(np.int64)

    def _slots(self, digests: np.ndarray) -> np.ndarray:
        out = np.full(len(digests), -1, dtype=np.int64)
        todo = np.arange(len(digests))
        for level, (size, slots) in enumerate(self.levels):
            found = slots[self._places(digests[todo], level, size)]
            out[todo[found >= 0]] = found[found >= 0]
            todo = todo[found < 0]
        return out

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for those that are not of the set."""
        digests = digests.astype(np.uint64, copy=False)
        out = self._slots(digests)
        known = np.flatnonzero(out >= 0)
        wrong = (self.digests[out[known]] != digests[known]).any(axis=1)
        out[known[wrong]] = -1
        return out
