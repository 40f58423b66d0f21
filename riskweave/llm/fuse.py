"""Static binary fuse filters over 64-bit keys, built and probed with numpy."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


@dataclass
class FuseFilter:
    """Every key of the set passes; of others about one in 256."""

    seed: int
    segment: int
    segments: int
    prints: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """From distinct keys; no keys give a filter that nothing passes."""
        n = len(keys)
        if n == 0:
            return cls(0, 1, 0, np.zeros(0, np.uint8))
        segment = 1 << max(2, min(18, int(math.log(n) / math.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
        segments = max(1, -(-int(n * factor) // segment) - 2) if n > 1 else 1
        for seed in range(1, 200):
            filled = cls(seed, segment, segments, np.zeros((segments + 2) * segment, np.uint8))._fill(keys)
            if filled is not None:
                return filled
            segments += seed % 8 == 0  # small sets may need some more room
        raise ValueError("keys must be distinct")

    def _places(self, h: np.ndarray) -> np.ndarray:
        first = ((h >> np.uint64(32)) * np.uint64(self.segments * self.segment)) >> np.uint64(32)
        mask, one = np.uint64(self.segment - 1), np.uint64(self.segment)
        second = (first + one) ^ ((h >> np.uint64(18)) & mask)
        third = (first + one + one) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64)

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)

    def _fill(self, keys: np.ndarray) -> FuseFilter | None:
        """Peel keys that are alone in a place, round by round; then set prints in the opposite order."""
        h = _mixed(keys, self.seed)
        places, size = self._places(h), len(self.prints)
        count = np.bincount(places.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)
        numbers = np.arange(len(keys))
        for row in places:
            np.bitwise_xor.at(owner, row, numbers)
        left, rounds = len(keys), []
        alone = np.flatnonzero(count == 1)
        while len(alone):
            peeled, at = np.unique(owner[alone], return_index=True)
            alone = alone[at]
            rounds.append((peeled, alone))
            left -= len(peeled)
            touched = places[:, peeled]
            np.subtract.at(count, touched.ravel(), 1)
            np.bitwise_xor.at(owner, touched.ravel(), np.tile(peeled, 3))
            touched = np.unique(touched)
            alone = touched[count[touched] == 1]
        if left:
            return None
        prints = self._print(h)
        for peeled, at in reversed(rounds):  # places of one round are read by no other key of that round
            self.prints[at] = 0
            seen = self.prints[places[:, peeled]]
            self.prints[at] = prints[peeled] ^ seen[0] ^ seen[1] ^ seen[2]
        return self

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.prints):
            return np.zeros(len(keys), bool)
        h = _mixed(keys, self.seed)
        seen = self.prints[self._places(h)]
        return seen[0] ^ seen[1] ^ seen[2] == self._print(h)
