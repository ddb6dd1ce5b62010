"""Minimal perfect hashing of 64-bit keys, with fingerprints."""

from __future__ import annotations

import numpy as np

#: Bits of a level for each key that is still without a place.
ROOM = 1.5
#: Keys are distinct, so each level places a fixed share; this is never met.
MOST_LEVELS = 200
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def mixed(keys: np.ndarray, turn: int = 0) -> np.ndarray:
    """64-bit hashes of 64-bit keys, distinct for distinct keys."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((turn + 1) * _STEP % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Keys to the numbers 0 to n - 1, one each, in under four bits a key.

    A key's place is where its hash falls in the first level at which no other
    remaining key falls there; the rank of that bit is its number. Any key gets
    a number, or none; the 32-bit fingerprint at the number tells whether it is
    one of those the index was built from, and is wrong for one stranger in
    four thousand million.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray, prints: np.ndarray):
        self.sizes, self.words, self.prints = sizes, words, prints
        self.first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """The index of distinct ``keys``."""
        sizes, levels, left = [], [], keys
        while len(left):
            if len(sizes) == MOST_LEVELS:
                raise ValueError("keys are not distinct")
            size = -(-int(len(left) * ROOM + 1) // 64) * 64
            at = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            levels.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone]
        words = np.concatenate(levels) if levels else np.zeros(0, "<u8")
        found = cls(np.array(sizes, "<u8"), words, np.zeros(len(keys), "<u4"))
        found.prints[found.numbers(keys)] = cls._print(keys)
        return found

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys, MOST_LEVELS) >> np.uint64(32)).astype("<u4")

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 where no level has a place for it."""
        found = np.full(len(keys), -1, np.int64)
        waiting = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(waiting):
                break
            at = self.first[level] + (mixed(keys[waiting], level)
                                      % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = word[here] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            found[waiting[here]] = (self.before[at[here] >> 6]
                                    + np.bitwise_count(below).astype(np.int64))
            waiting = waiting[~here]
        return found

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key the index was built from, -1 for others."""
        found = self.numbers(keys)
        found[found >= 0] = np.where(
            self.prints[found[found >= 0]] == self._print(keys[found >= 0]),
            found[found >= 0], -1)
        return found

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.words), len(self.prints)], "<u8")
        return b"".join(x.tobytes() for x in (head, self.sizes, self.words, self.prints))

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        levels, words, keys = (int(x) for x in np.frombuffer(data, "<u8", 3))
        return cls(np.frombuffer(data, "<u8", levels, 24),
                   np.frombuffer(data, "<u8", words, 24 + 8 * levels),
                   np.frombuffer(data, "<u4", keys, 24 + 8 * (levels + words)))
