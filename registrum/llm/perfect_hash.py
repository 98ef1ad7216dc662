"""Minimal perfect hashing of 64-bit keys, built in pieces by Spark tasks.

A piece holds the keys whose hash falls to it. Within it, levels of bits are filled: a key takes
its place in a level if no other key left over wants it, the others go to the next level. The
rank of a key's bit is its number; all pieces together number n keys 0 to n - 1 without gaps.
Every number keeps its key, so a key that was not in the set is told from one that was.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROOM = 1.5  # places per key left over in a level
LEVELS = 40
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit keys."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(_MIX[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(_MIX[1])
    x ^= x >> np.uint64(31)
    return x


def piece_of(keys: np.ndarray, pieces: int) -> np.ndarray:
    return (mixed(keys, 1000) % np.uint64(pieces)).astype(np.int64)


def build_piece(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The levels (words of 64 bits) and the keys in the order of their numbers."""
    left = np.asarray(keys, np.uint64)
    levels, ordered = [], []
    while len(left):
        if len(levels) == LEVELS:
            raise ValueError("keys repeat")
        words = -(-int(len(left) * ROOM) // 64) + 1
        want = (mixed(left, len(levels)) % np.uint64(words * 64)).astype(np.int64)
        alone = np.bincount(want, minlength=words * 64)[want] == 1
        bits = np.zeros(words * 64, np.uint8)
        bits[want[alone]] = 1
        levels.append(np.packbits(bits, bitorder="little").view("<u8"))
        placed = left[alone]
        ordered.append(placed[np.argsort(want[alone])])
        left = left[~alone]
    return levels, np.concatenate(ordered) if ordered else np.empty(0, np.uint64)


@dataclass
class PerfectHash:
    """Pieces side by side: level l of piece p has ``sizes[l, p]`` words from ``starts[l, p]`` on."""

    words: np.ndarray
    ranks: np.ndarray  # ones before each word
    starts: np.ndarray
    sizes: np.ndarray
    keys: np.ndarray

    @classmethod
    def joined(cls, parts: list[tuple[list[np.ndarray], np.ndarray]]) -> PerfectHash:
        """From the levels and keys of all pieces, in the order of the pieces."""
        depth = max((len(levels) for levels, _ in parts), default=0)
        starts = np.zeros((depth, len(parts)), np.int64)
        sizes = np.zeros((depth, len(parts)), np.int64)
        every, at = [np.empty(0, np.uint64)], 0
        for p, (levels, _) in enumerate(parts):
            for depth_here, words in enumerate(levels):
                starts[depth_here, p], sizes[depth_here, p] = at, len(words)
                every.append(words)
                at += len(words)
        words = np.concatenate(every)
        ones = np.bitwise_count(words).astype(np.int64)
        keys = np.concatenate([np.empty(0, np.uint64), *(k for _, k in parts)])
        return cls(words, np.cumsum(ones) - ones, starts, sizes, keys)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys that are not in the set."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        keys = keys.astype(np.uint64)
        piece = piece_of(keys, self.starts.shape[1])
        left = np.arange(len(keys))
        for level in range(len(self.starts)):
            left = left[self.sizes[level, piece[left]] > 0]
            if not len(left):
                break
            mine, own = keys[left], piece[left]
            place = (mixed(mine, level) % (self.sizes[level, own] * 64).astype(np.uint64)).astype(np.int64)
            word = self.starts[level, own] + (place >> 6)
            bit = (place & 63).astype(np.uint64)
            held = self.words[word]
            hit = ((held >> bit) & np.uint64(1)).astype(bool)
            below = held[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.ranks[word[hit]] + np.bitwise_count(below)
            left = left[~hit]
        found = out >= 0
        out[found] = np.where(self.keys[out[found]] == keys[found], out[found], -1)
        return out
