"""Minimal perfect hashing of 64-bit keys in shards, for tables that tasks look up by slot.

A shard's keys go through levels of bit arrays twice as long as the keys still left: a key alone in
its place sets the bit, the others go on to the next level. The number of set bits before a key's
bit is its slot, so n keys have the slots 0 to n - 1 and about four bits a key remain. Shards are
built apart and laid side by side. A key that was never put in gets some slot or none, so what is
kept by slot has the key beside it, and ``slots`` compares them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SHARDS = 256
#: Bits for each key that a level is given; levels after which building is given up.
SPACE, MOST_LEVELS = 2, 64


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit permutation of the keys for each seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shard_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, MOST_LEVELS + 1) % np.uint64(SHARDS)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, the levels' bits as 64-bit words, keys by slot) of distinct keys."""
    left, sizes, words, order = keys.astype(np.uint64), [], [], []
    while len(left):
        if len(sizes) == MOST_LEVELS:
            raise ValueError("keys repeat")
        size = -(-SPACE * len(left) // 64) * 64
        at = mixed(left, len(sizes)) % np.uint64(size)
        met = np.bincount(at.astype(np.int64), minlength=size)
        alone = met[at.astype(np.int64)] == 1
        bits = (met == 1).astype(np.uint8)
        words.append(np.packbits(bits, bitorder="little").view(np.uint64))
        order.append(left[alone][np.argsort(at[alone])])
        sizes.append(size)
        left = left[~alone]
    none = [np.empty(0, dtype=np.uint64)]
    return sizes, np.concatenate(words or none), np.concatenate(order or none).astype(np.int64)


@dataclass
class PerfectHash:
    """Slots of the keys of some shards. ``levels``: bits by shard and level, 0 where there is none."""

    levels: np.ndarray
    starts: np.ndarray
    words: np.ndarray
    before: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, shards: dict[int, tuple[list[int], np.ndarray, np.ndarray]]) -> PerfectHash:
        deepest = max([len(sizes) for sizes, _, _ in shards.values()], default=0)
        levels = np.zeros((SHARDS, deepest + 1), dtype=np.int64)
        for shard, (sizes, _, _) in shards.items():
            levels[shard, : len(sizes)] = sizes
        starts = (np.cumsum(levels) - levels.ravel()).reshape(levels.shape)
        whole = [shards[s] for s in sorted(shards)]
        words = np.concatenate([np.empty(0, dtype=np.uint64), *[w for _, w, _ in whole]])
        keys = np.concatenate([np.empty(0, dtype=np.int64), *[k for _, _, k in whole]])
        ones = np.bitwise_count(words).astype(np.int64)
        return cls(levels, starts, words, np.cumsum(ones) - ones, keys)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys of other shards. Unknown keys of these shards raise."""
        found = np.full(len(keys), -1, dtype=np.int64)
        shard = shard_of(keys)
        here = self.levels[shard, 0] > 0
        rest = np.nonzero(here)[0]
        for level in range(self.levels.shape[1]):
            if not len(rest):
                break
            size = self.levels[shard[rest], level]
            rest, size = rest[size > 0], size[size > 0]
            at = (mixed(keys[rest], level) % size.astype(np.uint64)).astype(np.int64)
            at += self.starts[shard[rest], level]
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            found[rest[hit]] = (self.before[at >> 6] + np.bitwise_count(below))[hit]
            rest = rest[~hit]
        if (found[here] < 0).any() or (self.keys[found[here]] != keys[here]).any():
            raise KeyError("a key that the hash was not built for")
        return found
