"""Minimal perfect hash of 128-bit keys: levels of bits, each key at the first level where it is alone."""

from __future__ import annotations

import numpy as np

from tidewell.llm.arrays import mix

_BITS_PER_KEY = 2


def _position(h1, h2, level: int, size: int):
    salt = np.uint64((level + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    return mix(h1 ^ mix(h2 + salt)) % np.uint64(size)


def build(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits in 64-bit words, the keys before each word, and the words of every level; keys are distinct."""
    words, sizes, level = [], [], 0
    while len(h1):
        n_words = max(1, -(-len(h1) * _BITS_PER_KEY // 64))
        at = _position(h1, h2, level, n_words * 64).astype(np.int64)
        alone = np.bincount(at, minlength=n_words * 64) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(n_words)
        rest = ~alone[at]
        h1, h2, level = h1[rest], h2[rest], level + 1
    flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
    ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(flat))])[:-1].astype(np.uint32)
    return flat, ranks, np.array(sizes, np.uint32)


def slots(words: np.ndarray, ranks: np.ndarray, sizes: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Slot of each key, in 0 .. number of keys - 1; -1 or any slot for keys that were not built in."""
    out = np.full(len(h1), -1, np.int64)
    open_, base = np.arange(len(h1)), 0
    for level, n_words in enumerate(sizes.tolist()):
        if not len(open_):
            break
        at = _position(h1[open_], h2[open_], level, n_words * 64)
        word = base + (at >> np.uint64(6)).astype(np.int64)
        bit = at & np.uint64(63)
        hit = (words[word] >> bit) & np.uint64(1) == 1
        below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        found = open_[hit]
        out[found] = ranks[word[hit]] + np.bitwise_count(below[hit])
        open_, base = open_[~hit], base + n_words
    return out
