"""Words, word shingles and their hashes."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

# White space that parts words; ``bytes.split`` uses the same.
SPACE = b" \t\n\r\x0b\x0c"

MIX = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
HALF = np.uint64(32)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbors, in order; empty if there are fewer."""
    n = max(len(hashes) - size + 1, 0)
    mixed = np.zeros(n, np.uint64)
    for i in range(size):
        mixed = (mixed ^ hashes[i : i + n]) * MIX
        mixed ^= mixed >> HALF
        mixed *= STEP
    return mixed


def shingle_set(data: bytes | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text in UTF-8.

    A to Z are lower-cased. Fewer words than ``size`` are one shingle, none give none.
    """
    words = (data or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(windows(word_hashes(words), min(size, len(words))))
