"""Word hashes for whole arrays of words."""

from __future__ import annotations

import numpy as np
from pandas.util import hash_array

# Keys of the two word hashes, odd multipliers of the rolling sums, and of the last mixing step.
_KEY = ("first word hash.", "second word hash")
_STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def word_hashes(words: list[bytes], which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; `which` chooses one of two independent ones."""
    if not words:
        return np.zeros(0, np.uint64)
    return hash_array(np.array(words, object), hash_key=_KEY[which], categorize=False)


def split_all(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts one after another, and where each text's words begin and end."""
    lists = [text.split() for text in texts]
    ends = np.cumsum([0, *map(len, lists)])
    return [word for words in lists for word in words], ends


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def rolled(hashes: np.ndarray, size: int, step: int = 0) -> np.ndarray:
    """One hash for each run of `size` words, also for runs that go on into the next text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for at in range(size):
        total *= _STEP[step]
        total += hashes[at : at + n]
    return mixed(total)


def within(ends: np.ndarray, size: int) -> np.ndarray:
    """Of the runs of `size` words, those that stay in one text: their positions."""
    n = int(ends[-1]) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    inside = np.ones(n, bool)
    for back in range(1, size):
        cut = ends[1:-1] - back
        inside[cut[(cut >= 0) & (cut < n)]] = False
    return np.flatnonzero(inside)
