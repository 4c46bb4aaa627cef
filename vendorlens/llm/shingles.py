"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hashes a task remembers before it forgets them all.
REMEMBERED = 300_000


class Words:
    """Hashes of lower-case words, remembered within bounds."""

    def __init__(self):
        self._known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words, known = text.lower().split(), self._known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``size`` words in a row; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return words
    count = max(1, len(words) - size + 1)
    out = np.full(count, np.uint64(min(len(words), size)))
    for k in range(min(size, len(words))):
        out = (out ^ (out >> np.uint64(29))) * _MIX + words[k : k + count]
    return np.unique(out ^ (out >> np.uint64(32)))
