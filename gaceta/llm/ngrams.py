"""Hashed character n-grams of many words at once, in numpy."""

from __future__ import annotations

import numpy as np

_PRIME, _MIX = np.uint32(16777619), np.uint32(0x2C1B3C6D)


def word_ngrams(
    words: list[str], sizes: tuple[int, ...], buckets: int, left: str = "<", right: str = ">",
) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, borders marked, and the word each belongs to.

    The words stand end to end as code points; an n-gram is hashed from all places at once,
    and those that run across the end of a word are left out.
    """
    text = "".join([f"{left}{w}{right}" for w in words])
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + len(left) + len(right)
    word = np.repeat(np.arange(len(words)), lengths)
    end = np.repeat(np.cumsum(lengths), lengths)
    found, owners = [], []
    for n in sizes:
        places = max(0, len(codes) - n + 1)
        h = np.full(places, n, np.uint32)
        for j in range(n):
            h = (h ^ codes[j:j + places]) * _PRIME
        h ^= h >> np.uint32(15)
        h *= _MIX
        h ^= h >> np.uint32(13)
        inside = np.arange(n, places + n) <= end[:places]
        found.append((h[inside] % np.uint32(buckets)).astype(np.int64))
        owners.append(word[:places][inside])
    return np.concatenate(found), np.concatenate(owners)
