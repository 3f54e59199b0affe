"""Words of texts as 64-bit hashes, and hashes of runs of words."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
#: Words whose hash a worker remembers between batches. It changes no result.
REMEMBERED = 200_000


class _Hashes(dict):
    """Hashes by word, each computed when first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = code = xxhash.xxh64_intdigest(word)
        return code


_known = _Hashes()


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word of the text in lower case; words are runs of letters, digits and underscores."""
    if len(_known) > REMEMBERED:
        _known.clear()
    words = WORD.findall(text.lower())
    return np.fromiter(map(_known.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=1024)
def _weights(count: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(1000 * (seed + 1))) | np.uint64(1)


def run_sums(words: np.ndarray, offsets: list[int], seed: int = 0) -> np.ndarray:
    """For each place where all ``offsets`` from it lie inside, the weighted sum of the word hashes there.

    The hashes are spread already and the weights are odd, so the sums are hashes too; ``runs`` spreads them once more.
    """
    n = len(words) - offsets[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    factors = _weights(len(offsets), seed)
    out = words[offsets[0] : offsets[0] + n] * factors[0]
    part = np.empty_like(out)
    for o, factor in zip(offsets[1:], factors[1:]):
        out += np.multiply(words[o : o + n], factor, out=part)
    return out


def runs(words: np.ndarray, offsets: list[int], seed: int = 0) -> np.ndarray:
    """One hash for each place where all ``offsets`` from it lie inside; words between them do not count."""
    return mixed(run_sums(words, offsets, seed))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a shorter text is one run, one without words none."""
    words = word_hashes(text)
    return np.unique(runs(words, list(range(min(size, len(words)))))) if len(words) else words
