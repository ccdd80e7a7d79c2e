"""Words, word hashes and shingles of whole texts."""

import numpy as np
from xxhash import xxh3_64_intdigest

REMEMBERED = 300_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def words_of(text) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case, as UTF-8."""
    return text.encode().lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes of words; the memory is emptied when it holds too many."""

    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value

    def of(self, words) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` words, in order, repeats included.

    A shorter text is one shingle of all its words; an empty text has none.
    """
    if not len(hashes):
        return hashes
    span = min(width, len(hashes))
    count = len(hashes) - span + 1
    out = np.full(count, span, np.uint64)
    for offset in range(span):
        out = mixed(out * _STEP + hashes[offset : offset + count])
    return out
