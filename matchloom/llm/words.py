"""64-bit hashes of the words of texts and of runs of words, without a Python call for each word.

A word's hash is the mixed sum of one random number for each of its letters, drawn by the letter's place in the word. Sums of
independent random numbers have no structure that a text could hit by its own regularity, as powers of a base have.
"""

from itertools import pairwise

import numpy as np

#: Places of a word that have random numbers of their own, values of a folded byte, the seed; later places get mixed numbers.
PLACES, VALUES, SEED = 64, 257, 11
#: Bytes of words hashed at once.
SLICE = 1 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


class Letters:
    """The random numbers of letters; `at_once` bounds the bytes of words that are hashed together."""

    def __init__(self, at_once: int = SLICE):
        self.at_once = at_once
        self.table = np.random.default_rng(SEED).integers(0, 1 << 64, PLACES * VALUES, dtype=np.uint64)

    def hashes(self, low: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words low[begin:end], which lie in order and don't overlap; other bytes of `low` are not looked at."""
        out, at = np.empty(len(begin), np.uint64), 0
        while at < len(begin):
            to = max(at + 1, int(np.searchsorted(end, begin[at] + self.at_once, side="right")))
            sizes = end[at:to] - begin[at:to]
            starts = np.cumsum(sizes) - sizes
            place = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
            code = place * VALUES + low[place + np.repeat(begin[at:to], sizes)]
            if place.max() < PLACES:
                numbers = self.table[code]
            else:
                numbers = np.where(place < PLACES, self.table[np.minimum(code, len(self.table) - 1)], mixed(code.astype(np.uint64) * _GOLDEN + np.uint64(SEED)))
            out[at:to] = mixed(np.add.reduceat(numbers, starts))
            at = to
        return out


def _unspaced() -> np.ndarray:
    """For each byte its lower-case form plus one, 0 for U+0020 and U+0009 to U+000D."""
    table = np.arange(256, dtype=np.int64)
    table[0x41:0x5B] += 0x20
    table += 1
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


UNSPACED = _unspaced()


def spaced_words(raw: np.ndarray, letters: Letters) -> np.ndarray:
    """Hashes of a text's words in order: runs without white space of ASCII, A-Z lower-cased."""
    low = UNSPACED[raw]
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = low != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return letters.hashes(low, edge[::2], edge[1::2])


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; of all words if there are fewer, of none if there are none."""
    if not len(words):
        return words
    n, take = max(1, len(words) - size + 1), min(size, len(words))
    h = np.full(n, take, np.uint64)
    for k in range(take):
        h = mixed(h * _GOLDEN + words[k : k + n])
    return np.unique(h)


def texts_of(column) -> list[np.ndarray]:
    """The bytes of each text of an Arrow string column without nulls."""
    wide = column.type == "large_string"
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.empty(0, np.uint8)
    return [raw[a:b] for a, b in pairwise(at.tolist())]
