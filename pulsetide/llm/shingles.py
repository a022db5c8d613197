"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word's hash is a polynomial in its bytes, so the hashes of all words come from one running
sum over the text; a shingle's is a mixed sum of its words' hashes. Hashes stand for words and
shingles throughout: two different ones agree with a chance of about 2**-64.
"""

from collections.abc import Iterator

import numpy as np

#: Bytes that one running sum covers; a longer word gets one of its own.
SEGMENT = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < count:
        for place, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(count, base, np.uint64)
            table[0] = 1
            _powers[place] = np.cumprod(table)
    return _powers[0], _powers[1]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words, and where each text's begin (one more than texts).

    Words are runs without space, tab, line feed, vertical tab, form feed, carriage return.
    """
    inside = ~_SPACE[raw]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    some = offsets[:-1] < offsets[1:]
    firsts, lasts = offsets[:-1][some], offsets[1:][some] - 1
    opens[firsts], closes[lasts] = inside[firsts], inside[lasts]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + SEGMENT, side="right")))
        size = int(ends[to - 1] - low)
        up, down = powers(max(size + 1, SEGMENT))
        sums = np.zeros(size + 1, np.uint64)
        letters = _LOWER[raw[low : low + size]].astype(np.uint64)
        np.cumsum((letters + np.uint64(1)) * up[:size], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        hashes[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return mix(hashes), np.searchsorted(starts, offsets)


def shingle_sets(
    raw: np.ndarray, offsets: np.ndarray, words: int = 5
) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text.

    A text with fewer words has one shingle, all its words; one without words has none.
    """
    hashes, bounds = word_hashes(raw, offsets)
    runs = hashes.copy()
    for step in range(1, words):
        runs = mix(runs)
        if step < len(runs):
            runs[:-step] += hashes[step:]
    runs = mix(runs)
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if last - first >= words:
            # Some are longer than a cache: sort, then drop repeats.
            run = np.sort(runs[first : last - words + 1])
            yield run[np.concatenate([[True], run[1:] != run[:-1]])]
        elif last > first:
            short = np.zeros(1, np.uint64)
            for one in hashes[first:last]:
                short = mix(short) + one
            yield mix(short + np.uint64(last - first))
        else:
            yield np.zeros(0, np.uint64)


def digest(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set; 0 for the empty set only."""
    if not len(shingles):
        return 0
    total = int(mix(shingles + np.uint64(1)).sum(dtype=np.uint64)) + len(shingles) * _BASE
    return int(mix(np.array([total & (2**64 - 1)], np.uint64)).view(np.int64)[0]) or 1
