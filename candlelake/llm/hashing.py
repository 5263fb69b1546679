"""Array hashing of words, word windows and byte windows."""

from __future__ import annotations

import numpy as np

# the fixed white space of a word pattern [^\x20\x09-\x0D]+
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _stream(seed: int, n: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


BYTES = _stream(1 << 40, 256)
_places = _stream(1 << 41, 1 << 10) | np.uint64(1)


def places(n: int) -> np.ndarray:
    """Odd factors for the first ``n`` places of a word."""
    global _places
    if n > len(_places):
        _places = _stream(1 << 41, 1 << (n - 1).bit_length()) | np.uint64(1)
    return _places


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word of texts that lie end to end, and the text it belongs to."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] |= ~space[heads]
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(offsets, starts, side="right") - 1


def word_lengths(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bytes of the words that begin at ``starts``."""
    if not len(starts):
        return np.zeros(0, np.int64)
    return np.add.reduceat((~SPACE[data]).astype(np.int64), starts)


def word_hashes(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: random byte values times random odd factors of their places, summed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    first = np.zeros(len(data), np.int64)
    first[starts] = 1
    word = np.cumsum(first) - 1
    inside = ~SPACE[data] & (word >= 0)
    place = np.arange(len(data)) - starts[np.maximum(word, 0)]
    place[~inside] = 0
    values = BYTES[data] * places(int(place.max()) + 1)[place]
    values[~inside] = 0
    return mix(np.add.reduceat(values, starts))


def sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (np.minimum, np.maximum) over every run of ``width`` values."""
    span = 1
    while span < width:
        step = min(span, width - span)
        values = choose(values[:-step], values[step:]) if len(values) > step else values[:0]
        span += step
    return values


def lowest_places(values: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least value of some run of ``width`` values (all of them at ties)."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    least = sliding(values, width, np.minimum)
    # a place is chosen if the largest minimum of the runs over it is its own value
    wall = np.zeros(width - 1, values.dtype)
    over = sliding(np.concatenate([wall, least, wall]), width, np.maximum)
    return np.flatnonzero(over == values)
