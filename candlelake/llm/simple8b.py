"""Simple-8b: word-aligned coding of non-negative integers.

A 64-bit word holds a selector in its top four bits and, in the other 60, as many
values of one width as fit. Selectors 0 and 1 stand for 240 and 120 zeros.
Selector 15 holds one value: in the word if it is below 2**59 and bit 59 is set,
otherwise it is an escape, stored in a table of its own. Encoding and decoding are array operations;
decoding is one gather for all words of a selector.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# fixed values: how many values a word of each selector holds, and their width in bits
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 0])
MARK_EVERY = 256
_ESCAPE = 15


class Coded(NamedTuple):
    words: np.ndarray  # little-endian uint64
    marks: np.ndarray  # values before every MARK_EVERY-th word
    escapes: np.ndarray  # values that no width holds


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value. Doubles are exact below 2**53; larger values are far from the widths in use."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _all_of_next(ok: np.ndarray, count: int) -> np.ndarray:
    """Whether ``count`` values from each place on are ok; only places with so many values."""
    span = 1
    while span < count:
        step = min(span, count - span)
        ok = ok[:-step] & ok[step:]
        span += step
    return ok


def encode(values: np.ndarray) -> Coded:
    """Greedy packing: each word takes the densest selector that its next values allow."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    bits = _widths(values)
    fits = np.full(n, _ESCAPE, np.int8)
    for s in range(14, -1, -1):
        ok, count = bits <= WIDTHS[s], int(COUNTS[s])
        if n >= count and np.count_nonzero(ok) >= count:
            full = _all_of_next(ok, count)
            fits[: len(full)][full] = s
    # the places where words start: follow the lengths from the first value on
    following = (np.arange(n) + COUNTS[fits]).tolist()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at = following[at]
    starts = np.array(starts, np.int64)
    selectors = fits[starts].astype(np.int64)
    words = selectors.astype(np.uint64) << np.uint64(60)
    for s in range(2, 15):
        mine = np.flatnonzero(selectors == s)
        for j in range(int(COUNTS[s]) if len(mine) else 0):
            words[mine] |= values[starts[mine] + j] << np.uint64(j * int(WIDTHS[s]))
    alone = np.flatnonzero(selectors == _ESCAPE)
    small = alone[values[starts[alone]] < np.uint64(1 << 59)]
    # a last value that is small enough stays in the word itself, told by the bit below the selector
    words[small] |= values[starts[small]] | np.uint64(1 << 59)
    escaped = alone[values[starts[alone]] >= np.uint64(1 << 59)]
    return Coded(words.astype("<u8"), starts[::MARK_EVERY], values[starts[escaped]].astype("<u8"))


def decode(words: np.ndarray, escapes: np.ndarray = np.zeros(0, np.uint64)) -> np.ndarray:
    """The values of ``words``. A part that begins at a mark can be decoded alone if it has no escapes."""
    words = np.asarray(words, dtype=np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in range(2, 15):
        mine = np.flatnonzero(selectors == s)
        if len(mine):
            shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            out[starts[mine][:, None] + np.arange(COUNTS[s])] = (words[mine][:, None] >> shifts) & mask
    alone = np.flatnonzero(selectors == _ESCAPE)
    inline = (words[alone] >> np.uint64(59)) & np.uint64(1) == 1
    out[starts[alone[inline]]] = words[alone[inline]] & np.uint64((1 << 59) - 1)
    out[starts[alone[~inline]]] = escapes
    return out
