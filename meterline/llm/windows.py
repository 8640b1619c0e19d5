"""Names of substrings, and runs of windows that share their smallest seed.

A *name* is a 64-bit number that stands for the content of a substring: names of length 2n come
from pairs of names of length n, so equal substrings have equal names wherever they are.

A *window* is a substring of fixed length. Its *anchor* is the leftmost of its seeds (substrings
of a shorter fixed length) with the smallest name, which depends on the window's content alone.
Neighbouring windows mostly have the same anchor; such a *run* of windows is what gets shuffled
in place of its windows, keyed by the anchor's name. Equal windows lie in runs with equal seeds,
at equal distances from the anchor.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_32, _29 = np.uint64(32), np.uint64(29)
#: Low bits of a seed's name give way to its position while the smallest is sought.
_PLACE_BITS = np.uint64(24)
_PLACE = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
#: Symbols handled at a time; longer texts are taken in overlapping segments.
SEGMENT = 1 << 20


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of pairs of names."""
    x = a * _M1
    x ^= x >> _32
    x += b
    x *= _M2
    x ^= x >> _29
    return x


#: Names of single bytes.
BYTE_NAMES = mix(np.arange(1, 257, dtype=np.uint64), np.arange(7, 263, dtype=np.uint64))


class Names:
    """Names of all substrings of one sequence, given the names of its symbols."""

    def __init__(self, symbols: np.ndarray):
        self.level = {1: symbols}

    def of(self, length: int) -> np.ndarray:
        """The name of the substring of ``length`` at each position where it fits."""
        if length not in self.level:
            half = 1 << (length - 1).bit_length() - 1  # two halves, overlapping if need be
            part = self.of(half)
            n = max(0, len(part) - (length - half))
            self.level[length] = mix(part[:n], part[length - half :][:n])
        return self.level[length]


@dataclass
class Runs:
    """Runs of a sequence: first window, windows, distance of the anchor from the first window,
    the anchor's name, and a name for all of the run's content."""

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    seed: np.ndarray
    block: np.ndarray


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    if width > have:
        values = np.minimum(values[: len(values) - (width - have)], values[width - have :])
    return values


def runs_of(names: Names, window: int, seed: int) -> Runs | None:
    """The runs of all windows of a sequence (at most ``SEGMENT`` + window symbols long)."""
    n = len(names.of(1)) - window + 1
    if n <= 0:
        return None
    seeds, whole = names.of(seed), names.of(window)
    placed = (seeds & ~_PLACE) | np.arange(len(seeds), dtype=np.uint64)
    least = _smallest(placed, window - seed + 1)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.concatenate((first[1:], [n])) - 1
    at = (least[first] & _PLACE).astype(np.int64)
    shape = ((last - first).astype(np.uint64) << np.uint64(16)) | (at - first).astype(np.uint64)
    block = mix(mix(whole[first], whole[last]), shape)
    return Runs(first, last - first + 1, at - first, seeds[at], block)


def runs_of_many(parts: list[np.ndarray], window: int, seed: int) -> tuple[Runs, np.ndarray] | None:
    """The runs of all windows of several sequences of symbols, as ``runs_of`` each, and the
    number of the sequence that each run lies in. All have fewer than 2^24 symbols."""
    length = np.array([len(p) for p in parts])
    begin = np.cumsum(length) - length
    n = np.maximum(length - window + 1, 0)
    if not n.any():
        return None
    # First symbols of the windows within one sequence; others are looked at and left out.
    inside = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    names = Names(np.concatenate(parts))
    seeds, whole = names.of(seed), names.of(window)
    placed = (seeds & ~_PLACE) | np.arange(len(seeds), dtype=np.uint64)
    least = _smallest(placed, window - seed + 1)[inside]
    change = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    first, last = inside[change], inside[np.concatenate((change[1:], [len(inside)])) - 1]
    at = (least[change] & _PLACE).astype(np.int64)
    shape = ((last - first).astype(np.uint64) << np.uint64(16)) | (at - first).astype(np.uint64)
    block = mix(mix(whole[first], whole[last]), shape)
    part = np.repeat(np.arange(len(parts)), n)[change]
    return Runs(first - begin[part], last - first + 1, at - first, seeds[at], block), part


def segments(length: int, window: int) -> list[tuple[int, int]]:
    """Bounds of overlapping parts, so that each window lies in exactly one part's windows."""
    return [
        (k, min(length, k + SEGMENT + window - 1)) for k in range(0, max(1, length - window + 1), SEGMENT)
    ]


def covered(windows: np.ndarray, width: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the maximal stretches covered by ``windows`` ((first window, count) rows)."""
    if not len(windows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(length + 1, np.int32)
    np.add.at(edge, windows[:, 0], 1)
    np.add.at(edge, windows[:, 0] + windows[:, 1] + width - 1, -1)
    inside = np.concatenate(([0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]))
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)
