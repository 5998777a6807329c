"""Rabin-Karp hashes and content anchors over numpy arrays, for windows of words or of bytes.

The hash of a window is a polynomial in an odd base modulo 2^64 over 64-bit random values of its
items; one running sum gives all windows of a page.  A window's anchor is the smallest hash of a
short gram inside it: equal windows have equal anchors, and neighbouring windows mostly share
theirs, so dealing windows out by anchor keeps runs together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that low bits and order are those of a random hash."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Window hashes of ``values`` (uint64), any width, from one running sum."""

    def __init__(self, values: np.ndarray) -> None:
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(INVERSE, len(values)), dtype=np.uint64)])
        self.scale = powers(BASE, len(values))

    def all(self, width: int) -> np.ndarray:
        """The hash of every window of ``width`` items, by its start."""
        if len(self.scale) < width:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:-width]) * self.scale[: len(self.scale) - width + 1])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each span ``[start, end)``."""
        return mix((self.sums[ends] - self.sums[starts]) * self.scale[starts])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring values, by the first of them."""
    if len(values) < width:
        return values[:0]
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def page_slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes (or one row) each."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start = held = 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > limit:
            yield start, row
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def run_bounds(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, lengths)`` of the runs that begin where ``breaks`` is true (true at 0 if not empty)."""
    starts = np.flatnonzero(breaks)
    return starts, np.diff(np.append(starts, len(breaks)))


def new_values(*columns: np.ndarray) -> np.ndarray:
    """True where any of the columns differs from the row before, and at row 0."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for column in columns:
        out[1:] |= column[1:] != column[:-1]
    return out


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals of a union of intervals; touching ones merge."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.append(np.flatnonzero(first)[1:] - 1, len(starts) - 1)
    return starts[first], ends[last]
