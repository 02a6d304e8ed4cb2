"""Words and their hashes over Arrow text buffers, in numpy.

A word here is a maximal run of bytes outside a separator set. UTF-8 never uses ASCII bytes
inside a longer character, so splitting bytes at ASCII separators splits characters rightly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer document is worked on alone.
CHUNK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as asked for so far."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, 1 << 64)
        self.made = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.made[0]) < n:
            size = max(n, 2 * len(self.made[0]), 1 << 16)
            for i, base in enumerate(self.bases):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                self.made[i] = np.cumprod(steps, dtype=np.uint64)
        return self.made[0][:n], self.made[1][:n]


_POWERS = {0: Powers(_BASE), 1: Powers(0xD6E8FEB86659FD93)}


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each text and the bytes of all; a null counts as an empty text."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return at.astype(np.int64), np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about CHUNK bytes: first row, end row, offsets from 0, bytes."""
    offsets, data = text_buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
        yield i, j, offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]]
        i = j


def split(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words of each row."""
    inside = ~separator[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    starts[first], ends[last] = inside[first], inside[last]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes; starts and ends must rise. Sums are taken over a stretch of CHUNK bytes at a time."""
    out = np.zeros(len(starts), np.uint64)
    first, last = (int(starts[0]), int(ends[-1])) if len(starts) else (0, 0)
    for a in range(first, last, CHUNK):
        b = min(a + CHUNK, last)
        i, j = int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(starts, b))
        if i == j:
            continue
        power, inverse = _POWERS[seed](b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
        low, high = np.maximum(starts[i:j], a) - a, np.minimum(ends[i:j], b) - a
        own = (sums[high] - sums[low]) * inverse[low]
        for k in np.flatnonzero(starts[i:j] < a):  # begun in an earlier stretch
            own[k] = int(own[k]) * pow(_POWERS[seed].bases[0], a - int(starts[i + k]), 1 << 64) & _MASK
        out[i:j] += own
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def windows(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """64-bit hash of every run of n neighbouring values; empty if there are fewer."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for a in range(0, len(out), CHUNK):
        own = hashes[a : a + CHUNK + n - 1]
        power, inverse = _POWERS[seed](len(own) + 1)
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(own * power[:-1], out=sums[1:])
        out[a : a + CHUNK] = (sums[n:] - sums[:-n]) * inverse[: len(own) - n + 1]
    return mix(out)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64)
