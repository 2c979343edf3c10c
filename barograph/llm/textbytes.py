"""Word and k-gram hashes of many texts at once, on their UTF-8 bytes.

A polynomial over random byte values, summed once over the buffer, gives the
hash of every span by one subtraction. Equal spans have equal hashes wherever
they stand; operators that need certainty compare the bytes afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_VALUES = _VALUES[LOWER]
#: Bytes of words: digits, letters and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True
ALNUM[128:] = True
#: Bytes of words that only ASCII white space ends.
SOLID = np.ones(256, bool)
SOLID[9:14] = SOLID[32] = False
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        for k, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and the offsets between them; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    bounds = np.frombuffer(offsets, width)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def prefix_sums(data: np.ndarray, values: np.ndarray = _VALUES) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any span."""
    up, _ = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values[data] * up[:len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    length = (end - start).astype(np.uint64)
    return mixed((sums[end] - sums[start]) * down[start] + length * _VALUES[0])


def words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray):
    """Start, end and text number of every word, and each text's first word number."""
    inside = kind[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, bounds)
    return start, end, first


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive words for every first word (not split by text)."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    up, _ = powers(size + 1)
    total = np.full(count, size, np.uint64) * _VALUES[1]
    for k in range(size):
        total += hashes[k:k + count] * up[k + 1]
    return mixed(total)


class Members:
    """Fast membership and position of 64-bit values in a fixed set."""

    def __init__(self, values: np.ndarray, bits: int = 20) -> None:
        self.values = np.unique(values)
        self.mask = np.uint64((1 << bits) - 1)
        self.bitmap = np.zeros(1 << bits, bool)
        self.bitmap[self.values & self.mask] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of ``hashes`` in the set and which member each one is."""
        at = np.flatnonzero(self.bitmap[hashes & self.mask])
        if not len(at):
            return at, at
        which = np.searchsorted(self.values, hashes[at])
        which[which == len(self.values)] = 0
        right = self.values[which] == hashes[at]
        return at[right], which[right]
