"""Words, segments and their hashes for whole Arrow batches of texts, by numpy.

A text column is one run of bytes; separators, word bounds and hashes are found
for all texts of a slice at once.  A word's hash is a polynomial in its bytes
(mapped through random 64-bit values) modulo 2**64, read off a prefix sum, and
then mixed; two different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1_000_000
_BASE = 0x2545F4914F6CDD1D
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]

# Separators of words: the space and the bytes 9 to 13.
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
# Everything in ASCII but letters and digits.
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SAME = np.arange(256, dtype=np.uint8)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row comes alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * _K[1]
    h = h ^ (h >> np.uint64(27))
    h = h * _K[2]
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of several texts: byte bounds, hashes, and the first word of each text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def doc(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Hasher:
    """Keeps the tables that hashing needs; make one per task."""

    def __init__(self, seed: int = 11):
        self._value = np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)
        self._power = np.ones(1, np.uint64)
        self._inverse = np.ones(1, np.uint64)

    def _tables(self, n: int) -> None:
        if len(self._power) > n:
            return
        n = max(n + 1, SLICE_BYTES)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("_power", _BASE), ("_inverse", inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of each byte range."""
        self._tables(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._value[data] * self._power[: len(data)], out=sums[1:])
        h = (sums[end] - sums[start]) * self._inverse[start]
        return mixed(h ^ ((end - start).astype(np.uint64) * _K[0]))

    def words(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray, fold: np.ndarray = LOWER) -> Words:
        """The words of texts; bytes are folded first, then cut at separators and text ends."""
        low = fold[data]
        inside = ~separator[low]
        begin, stop = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        filled = offsets[:-1][np.diff(offsets) > 0]
        begin[filled] = inside[filled]
        ends = offsets[1:][np.diff(offsets) > 0] - 1
        stop[ends] = inside[ends]
        start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        return Words(low, start, end, self.spans(low, start, end), np.searchsorted(start, offsets))


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a text, and the word each begins at."""
    count = len(words.hash) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = words.doc()
    at = np.flatnonzero(doc[: count] == doc[n - 1 :])
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h = mixed(h * _K[3] + words.hash[at + k] + np.uint64(k + 1))
    return h, at


def joined_hash(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of several hash columns, the same as :func:`grams` gives."""
    h = np.zeros(len(parts[0]), np.uint64)
    for k, part in enumerate(parts):
        h = mixed(h * _K[3] + part + np.uint64(k + 1))
    return h
