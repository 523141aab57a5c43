"""Words of whole texts as 64-bit hashes, computed over UTF-8 bytes with numpy.

A word is a maximal run of bytes of a class, after A-Z became a-z. All bytes of a character beyond
ASCII are above 0x7F, so classes of ASCII characters plus "everything beyond ASCII" can be told
byte by byte. Two different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of words: everything but ASCII white space, and ASCII letters and digits plus all beyond ASCII.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_first : _last + 1] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_TABLE = np.random.default_rng(20240201).integers(0, 2**64, 64 * 256, dtype=np.uint64)
_PIECE = 1 << 19

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that sums and ranges of them behave like random ones."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def hash_words(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte and hash of each word of ``data`` (uint8)."""
    inside = table[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate(([0], edges))
    if len(inside) and inside[-1]:
        edges = np.concatenate((edges, [len(inside)]))
    starts, ends = edges[::2], edges[1::2]
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _PIECE, side="right")))
        hashes[first:last] = _hash_runs(data, starts[first:last], ends[first:last])
        first = last
    return starts, ends, hashes


def _hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Tabulation hashes: a random value per position and byte, summed over the word."""
    base = int(starts[0])
    lengths = (ends - starts).astype(np.int32)
    before = np.cumsum(lengths, dtype=np.int32) - lengths
    position = np.arange(int(before[-1] + lengths[-1]), dtype=np.int32)
    at = position + np.repeat((starts - base).astype(np.int32) - before, lengths)
    position -= np.repeat(before, lengths)
    values = _TABLE[((position & 63) << 8) | _LOWER[data[base : int(ends[-1])][at]]]
    if int(lengths.max()) > 64:
        values *= ((position >> 6).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
    return mix(np.add.reduceat(values, before) + lengths.astype(np.uint64) * _M1)


class Texts:
    """Words of a batch of texts: hash of each word, and the word range of each text."""

    def __init__(self, column: pa.Array, table: np.ndarray):
        self.texts = column.to_pylist()
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        # A space between texts, so that no word spans two of them.
        self.data = np.frombuffer(" ".join(t or "" for t in self.texts).encode(), np.uint8)
        self.first_byte = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1].astype(np.int64)
        self.starts, self.ends, self.hashes = hash_words(self.data, table)
        self.bounds = np.searchsorted(
            self.starts, np.concatenate((self.first_byte, [len(self.data) + 1]))
        )

    def __len__(self) -> int:
        return len(self.texts)

    def words(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]

    def spans(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word of text ``i``, in bytes of that text."""
        a, b = self.bounds[i], self.bounds[i + 1]
        return self.starts[a:b] - self.first_byte[i], self.ends[a:b] - self.first_byte[i]


def slices(batch: pa.RecordBatch, text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + limit, side="right")))
        yield batch.slice(first, last - first)
        first = last
