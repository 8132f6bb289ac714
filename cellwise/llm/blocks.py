"""Texts as blocks of bytes in numpy arrays: words, rolling hashes, digests.

Tasks work through their rows in blocks of a few megabytes, so that what a task holds does
not depend on the size of its partition. A single text longer than a block is a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

# The white space that separates words: bytes 9 to 13 and 32.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def cut(batches: Iterable[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts hold about ``limit`` bytes, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_bytes(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, and where each row starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    width = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, width, len(column) + 1, column.offset * np.dtype(width).itemsize).astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(data, np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the maximal runs of bytes with ``inside[byte]`` in each row.

    Row r has the words first[r] to first[r + 1].
    """
    mark = inside[data]
    before = np.zeros(len(mark), bool)
    before[1:] = mark[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = False
    starts = np.flatnonzero(mark & ~before)
    after = np.zeros(len(mark), bool)
    after[:-1] = mark[1:]
    after[cuts - 1] = False
    ends = np.flatnonzero(mark & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (fixed values: the finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Hashes of all windows of a sequence, by prefix sums of a polynomial modulo 2^64.

    A window's value depends on its items alone, not on where it stands.
    """

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.base = int(random.integers(1 << 62, dtype=np.int64)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.letter = random.integers(1 << 63, size=256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        """Tables of the first n powers of the base and of its inverse."""
        while len(self.up) < n:
            size = np.uint64(len(self.up))
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, int(size), 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, int(size), 1 << 64))])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums over 64-bit items, or over bytes by a table of random values."""
        self._powers(len(values) + 1)
        values = self.letter[values] if values.dtype == np.uint8 else values
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def windows(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray | int) -> np.ndarray:
        """Hashes of [start, end); an int is a common length."""
        ends = starts + ends if isinstance(ends, int) else ends
        return mix((sums[ends] - sums[starts]) * self.down[starts])


@lru_cache
def rolling(seed: int) -> Rolling:
    return Rolling(seed)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    roll = rolling(seed)
    return roll.windows(roll.sums(data), starts, ends)


def sha256_hex(data) -> str:
    return hashlib.sha256(data).hexdigest()


def first_in_group(sorted_keys: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal keys."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return new


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table
