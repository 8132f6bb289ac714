"""Repeated byte strings, by difference-cover blockwise construction.

The question is which 50-byte prefixes of suffixes also start in a smaller document. A
difference cover of period 31 (a perfect difference set of 6 residues) is the sample: for any
two positions there is a distance below 31 at which both fall on sampled positions. So two
equal 50-byte strings hold sampled suffixes with equal prefixes of 20 bytes at the same place,
and the classes of these prefixes, found first, are the cover-sample ranks. A suffix whose
sampled neighbours are all alone in their classes cannot tie with another over 50 bytes and
is never sorted. The others are dealt into buckets and one bucket is sorted at a time.

Only equality over a fixed length is asked, so buckets and ranks are taken from hashes of the
prefixes and not from their alphabetical order; buckets are then even whatever the texts are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks
from .repeats import Chunk, Windows, Work, repeats

LENGTH = 50
# A perfect difference set modulo 31.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
_PREFIX = LENGTH - PERIOD + 1
_SAMPLED = np.isin(np.arange(PERIOD), COVER)
# Odd multipliers of the hashes, and the positions hashed at a time.
_FACTORS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_SLICE = 1 << 14


class ByteWindows(Windows):
    length = LENGTH
    within = False
    reach = LENGTH - _PREFIX

    def items(self, chunk: Chunk) -> np.ndarray:
        self.offsets, self.data = chunk.offsets, chunk.data
        # The eight bytes from each position on as one number; blanks follow the last.
        padded = np.concatenate([chunk.data, np.full(15, 32, np.uint8)])
        whole = len(padded) // 8 - 1
        self.eight = np.empty(8 * whole, np.uint64)
        for shift in range(8):
            self.eight[shift::8] = padded[shift : shift + 8 * whole].view("<u8")
        return chunk.offsets

    def boundaries(self) -> np.ndarray:
        """A position of every 64 or so, by the eight bytes that follow."""
        return ((self.eight[: len(self.data)] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)) == 0

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        roll = blocks.rolling(21)
        return roll.windows(roll.sums(self.data), starts, ends), blocks.mix(self._joined(starts, (0, 16, 42), 7) + (ends - starts).astype(np.uint64))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(self.offsets)
        pattern = (np.arange(sizes.max(initial=0) // PERIOD + 1)[:, None] * PERIOD + np.array(COVER)).ravel()
        ends = np.searchsorted(pattern, sizes - _PREFIX, "right")
        at = np.concatenate([np.zeros(0, np.int64), *(pattern[:n] + o for n, o in zip(ends, self.offsets, strict=False))])
        return at, np.ones(len(at), bool)

    def anchor_hashes(self, at: np.ndarray) -> np.ndarray:
        return self._joined(at, (0, 8, _PREFIX - 8), 3)

    def hashes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(self._mixed(starts, (*range(0, LENGTH - 8, 8), LENGTH - 8), (5, 9)))

    def _joined(self, at: np.ndarray, parts: tuple[int, ...], seed: int) -> np.ndarray:
        return self._mixed(at, parts, (seed,))[0]

    def _mixed(self, at: np.ndarray, parts: tuple[int, ...], seeds: tuple[int, ...]) -> np.ndarray:
        """A hash for each seed of the eight bytes at some distances from each position.

        Every eight bytes are fetched once for all seeds, in slices that stay in the cache. The
        steps can be undone for given bytes, so strings that differ in one place differ.
        """
        out = np.empty((len(seeds), len(at)), np.uint64)
        for a in range(0, len(at), _SLICE):
            own = at[a : a + _SLICE]
            lanes = [np.full(len(own), seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64) for seed in seeds]
            for part in parts:
                eight = self.eight[own + part]
                for n, lane in enumerate(lanes):
                    lane ^= eight
                    lane *= _FACTORS[n]
                    lane ^= lane >> np.uint64(32)
            for n, lane in enumerate(lanes):
                out[n, a : a + _SLICE] = blocks.mix(lane)
        return out


def _result(work: Work | None, covered: np.ndarray | None) -> pa.Table:
    names = ["k", "n_bytes", "n_removed", "n_spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    if work is None:
        return pa.Table.from_arrays([pa.array([], k) for k in kinds], names)
    data, offsets = work.chunk.data, work.chunk.offsets
    count = np.concatenate([[0], np.cumsum(covered)])
    begins = covered.copy()
    begins[1:] &= ~covered[:-1]
    inner = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[inner] = covered[inner]
    spans = np.concatenate([[0], np.cumsum(begins)])
    kept = [data[a:b][~covered[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return pa.Table.from_arrays([work.chunk.keys, pa.array(np.diff(offsets)), pa.array(np.diff(count[offsets])), pa.array(np.diff(spans[offsets])), pa.array(kept, pa.binary())], names)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` is what stays, in bytes.

    A byte goes if a 50-byte string that covers it also starts in a smaller id. Rows that share
    an id do not remove from one another; rows without an id come after all others and are
    treated as sharing one. Null texts are empty. Ids are whole numbers.
    """
    found = repeats(docs, doc_id, text, ByteWindows, _result, "k bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return found.withColumnRenamed("k", doc_id)
