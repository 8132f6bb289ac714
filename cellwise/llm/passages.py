"""Repeated passages of words, by fixed-block anchors.

A window is ``WINDOW`` consecutive words of one document. Every document is cut into
non-overlapping blocks of half a window, and their hashes are the index; every rolling window
of a block's length, in every document, probes it. A repeated window holds a whole block of
its own document, so that block is hit by the other occurrence's rolling window. A hit is
extended over all windows that hold it, and windows that start earlier elsewhere are chained
to maximal repeats, whose words are removed.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks
from .repeats import Chunk, Windows, Work, repeats

WINDOW = 20
_BLOCK = WINDOW // 2
_WORD = ~blocks.SPACE


class WordWindows(Windows):
    length = WINDOW
    within = True
    reach = WINDOW - _BLOCK

    def items(self, chunk: Chunk) -> np.ndarray:
        starts, ends, self.first = blocks.words(chunk.data, chunk.offsets, _WORD)
        self.each = blocks.word_hashes(chunk.data, starts, ends, 1)
        self.sums = blocks.rolling(11).sums(self.each)
        return self.first

    def boundaries(self) -> np.ndarray:
        """A word of every sixteen or so, with the one before it."""
        mark = np.zeros(len(self.each), bool)
        mark[1:] = (self.each[1:] + self.each[:-1] * np.uint64(3)) >> np.uint64(60) == 0
        return mark

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return blocks.rolling(11).windows(self.sums, starts, ends), self._second(starts, ends)

    def _second(self, starts: np.ndarray, ends: np.ndarray | int) -> np.ndarray:
        return blocks.rolling(12).windows(blocks.rolling(12).sums(blocks.mix(self.each)), starts, ends)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(self.first)
        place = np.arange(len(self.each)) - np.repeat(self.first[:-1], sizes)
        at = np.flatnonzero(place + _BLOCK <= np.repeat(sizes, sizes))
        return at, place[at] % _BLOCK == 0

    def anchor_hashes(self, at: np.ndarray) -> np.ndarray:
        return blocks.rolling(11).windows(self.sums, at, _BLOCK)

    def hashes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return blocks.rolling(11).windows(self.sums, starts, WINDOW), self._second(starts, WINDOW)


def _result(work: Work | None, covered: np.ndarray | None) -> pa.Table:
    names = ["k", "n_words", "n_removed", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    if work is None:
        return pa.Table.from_arrays([pa.array([], k) for k in kinds], names)
    raw = work.chunk.data.tobytes()
    offsets, first = work.chunk.offsets.tolist(), work.first
    kept = []
    for r in range(len(first) - 1):
        words = raw[offsets[r] : offsets[r + 1]].split()
        kept.append(b" ".join(compress(words, (~covered[first[r] : first[r + 1]]).tolist())))
    removed = np.diff(np.concatenate([[0], np.cumsum(covered)])[first])
    kept = pa.array(kept, pa.binary()).cast(pa.string())
    return pa.Table.from_arrays([work.chunk.keys, pa.array(np.diff(first)), pa.array(removed), kept], names)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; ``kept`` is the text that stays.

    A word goes if a window that covers it also starts earlier: in a smaller id, or earlier in
    the same row. Rows that share an id do not remove from one another; rows without an id come
    after all others and are treated as sharing one. Null and empty texts have no words. Ids
    are whole numbers.
    """
    found = repeats(docs, doc_id, text, WordWindows, _result, "k bigint, n_words bigint, n_removed bigint, kept string")
    return found.withColumnRenamed("k", doc_id)
