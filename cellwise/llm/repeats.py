"""Windows that occur elsewhere too, found in three exchanges of packed hashes.

Both exact repeat operators ask, for every window of fixed length, for the smallest document
that holds it. Texts are dealt into chunks of a few megabytes by a hash of their rows. A chunk
sends, for each bucket of the hash space, one row with the packed hashes that fall there, and
gets back one bit for each; so a hash costs its own few bytes and an answer one bit, and a
frequent hash is sent once by a chunk however often it occurs in it.

1. *Segments* between content-defined boundaries are compared whole. Where a smaller document
   has the same segment, all windows that start in it are repeats, and the segment is closed:
   the smallest document that holds any of its windows is open there, so closed segments need
   not be looked at again. Copies cost little after this.
2. *Anchors*, a sparse subset of the positions under open windows, are sent with short hashes.
   A hash that another chunk sent too (or that is repeated within the chunk) marks its anchor
   as a hit. The anchors are chosen such that each window that occurs twice holds a hit in
   both places, so false hits cost time only.
3. Open *windows* around hits are sent with a full 64-bit hash, in buckets taken from a second
   independent hash, with the smallest document of the chunk that holds them. The answer tells
   whether a smaller document has it elsewhere.

All is one plan: the texts are shuffled once, and the later steps read the same shuffle.
"""

from __future__ import annotations

from abc import ABC, abstractmethod

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .spread import shuffle_partitions, text_size

CHUNK_BYTES = 3 << 20
BUCKET_BYTES = 4 << 20
LEAST = 256
NO_ID = np.iinfo(np.int64).max
# Bytes sent of a piece's hash; the bucket, from another hash, adds at least eight bits to them.
_HASH_BYTES = 7
# Bits that number the anchors of a chunk, beside those of bucket and key in one sorted word.
_PLACE = 22


class Chunk:
    """The rows of one chunk by id and text; rows without an id come last and count as one id."""

    def __init__(self, rows: pa.Table):
        packed = rows.column("z").to_pylist()
        texts = pa.array([zstandard.decompress(z) for z in packed], pa.binary())
        rows = pa.table({"k": rows.column("k"), "t": texts}).sort_by([("k", "ascending"), ("t", "ascending")]).combine_chunks()
        self.keys = pa.concat_arrays(rows.column("k").chunks) if rows.num_rows else pa.array([], pa.int64())
        self.data, self.offsets = blocks.text_bytes(rows.column("t"))
        self.ids = self.keys.fill_null(NO_ID).to_numpy().astype(np.int64)


class Windows(ABC):
    """What one operator counts as items, boundaries, anchors and windows of a chunk."""

    length: int
    within: bool
    reach: int

    @abstractmethod
    def items(self, chunk: Chunk) -> np.ndarray:
        """Where each row's items begin, and the end of the last."""

    @abstractmethod
    def boundaries(self) -> np.ndarray:
        """A mark at each item where a segment may begin, by what follows it."""

    @abstractmethod
    def spans(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of [start, end), of different lengths."""

    @abstractmethod
    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and whether they are index entries (others only probe).

        A window holds the anchors from its start to ``reach`` items after it.
        """

    @abstractmethod
    def anchor_hashes(self, at: np.ndarray) -> np.ndarray:
        """Hashes at some anchors."""

    @abstractmethod
    def hashes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of whole windows."""


def _grouped(bucket: np.ndarray, hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by (bucket, hash, place), and which of the ordered begin a new (bucket, hash).

    One sort of single words, the leading bits of bucket and hash with the place below them,
    does nearly all; where words agree before the place and hashes do not, these are put right.
    """
    if len(hashes) >= 1 << _PLACE:
        order = np.lexsort((hashes, bucket))
    else:
        low = np.uint64(_PLACE)
        word = (bucket.astype(np.uint64) << np.uint64(64 - bits) | hashes >> np.uint64(bits)) if bits else hashes.copy()
        word = np.sort(word >> low << low | np.arange(len(hashes), dtype=np.uint64))
        order = (word & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        word >>= low
        own = hashes[order]
        alike = word[1:] == word[:-1]
        if (alike & (own[1:] != own[:-1])).any():
            run = np.append(0, np.cumsum(~alike))
            mixed = np.isin(run, run[1:][alike & (own[1:] != own[:-1])])
            there = np.flatnonzero(mixed)
            order[there] = order[there[np.lexsort((order[there], own[there], run[there]))]]
    return order, blocks.first_in_group(hashes[order]) | blocks.first_in_group(bucket[order])


class Groups:
    """Equal pieces of a chunk; each group's first is of its smallest id."""

    def __init__(self, hashes: np.ndarray, second: np.ndarray, row: np.ndarray, ids: np.ndarray, buckets: int, within: bool):
        bits = buckets.bit_length() - 1
        bucket = (second % np.uint64(buckets)).astype(np.int32)
        self.order, new = _grouped(bucket, hashes, bits)
        group = np.cumsum(new) - 1
        lead = self.order[new]
        # Groups stand by bucket and then by place, which keeps equal ids together.
        by_place = np.sort(bucket[lead].astype(np.int64) << 40 | lead) & (1 << 40) - 1
        place = np.empty(len(bucket), np.int64)
        place[by_place] = np.arange(len(lead))
        self.group = place[lead][group]
        lead = by_place
        self.bucket, self.hash, self.id = bucket[lead], hashes[lead], ids[row[lead]]
        own = row[self.order]
        self.later = ids[own] > self.id[self.group]
        if within:
            same = ~new
            same[1:] &= own[1:] == own[:-1]
            self.later |= same

    def ask(self):
        for bucket, a, b in _slices(self.bucket):
            ids = self.id[a:b]
            begin = np.flatnonzero(blocks.first_in_group(ids))
            runs = np.diff(np.append(begin, b - a)).astype(np.uint32)
            yield bucket, _narrow(self.hash[a:b], _HASH_BYTES), ids[begin].tobytes() + runs.tobytes()

    def repeated(self, answers: dict[int, bytes]) -> np.ndarray:
        """Marks the pieces that an earlier place has too."""
        out = np.empty(len(self.order), bool)
        out[self.order] = self.later | _read(self.bucket, answers)[self.group]
        return out


class Work:
    """The steps on one chunk; later steps repeat earlier ones and read the answers to them."""

    def __init__(self, kind: type[Windows], buckets: int, rows: pa.Table):
        self.chunk = Chunk(rows)
        self.windows = kind()
        self.first = self.windows.items(self.chunk)
        self.n = int(self.first[-1])
        self.buckets = buckets

    def _row(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, "right") - 1

    def _find_segments(self) -> Groups:
        length = self.windows.length
        mark = self.windows.boundaries()
        long = np.flatnonzero(np.diff(self.first) >= length)
        mark[self.first[long]] = True
        starts = np.flatnonzero(mark)
        row = self._row(starts)
        stops = self.first[row + 1] - length + 1
        inside = starts < stops
        self.segment, row, stops = starts[inside], row[inside], stops[inside]
        self.segment_stop = np.minimum(np.append(self.segment[1:], self.n), stops)
        hashes, second = self.windows.spans(self.segment, self.segment_stop + length - 1)
        return Groups(hashes, second, row, self.chunk.ids, self.buckets, self.windows.within)

    def ask_segments(self):
        return self._find_segments().ask()

    def _open(self, answers: dict[int, bytes]) -> np.ndarray:
        """Marks the starts of windows in open segments."""
        self.closed = self._find_segments().repeated(answers)
        edge = np.zeros(self.n + 1, np.int8)
        edge[self.segment[~self.closed]] += 1
        edge[self.segment_stop[~self.closed]] -= 1
        return np.cumsum(edge[:-1], dtype=np.int8) > 0

    def _find_anchors(self, segments: dict[int, bytes]) -> None:
        """Distinct anchor hashes by bucket: where they stand, whether indexed, whether repeated here."""
        self.open = self._open(segments)
        at, indexed = self.windows.anchors()
        count = np.zeros(self.n + 1, np.int32)
        np.cumsum(self.open, out=count[1:])
        under = count[at + 1] > count[np.maximum(at - self.windows.reach, 0)]
        self.anchor_at, indexed = at[under], indexed[under]
        bits = self.buckets.bit_length() - 1
        keys = min(30, 64 - _PLACE - bits)
        value = self.windows.anchor_hashes(self.anchor_at) >> np.uint64(64 - bits - keys)
        if len(value) < 1 << _PLACE:
            word = np.sort(value << np.uint64(_PLACE) | np.arange(len(value), dtype=np.uint64))
            order = (word & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
            value = word >> np.uint64(_PLACE)
        else:
            order = np.argsort(value, kind="stable")
            value = value[order]
        new = blocks.first_in_group(value)
        begin = np.flatnonzero(new)
        self.anchor_twice = np.diff(np.append(begin, len(value))) > 1
        self.anchor_index = np.logical_or.reduceat(indexed[order], begin) if len(begin) else np.zeros(0, bool)
        value = value[begin]
        self.anchor_bucket = (value >> np.uint64(keys)).astype(np.int32)
        self.anchor_key = (value & np.uint64((1 << keys) - 1)).astype(np.uint32)
        self.anchor_at = self.anchor_at[order]
        self.anchor_of = np.cumsum(new) - 1

    def ask_anchors(self, segments: dict[int, bytes]):
        self._find_anchors(segments)
        for bucket, a, b in _slices(self.anchor_bucket):
            yield bucket, _ascending(self.anchor_key[a:b]), np.packbits(self.anchor_index[a:b]).tobytes()

    def _find_windows(self, segments: dict[int, bytes], anchors: dict[int, bytes]) -> Groups:
        """Open windows around hits."""
        self._find_anchors(segments)
        hit = self.anchor_twice | _read(self.anchor_bucket, anchors)
        near = self.anchor_at[hit[self.anchor_of]]
        edge = np.bincount(np.maximum(near - self.windows.reach, 0), minlength=self.n + 1)
        edge[: self.n + 1] -= np.bincount(near + 1, minlength=self.n + 1)
        self.window = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & self.open)
        return Groups(*self.windows.hashes(self.window), self._row(self.window), self.chunk.ids, self.buckets, self.windows.within)

    def ask_windows(self, segments: dict[int, bytes], anchors: dict[int, bytes]):
        return self._find_windows(segments, anchors).ask()

    def covered(self, segments: dict[int, bytes], anchors: dict[int, bytes], windows: dict[int, bytes]) -> np.ndarray:
        """Marks the items that a repeated window covers."""
        repeated = self._find_windows(segments, anchors).repeated(windows)
        length = self.windows.length
        starts = np.concatenate([self.segment[self.closed], self.window[repeated]])
        stops = np.concatenate([self.segment_stop[self.closed] + length - 1, self.window[repeated] + length])
        edge = np.bincount(starts, minlength=self.n + 1) - np.bincount(stops, minlength=self.n + 1)
        return np.cumsum(edge[:-1]) > 0


SEGMENTS, ANCHORS, WINDOWS = range(3)


def _slices(bucket: np.ndarray):
    begin = np.flatnonzero(blocks.first_in_group(bucket))
    for a, b in zip(begin, np.append(begin, len(bucket))[1:], strict=True):
        yield int(bucket[a]), a, b


def _narrow(values: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit or 32-bit numbers."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1)[:, :width]).tobytes()


def _wide(data: bytes, width: int, kind: type) -> np.ndarray:
    out = np.zeros((len(data) // width, np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view(kind)[:, 0]


def _ascending(keys: np.ndarray) -> bytes:
    """Increasing numbers as their differences, in three bytes each where that is enough."""
    steps = np.diff(keys, prepend=np.uint32(0))
    width = 3 if steps.max(initial=0) < 1 << 24 else 4
    return bytes([width]) + _narrow(steps, width)


def _ascended(data: bytes) -> np.ndarray:
    return np.cumsum(_wide(data[1:], data[0], np.uint32), dtype=np.uint32)


def _read(bucket: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """One bit for each asked item; a bucket without an answer says no to all."""
    out = np.zeros(len(bucket), bool)
    for number, a, b in _slices(bucket):
        if number in answers:
            out[a:b] = np.unpackbits(np.frombuffer(answers[number], np.uint8), count=b - a)
    return out


def _answers(rows: pa.Table, step: int) -> dict[int, bytes]:
    return {b: bits for b, s, bits in zip(rows.column("bucket").to_pylist(), rows.column("step").to_pylist(), rows.column("bits").to_pylist(), strict=True) if s == step}


def _packed(asked, chunk: int) -> pa.Table:
    rows = [(chunk, bucket, a, b) for bucket, a, b in asked]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["chunk", "bucket", "x", "y"])


def _reply(rows: pa.Table, step: int, sizes: np.ndarray, bits: np.ndarray) -> pa.Table:
    """The bits of each packed row, without rows whose bits are all zero."""
    ends = np.cumsum(sizes)
    out = []
    for chunk, bucket, a, b in zip(rows.column("chunk").to_pylist(), rows.column("bucket").to_pylist(), ends - sizes, ends, strict=True):
        if bits[a:b].any():
            out.append((chunk, bucket, step, np.packbits(bits[a:b]).tobytes()))
    return pa.Table.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["chunk", "bucket", "step", "bits"])


def _compressed(batches):
    """Texts as they are shuffled; null is empty."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in blocks.cut(batches, "t"):
        packed = [packer.compress((t or "").encode()) for t in batch.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("chunk"), pa.array(packed, pa.binary())], ["k", "chunk", "z"])


def match_anchors(rows: pa.Table) -> pa.Table:
    """Anchors of one bucket: those whose hash is indexed and was sent by two chunks."""
    keys = [_ascended(x) for x in rows.column("x").to_pylist()]
    sizes = np.array([len(k) for k in keys])
    indexed = np.concatenate([np.unpackbits(np.frombuffer(y, np.uint8), count=n) for y, n in zip(rows.column("y").to_pylist(), sizes, strict=True)]).astype(bool)
    keys = np.concatenate(keys)
    index = np.sort(keys[indexed])
    index = index[blocks.first_in_group(index)]
    every = np.sort(keys)
    twice = every[1:][every[1:] == every[:-1]]
    hits = index[_within(index, twice)]
    return _reply(rows, ANCHORS, sizes, _within(keys, hits))


def _within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if len(ordered) == 0:
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def match_pieces(rows: pa.Table, step: int) -> pa.Table:
    """Segments or windows of one bucket: those that a smaller id of another chunk has too."""
    keys = [_wide(x, _HASH_BYTES, np.uint64) for x in rows.column("x").to_pylist()]
    sizes = np.array([len(k) for k in keys])
    ids = []
    for y in rows.column("y").to_pylist():
        n = len(y) // 12
        ids.append(np.repeat(np.frombuffer(y, np.int64, n), np.frombuffer(y, np.uint32, n, 8 * n)))
    keys, ids = np.concatenate(keys), np.concatenate(ids)
    order = np.argsort(keys, kind="stable")
    begin = np.flatnonzero(blocks.first_in_group(keys[order]))
    least = np.minimum.reduceat(ids[order], begin)
    lost = np.empty(len(keys), bool)
    lost[order] = ids[order] > np.repeat(least, np.diff(np.append(begin, len(keys))))
    return _reply(rows, step, sizes, lost)


def repeats(docs: DataFrame, doc_id: str, text: str, kind: type[Windows], result, schema: str) -> DataFrame:
    """``result(work, covered)`` of every chunk, where ``covered`` marks repeated items."""
    _, size = text_size(docs, text)
    chunks = max(LEAST, -(-size // CHUNK_BYTES))
    buckets = 1 << (max(LEAST, -(-size // BUCKET_BYTES)) - 1).bit_length()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("k"), F.col(text).alias("t"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("k", "t"), F.lit(chunks)).cast("int"))
    rows = rows.mapInArrow(_compressed, "k bigint, chunk int, z binary")
    asked_schema = "chunk int, bucket int, x binary, y binary"
    answer_schema = "chunk int, bucket int, step int, bits binary"

    def first(key, table):
        return _packed(Work(kind, buckets, table).ask_segments(), key[0].as_py())

    def second(key, table, answers):
        if table.num_rows == 0:
            return _packed([], 0)
        return _packed(Work(kind, buckets, table).ask_anchors(_answers(answers, SEGMENTS)), key[0].as_py())

    def third(key, table, answers):
        if table.num_rows == 0:
            return _packed([], 0)
        return _packed(Work(kind, buckets, table).ask_windows(_answers(answers, SEGMENTS), _answers(answers, ANCHORS)), key[0].as_py())

    def last(key, table, answers):
        if table.num_rows == 0:
            return result(None, None)
        work = Work(kind, buckets, table)
        return result(work, work.covered(*(_answers(answers, step) for step in (SEGMENTS, ANCHORS, WINDOWS))))

    by_chunk = rows.groupBy("chunk")

    def answered(asked: DataFrame, reply) -> DataFrame:
        found = asked.groupBy("bucket").applyInArrow(reply, answer_schema)
        return found.repartition(shuffle_partitions(docs.sparkSession), "chunk")

    segments = answered(by_chunk.applyInArrow(first, asked_schema), lambda t: match_pieces(t, SEGMENTS))
    anchors = answered(by_chunk.cogroup(segments.groupBy("chunk")).applyInArrow(second, asked_schema), match_anchors)
    both = segments.union(anchors)
    windows = answered(by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(third, asked_schema), lambda t: match_pieces(t, WINDOWS))
    return by_chunk.cogroup(both.union(windows).groupBy("chunk")).applyInArrow(last, schema)
