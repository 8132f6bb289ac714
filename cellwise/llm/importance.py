"""Importance resampling: a share of documents drawn by their likeness to a target.

Features of a text are its words and pairs of neighbouring words, hashed into ``BUCKETS``
buckets. A bucket's gain is the smoothed logarithm of how much more frequent it is in the
target than in the source, in thousandths, and a document's weight the mean gain of its
features. A Gumbel draw from the document's id is added, so that the highest scores are a
sample without replacement whose odds are the weights.

Exact ranks come from parallel sorting by regular sampling: tasks sort their rows and give
every w-th key of their runs, the driver picks regular splitters from these, runs are
exchanged by splitter and merged, and prefix sums over the counts of the segments turn places
within a segment into ranks. Segments wholly behind the last drawn rank are never exchanged.

Keys are (score down, id up, features, row): equal rows of one id have keys of their own, so
a hot id is no hot segment.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks
from .spread import durable, shuffle_partitions

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7

# Bytes of text that a task takes apart at a time; a word is an object and some sixty bytes of numbers.
BLOCK = 1 << 18

# Rows a segment should hold, the most segments, and the most sampled keys for the driver.
SEGMENT_ROWS = 250_000
SEGMENTS = 1024
SAMPLED = 1 << 20

# Bytes of words: digits, letters and what is beyond ASCII; capitals become small, others white space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# Fixed value: the polynomial of CRC-32, bits reversed.
_POLYNOMIAL = 0xEDB88320


@lru_cache
def _shift_tables(bit: int) -> np.ndarray:
    """Four tables of 256: a CRC register after 2^bit zero bytes, by the bytes of the register."""
    if bit:
        below = _shift_tables(bit - 1)
        return _moved(below.ravel(), bit - 1).reshape(4, 256)
    register = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    for _ in range(8):
        register = (register >> 1) ^ np.where(register & 1, np.uint32(_POLYNOMIAL), np.uint32(0))
    return register


def _moved(register: np.ndarray, bit: int) -> np.ndarray:
    tables = _shift_tables(bit)
    return tables[0][register & 255] ^ tables[1][register >> 8 & 255] ^ tables[2][register >> 16 & 255] ^ tables[3][register >> 24]


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings joined, from those of each and the length of the second."""
    register = first.copy()
    for bit in range(int(length.max(initial=0)).bit_length()):
        own = np.flatnonzero(length >> bit & 1)
        register[own] = _moved(register[own], bit)
    return register ^ second


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, pairs, counts): buckets of all words and of all pairs, and the number of words of each text."""
    words = [text.translate(_FOLD).split() for text in texts]
    count = np.array([len(w) for w in words], np.int64)
    total = int(count.sum())
    crc = np.fromiter((zlib.crc32(word) for own in words for word in own), np.uint32, total)
    length = np.fromiter((len(word) for own in words for word in own), np.uint32, total)
    del words
    follows = np.ones(total, bool)
    follows[(np.cumsum(count) - count)[count > 0]] = False
    second = np.flatnonzero(follows).astype(np.int32)
    space = joined_crc(crc[second - 1], np.full(len(second), zlib.crc32(b" "), np.uint32), np.ones(len(second), np.uint8))
    pair = joined_crc(space, crc[second], length[second])
    return (crc % BUCKETS).astype(np.int32), (pair % BUCKETS).astype(np.int32), count


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each run of ``counts`` values."""
    total = np.append(0, np.cumsum(values))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Features of all texts in each bucket; tasks add up their own before they send them."""

    def work(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in blocks.cut(batches, "t", BLOCK):
            for buckets in features(_texts(batch.column("t")))[:2]:
                total += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    parts = texts.select(F.col(text).alias("t")).mapInArrow(work, "bucket bigint, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def _texts(column: pa.Array) -> list[bytes]:
    data, offsets = blocks.text_bytes(column)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share in the target and in the source."""
    all_source, all_target = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target))) for s, t in pairs], np.int64)


def _draw(name) -> int:
    """The Gumbel part of a score, in thousandths; a null id is drawn as the empty string."""
    h = int(hashlib.sha256(f"{SEED}:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, n_words, n_features, weight, score) of every row."""
    # BUCKETS numbers, whatever the input.
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches):
        table = sent.value
        for batch in blocks.cut(batches, "t", BLOCK):
            single, double, words = features(_texts(batch.column("t")))
            pairs = np.maximum(words - 1, 0)
            n_features = words + pairs
            weight = (sums(table[single], words) + sums(table[double], pairs)) // np.maximum(n_features, 1)
            score = weight + np.array([_draw(name) for name in batch.column("k").to_pylist()], np.int64)
            arrays = [pa.array(x, pa.int64()) for x in (words, n_features, weight, score)]
            yield pa.RecordBatch.from_arrays([batch.column("k"), *arrays], ["k", "n_words", "n_features", "weight", "score"])

    schema = f"k {kind}, n_words bigint, n_features bigint, weight bigint, score bigint"
    return docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t")).mapInArrow(work, schema)


def _order() -> list:
    return [F.desc("score"), F.asc_nulls_first("k"), F.asc("n_features"), F.asc("row")]


def _key(score: int, name, features: int, row: int) -> tuple:
    return -score, name is not None, name if name is not None else 0, features, row


def _splitters(rows: DataFrame, count: int, segments: int) -> list[tuple]:
    """Keys that cut the rows into ``segments``, regularly taken from regular samples of sorted runs.

    A run gives every ``step``-th of its keys, so a segment holds at most its share and one
    step a run: twice its share while runs times segments are no more than SAMPLED.
    """
    runs = max(1, rows.select(F.spark_partition_id().alias("p")).distinct().count())
    step = max(1, count // min(SAMPLED, segments * runs))

    def work(batches):
        seen = 0
        for batch in batches:
            at = np.arange(-(seen + 1) % step, batch.num_rows, step)
            seen += batch.num_rows
            yield batch.take(pa.array(at))

    keys = rows.select("score", "k", "n_features", "row").sortWithinPartitions(*_order())
    sampled = sorted(_key(*row) for row in keys.mapInArrow(work, keys.schema).collect())
    cuts = [len(sampled) * n // segments for n in range(1, segments)]
    return sorted({sampled[c] for c in cuts if c < len(sampled)})


def _placed(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """The rows with the number of the segment that holds their key."""
    # Fewer than SEGMENTS keys.
    sent = rows.sparkSession.sparkContext.broadcast(splitters)

    def work(batches):
        cuts = sent.value
        scores = np.array([c[0] for c in cuts], np.int64)
        for batch in batches:
            score = -batch.column("score").to_numpy()
            segment = np.searchsorted(scores, score, "left")
            # Only a score that some splitter has needs the rest of the key.
            tied = np.flatnonzero(segment != np.searchsorted(scores, score, "right"))
            if len(tied):
                keys = batch.select(["score", "k", "n_features", "row"]).take(pa.array(tied)).to_pydict()
                segment[tied] = [bisect_right(cuts, _key(*key)) for key in zip(*keys.values(), strict=True)]
            yield batch.append_column("segment", pa.array(segment, pa.int64()))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(work, f"{fields}, segment bigint")


def ranked(rows: DataFrame, wanted: int, count: int) -> DataFrame:
    """``rows`` with the rank of the first ``wanted`` of their ``count`` keys, else null."""
    segments = min(SEGMENTS, count, max(shuffle_partitions(rows.sparkSession), -(-count // SEGMENT_ROWS)))
    placed = _placed(rows, _splitters(rows, count, segments))
    sizes = sorted((r["segment"], r["count"]) for r in placed.groupBy("segment").count().collect())
    starts = list(zip((s for s, _ in sizes), accumulate((n for _, n in sizes), initial=0), strict=False))
    kept = [(segment, start) for segment, start in starts if start < wanted]
    last = kept[-1][0]
    known = F.broadcast(rows.sparkSession.createDataFrame(kept, "segment bigint, start bigint"))
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*_order())) + F.col("start")
    drawn = placed.where(F.col("segment") <= last).join(known, "segment").withColumn("place", place)
    drawn = drawn.select(*rows.columns, F.when(F.col("place") <= wanted, F.col("place")).alias("rank"))
    return drawn.unionByName(placed.where(F.col("segment") > last).select(*rows.columns, F.lit(None).cast("bigint").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.

    Of the N rows with MIN_WORDS words or more the floor(percent * N / 100) highest scores are
    drawn and ranked from 1; ties go to the smaller id, a null id first, then to the text with
    fewer features. A null or empty text has no features and weight 0. Rows that share an id
    are rows of their own with one Gumbel draw; other columns are not read.
    """
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    rows = durable(scored(docs, gain, doc_id, text).withColumn("row", F.monotonically_increasing_id()))
    able = rows.where(F.col("n_words") >= MIN_WORDS)
    count = able.count()
    wanted = percent * count // 100
    none = F.lit(None).cast("bigint").alias("rank")
    if wanted:
        found = ranked(able, wanted, count).unionByName(rows.where(F.col("n_words") < MIN_WORDS).select("*", none))
    else:
        found = rows.select("*", none)
    return found.select(F.col("k").alias(doc_id), "n_features", "weight", "score", "rank")
