"""Best-fit packing by minimum bin slack over the histogram of piece lengths.

Documents are tokenized once into pieces of at most ``CAPACITY`` tokens. What a sequence can
hold depends on lengths alone, of which there are at most ``CAPACITY``, so the packing is
planned on their histogram: the longest length left starts a bin, a bitset subset-sum over the
lengths still available finds the fullest combination, and that combination is taken for as
many bins as its lengths last. Every combination leaves less than half of some length's stock,
so there are at most CAPACITY * log2(rows) of them at any number of documents; this bounds
the plan that the driver makes and broadcasts.

Pieces find their places by rank among those of their length. Ranks are counted in salted
groups, so that a frequent length is no hot group.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks
from .spread import durable

# Fixed value: what the tokenizer's last piece of a word ends with.
WORD_END = "</w>"
CAPACITY = 4096
END_ID = 1
# Words that each of the two parts of a task's cache holds.
CACHE_WORDS = 200_000
RANK_ROWS = 20_000

# A full stop or comma that ends a word is a piece of its own to the tokenizer, if one of these is before it.
_STOP = np.isin(np.arange(256), np.frombuffer(b".,", np.uint8))
_BEFORE_STOP = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8))

_LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
# The byte-level alphabet: bytes that are not printable in Latin-1 are the characters from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Encoder:
    """Token ids of texts, word by word with a cache.

    The tokenizer drops white space and never joins across it, so the ids of a text are those
    of its words in a row; and it lower-cases, so capitals need no entries of their own.
    """

    def __init__(self, path: str):
        # Spark runs a task a core; threads of a task's own would only contend with the others.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The merges alone, for words that are letters only: they need no splitting.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[n for token, n in vocabulary.items() if token.endswith(WORD_END)]] = True
        # Words met lately, and those met before; what is met again moves to the first.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        # The strings of special tokens are matched before lower-casing.
        as_is = np.array([b"<|" in text for text in texts], bool)
        raw = b"".join(text if own else text.lower() for text, own in zip(texts, as_is.tolist(), strict=True))
        offsets = np.append(0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))))
        data = np.frombuffer(raw, np.uint8)
        column, first = _words(data, offsets, as_is)
        coded = column.dictionary_encode()
        found = self._ids(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        word = coded.indices.to_numpy()
        size = lengths[word]
        ends = np.append(0, np.cumsum(size))
        # Where the ids of each word are in ``flat``, from where they go.
        shift = (np.cumsum(lengths) - lengths)[word] - ends[:-1]
        ids = flat[np.arange(ends[-1]) + np.repeat(shift, size)].tobytes()
        bounds = (ends[first] * 4).tolist()
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words; what is not known is learned."""
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        found = [*map(self.known.get, words)]
        missing = [n for n, ids in enumerate(found) if ids is None]
        new = []
        for n in missing:
            word = words[n]
            if word in self.older:
                self.known[word] = self.older[word]
            else:
                new.append(word)
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            plain = [_letters(w) for w in part]
            self._learn_letters([w for w, p in zip(part, plain, strict=True) if p], [p for p in plain if p])
            self._learn_others([w for w, p in zip(part, plain, strict=True) if not p])
        for n in missing:
            found[n] = self.known[words[n]]
        return found

    def _learn_letters(self, words: list[bytes], texts: list[str]) -> None:
        """Many words in one call; their ids are cut after the last piece of each."""
        for at in range(0, len(words), 1000):
            own = words[at : at + 1000]
            ids = np.array(self.merges.encode_batch_fast([" ".join(texts[at : at + 1000])], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.last[ids]) + 1) * 4
            if len(ends) != len(own):
                self._learn_others(own)
                continue
            data, start = ids.tobytes(), 0
            for word, end in zip(own, ends.tolist(), strict=True):
                self.known[word] = data[start:end]
                start = end

    def _learn_others(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        for word, ids in zip(words, found, strict=True):
            self.known[word] = array("I", ids.ids).tobytes()


def _words(data: np.ndarray, offsets: np.ndarray, as_is: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, first): the words of each text, stops apart but in texts that are ``as_is``; text r has first[r] to first[r + 1]."""
    starts, ends, first = blocks.words(data, offsets, ~blocks.SPACE)
    last = np.maximum(ends - 1, 0)
    stop = _STOP[data[last]] & (ends - starts > 1) & _BEFORE_STOP[data[np.maximum(last - 1, 0)]]
    stop &= ~np.repeat(as_is, np.diff(first))
    # Words with a stop count twice; each piece ends where the next one begins once white space is gone.
    after = np.append(0, np.cumsum(1 + stop))
    sizes = np.repeat(ends - starts, 1 + stop)
    own = after[1:][stop] - 1
    sizes[own] = 1
    sizes[own - 1] -= 1
    cuts = np.append(0, np.cumsum(sizes)).astype(np.int32)
    column = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(cuts), pa.py_buffer(data[~blocks.SPACE[data]])])
    return column, after[first]


def _letters(word: bytes) -> str | None:
    """A lower-case word of ASCII or Latin-1 letters in the byte alphabet of the merges, else None."""
    if word.isalpha() and word.islower():
        return word.decode()
    text = word.decode()
    if _LATIN.fullmatch(text):
        return word.decode("latin-1").translate(_BYTES)
    return None


_ENCODERS: dict[str, Encoder] = {}


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(k, piece, start, length, ids_crc32[, ids]) of every row; ids end with END_ID.

    A null or empty text is the one token END_ID. ``ids`` are little-endian 32-bit numbers.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["k", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def work(batches):
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(tokenizer)
        for batch in blocks.cut(batches, "t"):
            data, offsets = blocks.text_bytes(batch.column("t"))
            raw = data.tobytes()
            found = _ENCODERS[tokenizer].encode([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
            end = np.array([END_ID], "<u4").tobytes()
            row, rows = [], []
            for r, ids in enumerate(found):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    row.append(r)
                    rows.append((n, at // 4, len(own) // 4, zlib.crc32(own), own))
            columns = [pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(row)), *columns][: len(names)], names)

    schema = f"k {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t")).mapInArrow(work, schema)


def fullest(stock: np.ndarray, capacity: int) -> dict[int, int]:
    """The longest length in stock, with the combination of others that fills its bin best."""
    first = int(np.flatnonzero(stock)[-1])
    room = capacity - first
    steps, reach, mask = [], 1, (1 << (room + 1)) - 1
    for length in np.flatnonzero(stock[: room + 1])[::-1].tolist():
        count = min(int(stock[length]) - (length == first), room // length)
        unit = 1
        while count > 0 and not reach >> room & 1:
            take = min(unit, count)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            count -= take
            unit *= 2
        if reach >> room & 1:
            break
    left = reach.bit_length() - 1
    combination = {first: 1}
    for length, take, before in reversed(steps):
        if not before >> left & 1:
            combination[length] = combination.get(length, 0) + take
            left -= length * take
    return combination


def plan(stock: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(bins, combination) until the stock of each length is used up."""
    stock = stock.copy()
    out = []
    while stock.any():
        combination = fullest(stock, capacity)
        bins = min(int(stock[length]) // n for length, n in combination.items())
        for length, n in combination.items():
            stock[length] -= bins * n
        out.append((bins, combination))
    return out


def places(bins: list[tuple[int, dict[int, int]]], capacity: int) -> dict[int, np.ndarray]:
    """For each length, rows of (first rank, first sequence, pieces a sequence, offset)."""
    used = np.zeros(capacity + 1, np.int64)
    found: dict[int, list] = {}
    sequence = 0
    for count, combination in bins:
        offset = 0
        for length, n in sorted(combination.items(), reverse=True):
            found.setdefault(length, []).append((int(used[length]), sequence, n, offset))
            used[length] += count * n
            offset += length * n
        sequence += count
    return {length: np.array(rows, np.int64) for length, rows in found.items()}


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of every piece.

    Sequences hold at most ``capacity`` tokens, their pieces without gaps from offset 0. Rows
    that share an id, repeats included, are packed as documents of their own.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    cut = durable(pieces(docs, tokenizer, doc_id, text, capacity, keep_ids))
    stock = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").count().collect():
        stock[row["length"]] = row["count"]
    sent = docs.sparkSession.sparkContext.broadcast(places(plan(stock, capacity), capacity))
    salts = max(64, int(stock.max() // RANK_ROWS) + 1)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("k", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counted = salted.groupBy("length", "salt").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    counted = counted.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("k", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("own", own).join(counted, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("before"))
    names = ["k", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def work(batches):
        table = sent.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            begin = np.flatnonzero(blocks.first_in_group(length[order]))
            for a, b in zip(begin, np.append(begin, len(order))[1:], strict=True):
                rows = order[a:b]
                size = int(length[rows[0]])
                slots = table[size]
                slot = slots[np.searchsorted(slots[:, 0], rank[rows], "right") - 1]
                within = rank[rows] - slot[:, 0]
                sequence[rows] = slot[:, 1] + within // slot[:, 2]
                offset[rows] = slot[:, 3] + within % slot[:, 2] * size
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = f"k {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    placed = ranked.select(*names, "rank").mapInArrow(work, f"{schema}, sequence_id bigint, offset bigint")
    return placed.withColumnRenamed("k", doc_id)
