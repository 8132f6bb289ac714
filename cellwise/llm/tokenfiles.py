"""Files of token ids whose document boundaries are an Elias-Fano sequence.

A data set is a folder: ``ids/`` holds token files, ``manifest`` is a table with one row a file
(file, part, seq, docs, ids). The manifest alone says which files count, so what a lost task
has left behind is ignored. Files follow each other in ascending order of document id, nulls
first, rows of one id by their text.

A token file is the ids of its documents one after the other (little-endian, two bytes where
the vocabulary allows it), then the document ids as an Arrow stream, the boundary sequence and
a fixed tail that says where the parts are. Boundaries take about two bits and the logarithm
of the mean length for each document: their high parts stand in unary in a bit vector, their
low bits packed beside it, and a 32-bit sample for every 512th one bit lets a reader select
any boundary by scanning one stretch of the vector. There are no 64-bit tables.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks
from .packing import Encoder

END_ID = 2
# A file is closed after so many ids or documents; a document is never cut.
FILE_IDS = 1 << 26
FILE_DOCS = 1 << 20
SAMPLE = 512
# Ids that a reader holds at a time, whole documents at least.
READ_IDS = 1 << 20

MAGIC = b"idfile01"
# documents, ids, bytes an id, low bits, then the lengths of the four parts.
TAIL = struct.Struct("<QQBB6xQQQQ8s")


class EliasFano:
    """A rising sequence of numbers in near-minimal space, any of them found by rank."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        bound = int(values[-1]) if n else 0
        low_bits = max(0, (bound // n).bit_length() - 1) if n else 0
        ones = (values >> low_bits) + np.arange(n, dtype=np.int64)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        low = np.zeros((n, low_bits), np.uint8)
        for bit in range(low_bits):
            low[:, bit] = values >> bit & 1
        return cls(n, low_bits, np.packbits(low, bitorder="little"), np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def range(self, first: int, last: int) -> np.ndarray:
        """The values of rank first to last - 1."""
        if first >= last:
            return np.zeros(0, np.int64)
        block = first // SAMPLE
        start = int(self.samples[block]) // 8
        after = -(-last // SAMPLE)
        stop = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[start:stop], bitorder="little")) + start * 8
        # Ones of earlier documents may share the first byte.
        skip = int(np.searchsorted(ones, int(self.samples[block]))) + first - block * SAMPLE
        ranks = np.arange(first, last, dtype=np.int64)
        values = (ones[skip : skip + last - first] - ranks) << self.low_bits
        if self.low_bits:
            begin = first * self.low_bits
            part = np.unpackbits(self.low[begin // 8 : (last * self.low_bits + 7) // 8], bitorder="little")
            part = part[begin % 8 :][: (last - first) * self.low_bits].reshape(-1, self.low_bits)
            for bit in range(self.low_bits):
                values |= part[:, bit].astype(np.int64) << bit
        return values

    def select(self, rank: int) -> int:
        return int(self.range(rank, rank + 1)[0])


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path there."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class FileWriter:
    """One token file; ids go out as they come, boundaries at the end."""

    def __init__(self, system: fs.FileSystem, path: str, id_type: pa.DataType, id_bytes: int):
        self.stream = system.open_output_stream(path)
        self.id_type, self.id_bytes = id_type, id_bytes
        self.ends: list[int] = []
        self.names: list[pa.Array] = []
        self.ids = 0

    @property
    def full(self) -> bool:
        return self.ids >= FILE_IDS or len(self.ends) >= FILE_DOCS

    def add(self, names: pa.Array, texts: list[bytes]) -> None:
        """Documents with their ids as little-endian 32-bit numbers."""
        for own in texts:
            self.ids += len(own) // 4
            self.ends.append(self.ids)
        self.names.append(names)
        data = b"".join(texts)
        self.stream.write(data if self.id_bytes == 4 else np.frombuffer(data, "<u4").astype("<u2").tobytes())

    def close(self) -> None:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("doc_id", self.id_type)])) as writer:
            writer.write_table(pa.table({"doc_id": pa.chunked_array(self.names, self.id_type)}))
        ends = EliasFano.encode(np.array(self.ends, np.int64))
        parts = [sink.getvalue().to_pybytes(), ends.low.tobytes(), ends.high.tobytes(), ends.samples.tobytes()]
        for part in parts:
            self.stream.write(part)
        self.stream.write(TAIL.pack(len(self.ends), self.ids, self.id_bytes, ends.low_bits, *map(len, parts), MAGIC))
        self.stream.close()


class FileReader:
    """Documents of one token file by rank, without reading the ids of others."""

    def __init__(self, path: str):
        system, place = _filesystem(path)
        self.stream = system.open_input_file(place)
        size = self.stream.size()
        docs, ids, self.id_bytes, low_bits, *lengths, magic = TAIL.unpack(self.stream.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {path}")
        at = ids * self.id_bytes
        if at + sum(lengths) + TAIL.size != size:
            raise ValueError(f"token file of wrong length: {path}")
        parts = []
        for length in lengths:
            parts.append(self.stream.read_at(length, at))
            at += length
        self.docs, self.ids = docs, ids
        self.names = pa.ipc.open_stream(parts[0]).read_all().column("doc_id")
        self.ends = EliasFano(docs, low_bits, np.frombuffer(parts[1], np.uint8), np.frombuffer(parts[2], np.uint8), np.frombuffer(parts[3], "<u4"))

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Where the documents of rank first to last - 1 start, and where the last of them ends."""
        before = self.ends.select(first - 1) if first else 0
        return np.append(before, self.ends.range(first, last))

    def tokens(self, start: int, end: int) -> np.ndarray:
        """The ids at places start to end - 1, as 32-bit numbers."""
        data = self.stream.read_at((end - start) * self.id_bytes, start * self.id_bytes)
        return np.frombuffer(data, f"<u{self.id_bytes}").astype("<u4")

    def document(self, rank: int) -> np.ndarray:
        start, end = self.bounds(rank, rank + 1).tolist()
        return self.tokens(start, end)

    def runs(self, limit: int = READ_IDS) -> Iterator[tuple[int, np.ndarray]]:
        """(first rank, bounds) of stretches of about ``limit`` ids, one document at least."""
        for first in range(0, self.docs, SAMPLE):
            last = min(self.docs, first + SAMPLE)
            bounds = self.bounds(first, last)
            at = 0
            while at < last - first:
                stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
                yield first + at, bounds[at : stop + 1]
                at = stop


_ENCODERS: dict[str, Encoder] = {}


def write(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Tokenize ``docs`` into a new data set; the folder must be reachable for all executors.

    Every row is a document, rows that share an id too; a null or empty text is the end id
    alone. Other columns are not read. One shuffle brings the rows into ranges of ids, cut
    further by text and row, so that neither a repeated id nor a repeated row is a hot range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"))
    dealt = rows.withColumn("h", F.xxhash64("t")).withColumn("r", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("k"), F.asc("h"), F.asc("r")]
    ordered = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("k", "t")
    run = uuid.uuid4().hex[:8]

    def work(batches):
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(tokenizer)
        encoder = _ENCODERS[tokenizer]
        end = np.array([end_id], "<u4").tobytes()
        id_bytes = 2 if len(encoder.last) <= 1 << 16 and end_id < 1 << 16 else 4
        system, place = _filesystem(f"{folder}/ids")
        system.create_dir(place, recursive=True)
        task = TaskContext.get()
        open_file, seq = None, 0

        def closed():
            writer.close()
            one = [[name], [task.partitionId()], [seq], [len(writer.ends)], [writer.ids]]
            types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(one, types, strict=True)], ["file", "part", "seq", "docs", "ids"])

        for batch in blocks.cut(batches, "t"):
            if open_file is None:
                # The attempt in the name keeps a repeated task from touching an earlier one's file.
                name = open_file = f"{run}-{task.partitionId():06d}-{task.taskAttemptId()}-{seq:04d}.ids"
                writer = FileWriter(system, f"{place}/{name}", batch.column("k").type, id_bytes)
            data, offsets = blocks.text_bytes(batch.column("t"))
            raw = data.tobytes()
            found = encoder.encode([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
            writer.add(batch.column("k"), [ids + end for ids in found])
            if writer.full:
                yield closed()
                open_file, seq = None, seq + 1
        if open_file is not None:
            yield closed()

    stats = ordered.mapInArrow(work, "file string, part int, seq int, docs bigint, ids bigint")
    stats.write.parquet(f"{folder}/manifest")
    # The type of the document ids, for readers of an empty data set too.
    spark.createDataFrame([], f"doc_id {docs.schema[doc_id].dataType.simpleString()}").write.parquet(f"{folder}/schema")


def read(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files alone.

    ``start`` counts the ids of all documents before it. Files are bounded in size, so one
    file is one task's work; their totals, a few numbers a file, are added up by the driver.
    """
    kind = spark.read.parquet(f"{folder}/schema").schema["doc_id"].dataType.simpleString()
    files = sorted(spark.read.parquet(f"{folder}/manifest").collect(), key=lambda r: (r["part"], r["seq"]))
    before = accumulate((r["ids"] for r in files), initial=0)
    listed = [(n, f"{folder}/ids/{r['file']}", start) for n, (r, start) in enumerate(zip(files, before, strict=False))]
    table = spark.createDataFrame(listed, "n int, file string, before bigint")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids

    def work(batches):
        for batch in batches:
            for path, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                reader = FileReader(path)
                for first, bounds in reader.runs():
                    data = memoryview(reader.tokens(int(bounds[0]), int(bounds[-1])).tobytes())
                    cuts = ((bounds - bounds[0]) * 4).tolist()
                    own = [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    columns = [
                        reader.names.slice(first, len(own)).combine_chunks(),
                        pa.array(before + bounds[:-1]),
                        pa.array(np.diff(bounds)),
                        pa.array([zlib.crc32(ids) for ids in own], pa.int64()),
                    ]
                    columns += [pa.array([bytes(ids) for ids in own], pa.binary())] * keep_ids
                    yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    if len(listed) > 1:
        # One file a task.
        table = table.repartitionById(len(listed), "n")
    return table.mapInArrow(work, schema)
