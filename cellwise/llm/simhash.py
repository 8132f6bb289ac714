"""SimHash near-duplicates by the general pigeonhole principle.

Distinct fingerprints are compared, not documents. The 64 bits are ordered so that correlated
ones are neighbours and cut into partitions. Thresholds t_i with sum r - m + 1 for m
partitions and radius r (t_i = -1 leaves a partition out) suffice: two fingerprints within r
bits are within t_i bits in some partition i. The number of partitions and the thresholds are
those of least estimated cost, probes plus candidates, found by dynamic programming; they
change the speed and never the result.

Each fingerprint is indexed by its value in every partition and probes the values within t_i
bits of it. What meets is compared whole in numpy, and a task returns the spanning forest of
the links it finds, not the pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks, graph
from .spread import durable, map_runs

BITS = 64
WORDS = 4
RADIUS = 4
SEED = 42
SAMPLE = 2048


def fingerprint(text: bytes, size: int = WORDS) -> list[int]:
    """Hashes of the shingles of ``size`` words of a lower-cased text."""
    words = text.split()
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)] if words else []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)]


def prints_of(column, size: int = WORDS) -> np.ndarray:
    """The fingerprint of each text of a block, as a signed 64-bit number."""
    data, offsets = blocks.text_bytes(column)
    raw = data.tobytes().lower()
    hashes = [fingerprint(raw[a:b], size) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
    flat = np.fromiter((h for own in hashes for h in own), np.uint64, counts.sum())
    found = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(flat.view(np.uint8), bitorder="little").reshape(-1, BITS)
        sums = np.add.reduceat(bits, np.concatenate([[0], np.cumsum(counts[full])[:-1]]), axis=0, dtype=np.int64)
        found[full] = np.packbits(sums * 2 > counts[full, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return found.view(np.int64)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row, fp the fingerprint's 64 bits as a signed long."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches):
        for batch in blocks.cut(batches, "t", 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(prints_of(batch.column("t")))], ["k", "fp"])

    rows = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(work, f"k {kind}, fp bigint").withColumnRenamed("k", doc_id)


def correlations(prints: DataFrame) -> np.ndarray:
    """The 64 x 64 table of how far bits agree beyond chance, over all fingerprints."""

    def work(batches):
        both, ones, n = np.zeros((BITS, BITS)), np.zeros(BITS), 0
        for batch in batches:
            bits = _bits(batch.column("fp").to_numpy().view(np.uint64)).astype(np.float32)
            both += bits.T @ bits
            ones += bits.sum(0)
            n += len(bits)
        flat = np.concatenate([both.ravel(), ones, [n]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["i", "x"])

    rows = prints.mapInArrow(work, "i bigint, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    flat = np.zeros(BITS * BITS + BITS + 1)
    flat[rows.column("i").to_numpy()] = rows.column("x").to_numpy()
    n = max(flat[-1], 1)
    ones = flat[-BITS - 1 : -1] / n
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-9))
    return np.abs(flat[: BITS * BITS].reshape(BITS, BITS) / n - np.outer(ones, ones)) / np.outer(spread, spread)


def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def chained(correlation: np.ndarray) -> list[int]:
    """The bits in an order in which each follows the one that it is most correlated with."""
    left = set(range(BITS))
    at = int(correlation.sum(0).argmax())
    order = [at]
    left.discard(at)
    while left:
        at = max(left, key=lambda b: (correlation[order[-1], b], -b))
        order.append(at)
        left.discard(at)
    return order


def plan(order: list[int], sample: np.ndarray, n: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Partitions (bits, threshold) of the least estimated number of probes and candidates."""
    bits = _bits(sample).astype(np.float32)
    pairs = max(len(sample) * (len(sample) - 1) / 2, 1)
    best, chosen = np.inf, []
    for m in range(1, radius + 2):
        parts = [list(p) for p in np.array_split(np.array(order), m)]
        cost = np.zeros((m, radius + 2))
        for i, part in enumerate(parts):
            own = bits[:, part]
            apart = own.sum(1)[:, None] + own.sum(1)[None] - 2 * own @ own.T
            close = np.bincount(apart[np.triu_indices(len(sample), 1)].astype(int), minlength=radius + 1).cumsum()
            for t in range(radius + 1):
                # Independent even bits are assumed where the sample has no such pair.
                balls = sum(_choose(len(part), d) for d in range(t + 1))
                share = max(close[t] / pairs, balls / 2.0 ** len(part))
                cost[i, t + 1] = n * balls * 4.0 + share * n * n / 2
        # least[s]: the smallest cost of the partitions so far whose (t + 1) add up to s.
        total = radius + 1
        least = np.full(total + 1, np.inf)
        least[0], taken = 0.0, []
        for i in range(m):
            options = np.array([[least[s - t] + cost[i, t] if t <= s else np.inf for t in range(radius + 2)] for s in range(total + 1)])
            taken.append(options.argmin(1))
            least = options.min(1)
        if least[total] < best:
            best, s, thresholds = least[total], total, []
            for i in reversed(range(m)):
                thresholds.append(int(taken[i][s]) - 1)
                s -= taken[i][s]
            chosen = list(zip(parts, reversed(thresholds), strict=True))
    return [(part, t) for part, t in chosen if t >= 0]


def _choose(n: int, k: int) -> int:
    return 0 if k > n else int(np.prod([(n - i) / (i + 1) for i in range(k)]).round())


def entries(prints: np.ndarray, partitions: list[tuple[list[int], int]]):
    """(partition, value, fingerprint, indexed) of all index entries and probes.

    Of two values d bits apart, the one with a zero at the lowest differing bit probes the other.
    """
    bits = _bits(prints).astype(np.int64)
    for i, (part, threshold) in enumerate(partitions):
        own = bits[:, part]
        value = own @ (np.int64(1) << np.arange(len(part), dtype=np.int64))
        yield i, value, prints, 1
        for d in range(1, threshold + 1):
            for flips in combinations(range(len(part)), d):
                low = own[:, flips[0]] == 0
                yield i, value[low] ^ sum(1 << f for f in flips), prints[low], 0


def links(prints: DataFrame, partitions: list[tuple[list[int], int]], radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that join the same fingerprints as all pairs within ``radius`` bits do."""

    def emit(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                own = batch.slice(at, 4096).column("fp").to_numpy().view(np.uint64)
                for i, value, fp, indexed in entries(own, partitions):
                    columns = [np.full(len(fp), i, np.int32), value, fp.view(np.int64), np.full(len(fp), indexed, np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "value", "fp", "indexed"])

    rows = prints.mapInArrow(emit, "part int, value bigint, fp bigint, indexed int")
    cells = graph.dealt_in_cells(rows, rows, ["part", "value"], "fp")

    def compare(run: pa.Table) -> pa.Table:
        run = run.sort_by([(k, "ascending") for k in ("part", "value", "p", "q")])
        keys = np.stack([run.column(k).to_numpy().astype(np.int64) for k in ("part", "value", "p", "q")], 1)
        fp = run.column("fp").to_numpy()
        indexed, side = run.column("indexed").to_numpy() == 1, run.column("side").to_numpy()
        cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        found = [[], []]
        for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fp)]]), strict=True):
            if b - a < 2 or not indexed[a:b].any():
                continue
            across = keys[a, 2] != keys[a, 3]
            left, right = _close(fp[a:b].view(np.uint64), indexed[a:b], side[a:b] if across else None, radius)
            if len(left):
                root = graph.roots(b - a, left, right)
                leaf = np.flatnonzero(root != np.arange(b - a))
                found[0].append(fp[a:b][leaf])
                found[1].append(fp[a:b][root[leaf]])
        empty = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([empty, *found[0]]), "b": np.concatenate([empty, *found[1]])})

    return map_runs(cells, ["part", "value", "p", "q"], compare, "a bigint, b bigint")


def _close(fp: np.ndarray, indexed: np.ndarray, side: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the radius of an index entry and any other row, of different sides if given."""
    index = np.flatnonzero(indexed)
    found = [[], []]
    for at in range(0, len(index), 256):
        own = index[at : at + 256]
        near = np.bitwise_count(fp[own][:, None] ^ fp[None]) <= radius
        if side is not None:
            near &= side[own][:, None] != side[None]
        left, right = np.nonzero(near)
        keep = own[left] != right
        found[0].append(own[left][keep])
        found[1].append(right[keep])
    return (np.concatenate(found[0]), np.concatenate(found[1])) if found[0] else (np.zeros(0, int), np.zeros(0, int))


def linked(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that join the distinct fingerprints (fp) as all pairs within ``radius`` bits do, by the cheapest partitions."""
    n = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fp", F.lit(5))).limit(SAMPLE).select("fp").toArrow().column("fp").to_numpy()
    partitions = plan(chained(correlations(distinct.select("fp"))), sample.view(np.uint64), n, radius) if n > 1 else []
    return links(distinct.select("fp"), partitions, radius)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row.

    ``component_id`` is the smallest id reachable by links. Empty and null texts have the
    fingerprint zero and link like others. Repeated ids are rows of their own; a null id takes
    part in links and has a null component only if all ids that it reaches are null.
    """
    marked = durable(fingerprints(docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t")), "k", "t"))
    distinct = durable(marked.groupBy("fp").agg(F.min("k").alias("least")))
    reached = graph.components(linked(distinct, radius))
    grouped = distinct.join(reached, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("c"))
    smallest = grouped.groupBy("c").agg(F.min("least").alias("component_id"))
    named = grouped.join(smallest, "c").select("fp", "component_id")
    return marked.join(named, "fp").select(F.col("k").alias(doc_id), "fp", "component_id")
