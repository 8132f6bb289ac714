"""Near-duplicates by SimHash and the exact Jaccard similarity of word shingles.

Two documents are linked if their sets of shingles (``words`` words of the lower-cased text)
have a Jaccard similarity of ``similarity`` or more. Candidates are the documents whose
fingerprints, of the same shingles, ``simhash`` links by the general pigeonhole principle. At
0.8 fingerprints differ in about ten of 64 bits and in up to twenty, where no partition of the
bits selects anything; so min-hash bands add the candidates beyond the radius of the
fingerprints. Every link is checked on the sets.

1. Equal sets are one set, known by a hash. A band is the hash of ``ROWS`` min-hashes; as many
   bands are taken as keep the chance to miss a pair at the threshold below ``MISS``.
2. The sets that share a band's key or a fingerprint are joined to the smallest one, untested, and
   those of linked fingerprints to one another; the components of these are the candidate
   groups. Only sets of such groups are fetched, each once.
3. A group is compared in cells of bounded size. A cell has an index from shingles to sets,
   which counts what a set has in common with all others at once; a set that has joined the
   largest component needs no count of its own. Only a spanning forest of the links leaves a
   task, so that neither candidates nor links ever become rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.session import sized

from . import blocks, graph, simhash
from .spread import durable, map_runs

WORDS = 5
SIMILARITY = 0.8
ROWS = 5
MISS = 1e-6
# Sets of a group that one side of a cell holds.
CELL_SETS = 512

_LOWER = blocks.lower_ascii()


def bands(similarity: float, miss: float = MISS) -> int:
    """The number of bands; pairs above the threshold are missed more rarely still."""
    return max(1, math.ceil(math.log(miss) / math.log(1 - min(similarity, 1 - 1e-9) ** ROWS)))


def shingle_sets(column, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin.

    A text of fewer words is one shingle; a text without a word has none.
    """
    data, offsets = blocks.text_bytes(column)
    starts, ends, first = blocks.words(data, offsets, blocks.SPACE == 0)
    hashes = blocks.word_hashes(_LOWER[data], starts, ends, 6)
    sizes = np.diff(first)
    counts = np.where(sizes > 0, np.maximum(sizes - words + 1, 1), 0)
    row = np.repeat(np.arange(len(sizes)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first[row]
    out = np.zeros(len(at), np.uint64)
    for i in range(words):
        inside = at + i < first[row + 1]
        out = blocks.mix(out + np.where(inside, hashes[np.minimum(at + i, max(len(hashes) - 1, 0))], np.uint64(i + 1)))
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    fresh = blocks.first_in_group(out) | blocks.first_in_group(row)
    return out[fresh], np.searchsorted(row[fresh], np.arange(len(sizes) + 1))


def set_hashes(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash of each set; 0 of an empty one."""
    sums = np.zeros(len(sets) + 1, np.uint64)
    np.cumsum(blocks.mix(sets + np.uint64(0x9E3779B97F4A7C15)), out=sums[1:])
    return blocks.mix(sums[first[1:]] - sums[first[:-1]])


def band_keys(sets: np.ndarray, first: np.ndarray, n: int, seed: int = 17) -> np.ndarray:
    """A row of ``n`` keys for each set; all sets hold something."""
    random = np.random.default_rng(seed)
    keys = np.zeros((len(first) - 1, n), np.uint64)
    for band in range(n):
        key = np.full(len(keys), band + 1, np.uint64)
        for _ in range(ROWS):
            factor, shift = random.integers(1 << 63, size=2, dtype=np.int64).astype(np.uint64)
            own = np.minimum.reduceat(sets * (factor * np.uint64(2) + np.uint64(1)) + shift, first[:-1]) if len(keys) else key
            key = blocks.mix(key + own)
        keys[:, band] = key
    return keys


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def signatures(docs: DataFrame, words: int, n: int) -> DataFrame:
    """(k, m, h, keys, fp) of every row (k, t, m)."""
    kind = docs.schema["k"].dataType.simpleString()

    def work(batches):
        for batch in blocks.cut(batches, "t"):
            sets, first = shingle_sets(batch.column("t"), words)
            full = np.flatnonzero(np.diff(first))
            keys = band_keys(sets, np.append(first[full], len(sets)), n)
            ends = np.zeros(len(first), np.int32)
            ends[full + 1] = n
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), _signed(keys.ravel()))
            prints = pa.array(simhash.prints_of(batch.column("t"), words))
            columns = [batch.column("k"), batch.column("m"), _signed(set_hashes(sets, first)), lists, prints]
            yield pa.RecordBatch.from_arrays(columns, ["k", "m", "h", "keys", "fp"])

    return docs.mapInArrow(work, f"k {kind}, m bigint, h bigint, keys array<bigint>, fp bigint")


def _near_prints(marked: DataFrame) -> DataFrame:
    """Candidates (a, b): sets that share a fingerprint, or whose fingerprints SimHash links."""
    # A text without a word has no set to compare.
    held = durable(marked.where(F.size("keys") > 0).select("fp", "h").distinct())
    hubs = durable(held.groupBy("fp").agg(F.min("h").alias("hub")))
    same = held.join(hubs, "fp").where("h <> hub").select(F.col("h").alias("a"), F.col("hub").alias("b"))
    near = simhash.linked(hubs)
    first, second = hubs.select(F.col("fp").alias("a"), F.col("hub").alias("x")), hubs.select(F.col("fp").alias("b"), F.col("hub").alias("y"))
    return same.unionByName(near.join(first, "a").join(second, "b").select(F.col("x").alias("a"), F.col("y").alias("b")))


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(h, s, ...), the shingles of the sets that are wanted, one row each."""

    def work(batches):
        for batch in blocks.cut(batches, "t"):
            sets, first = shingle_sets(batch.column("t"), words)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), _signed(sets))
            yield pa.RecordBatch.from_arrays([_signed(set_hashes(sets, first)), lists], ["h", "s"])

    listed, _ = sized(wanted)
    found = docs.select("t").mapInArrow(work, "h bigint, s array<bigint>")
    return durable(found.join(listed, "h").groupBy("h", "g").agg(F.first("s").alias("s")))


def forest(sets: np.ndarray, first: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets that are similar enough; every set holds something."""
    size = np.diff(first)
    n = len(size)
    owner = np.repeat(np.arange(n), size)
    _, code, count = np.unique(sets, return_inverse=True, return_counts=True)
    holders = owner[np.argsort(code, kind="stable")]
    begin = np.cumsum(count) - count
    # The set whose shingles most others have is likely the heart of the group.
    order = np.argsort(-np.add.reduceat(count[code], first[:-1]), kind="stable").tolist()
    component = np.arange(n)
    edges = []
    for pivot in order:
        if pivot != order[0] and component[pivot] == component[order[0]]:
            # Whoever is outside the heart's component asks, or has asked, about this set.
            continue
        mine = code[first[pivot] : first[pivot + 1]]
        length = count[mine]
        ends = np.cumsum(length)
        listed = np.arange(ends[-1]) + np.repeat(begin[mine] - ends + length, length)
        common = np.bincount(holders[listed], minlength=n)
        linked = np.flatnonzero(common >= similarity * (size + size[pivot] - common) - 1e-9)
        for other in linked[np.unique(component[linked], return_index=True)[1]].tolist():
            if component[other] != component[pivot]:
                edges.append((pivot, other))
                component[component == component[other]] = component[pivot]
    return edges


def _links(groups: DataFrame, similarity: float) -> DataFrame:
    """(a, b): forests of the links within the groups of (g, h, s)."""
    keys = ["g", "p", "q"]
    rows = graph.dealt_in_cells(groups, groups.select("g", "h"), ["g"], "h", CELL_SETS)

    def compare(run: pa.Table) -> pa.Table:
        run = run.combine_chunks()
        marks = [run.column(k).to_numpy() for k in keys]
        change = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
        lists, names = run.column("s").chunk(0), run.column("h").to_numpy()
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        found = []
        for a, b in zip([0, *change.tolist()], [*change.tolist(), run.num_rows], strict=True):
            if b - a > 1:
                found += [(names[a + x], names[a + y]) for x, y in forest(values[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], similarity)]
        return pa.table({k: pa.array([pair[i] for pair in found], pa.int64()) for i, k in enumerate("ab")})

    return map_runs(rows, keys, compare, "a bigint, b bigint")


def _classes(rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """(k, m, c) of every row (k, t, m); c is the same for the rows that links join."""
    marked = durable(signatures(rows, words, bands(similarity)))
    distinct = marked.groupBy("h").agg(F.min("k").alias("least"), F.first("keys").alias("keys"))
    spread = durable(distinct.select(F.explode("keys").alias("key"), "h"))
    hubs = spread.groupBy("key").agg(F.min("h").alias("hub"), F.max("h").alias("last")).where("hub <> last").select("key", "hub")
    stars = spread.join(hubs, "key").where("h <> hub").select(F.col("h").alias("a"), F.col("hub").alias("b")).unionByName(_near_prints(marked)).distinct()
    wanted = durable(graph.components(stars).select(F.col("node").alias("h"), F.col("component").alias("g")))
    reached, _ = sized(graph.components(_links(_sets_of(rows, wanted, words), similarity)))
    return marked.join(reached, F.col("h") == F.col("node"), "left").select("k", "m", F.coalesce("component", "h").alias("c"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, component_id) of every row.

    ``component_id`` is the smallest id reachable by links. Empty and null texts are equal
    and link with one another. Repeated ids are rows of their own; a null id takes part in
    links and has a null component only if all ids that it reaches are null.
    """
    named = _classes(docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"), F.lit(0).cast("bigint").alias("m")), words, similarity)
    lowest = named.groupBy("c").agg(F.min("k").alias("component_id"), F.count(F.lit(1)).alias("n"))
    several, _ = sized(lowest.where("n > 1").select(F.col("c").alias("group"), "component_id"))
    both = named.join(several, F.col("c") == F.col("group"), "left")
    return both.select(F.col("k").alias(doc_id), F.when(F.col("group").isNull(), F.col("k")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, of all that links join just one.

    That is the row of the smallest id, null ids last, and of rows with one id that with the
    smallest hash of all its columns. Rows are known by their id and this hash, as ids may
    repeat and rows have no number that each scan gives them again; of equal rows one stays.
    """
    mark = F.xxhash64(*[docs[c] for c in docs.columns])
    named = _classes(docs.select(docs[doc_id].alias("k"), docs[text].alias("t"), mark.alias("m")), words, similarity)
    order = F.struct(F.col("k").isNull().alias("unnamed"), "k", "m")
    lowest = named.groupBy("c").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    several, _ = sized(lowest.where("n > 1").select(F.col("c").alias("group"), F.col("first.k").alias("first_k"), F.col("first.m").alias("first_m")))
    members = named.join(several, F.col("c") == F.col("group"))
    is_first = F.col("k").eqNullSafe(F.col("first_k")) & (F.col("m") == F.col("first_m"))
    gone = members.where(~is_first).select("k", "m")
    again, n = sized(members.where(is_first).groupBy("k", "m").count().where("count > 1").select("k", "m"))

    def same(rows: DataFrame):
        return docs[doc_id].eqNullSafe(rows["k"]) & (mark == rows["m"])

    if n == 0:
        return docs.join(gone, same(gone), "left_anti")
    gone = gone.unionByName(again)
    one = docs.join(again, same(again), "left_semi").withColumn("_mark", mark).dropDuplicates([doc_id, "_mark"]).drop("_mark")
    return docs.join(gone, same(gone), "left_anti").unionByName(one)
