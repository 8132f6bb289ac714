"""How the sources of a language differ in their words: a quadtree over groups and terms.

Terms of a document are its runs of letters. Each language keeps the terms of at least
``MIN_DOCS`` of its documents; its (language, source) groups are the rows and its kept terms
the columns of a count matrix. The probability of a term in a group is smoothed, so two groups
differ in every column; where neither has the term the difference is that of two constants.

The matrix is cut into panels of columns (terms of like frequency) and tiles of rows. A
:class:`Quadtree` of each tile and panel holds bits for the quadrants that are not all zero,
level by level, and small blocks of counts for its leaves. Two trees are descended together:
a quadrant that is empty in both is priced by its width times the difference of the constants,
only leaves with a count in either are compared. Tasks add up panels before they send a pair.

All arithmetic is of whole numbers. Null text, language or source is the empty text. Only the
language, source and text columns are read; repeated rows count as often as they stand.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellwise.session import sized

from . import blocks
from .spread import durable, sorted_runs

MIN_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50

# Distinct (group, term) pairs that a task counts before it sends them on.
COUNTED = 200_000
# About so many terms make a panel, so many groups a tile; a leaf is a block of LEAF x LEAF.
PANEL = 512
TILE = 512
LEAF = 8
# Pairs of leaves compared at a time.
LEAF_PAIRS = 4096

# Bytes of terms: letters and what is beyond ASCII; capitals become small, others white space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs) in parts: occurrences and documents, to be added up."""

    def work(batches):
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def sent():
            for (own_lang, own_source), (n, with_term) in counts.items():
                if n:
                    size = len(n)
                    columns = [
                        pa.array([own_lang] * size, pa.string()),
                        pa.array([own_source] * size, pa.string()),
                        pa.array(list(n), pa.binary()).cast(pa.string()),
                        pa.array(n.values(), pa.int64()),
                        pa.array([with_term[t] for t in n], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            counts.clear()

        for batch in blocks.cut(batches, "text"):
            data, offsets = blocks.text_bytes(batch.column("text"))
            raw = data.tobytes()
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for group, a, b in zip(groups, offsets[:-1], offsets[1:], strict=True):
                n, with_term = counts.setdefault(group, (Counter(), Counter()))
                words = raw[a:b].translate(_FOLD).split()
                n.update(words)
                with_term.update(set(words))
            if sum(len(n) for n, _ in counts.values()) > COUNTED:
                yield from sent()
        yield from sent()

    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    return read.mapInArrow(work, "lang string, source string, term string, n bigint, docs bigint")


def kept_cells(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, total, first) of the terms that enough documents of a language have.

    ``total`` counts the term in all sources; ``first`` marks one row of each term. Tasks have
    summed up their terms before the one shuffle, so a common term is no hot key.
    """
    parts = term_counts(docs, lang, source, text).repartition("lang", "term")
    summed = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    totals = summed.select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("total"), F.sum("docs").over(term).alias("in_docs"), F.row_number().over(term.orderBy("source")).alias("at")
    )
    return totals.where(F.col("in_docs") >= min_docs).select("lang", "source", "term", "n", "total", (F.col("at") == 1).alias("first"))


def scaled(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTHING) / total), exactly, by long division.

    ``total`` may be up to 9e15: remainders times a thousand stay below 2^63.
    """
    quotient, rest = np.divmod(count + SMOOTHING, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        quotient = quotient * 1000 + digits
    return quotient + 1


def _spread_bits(x: np.ndarray) -> np.ndarray:
    """Every bit moved to twice its place."""
    out = np.zeros_like(x)
    for bit in range(31):
        out |= (x >> bit & 1) << 2 * bit
    return out


class Quadtree:
    """A k-squared tree (k = 2) over a sparse count matrix with ``side`` a power of two.

    ``bits[l]`` has four bits for each quadrant of level l that is not all zero: which of its
    own quadrants are not. The set bits of a level, in order, are the quadrants of the next;
    ``children[l]`` counts those before each bit. Below the last level stand blocks of counts.
    """

    def __init__(self, row: np.ndarray, col: np.ndarray, count: np.ndarray, levels: int):
        code = _spread_bits(row // LEAF) * 2 + _spread_bits(col // LEAF)
        nodes, leaf = np.unique(code, return_inverse=True)
        self.levels = levels
        self.blocks = np.zeros((len(nodes), LEAF, LEAF), np.int64)
        self.blocks[leaf, row % LEAF, col % LEAF] = count
        self.bits: list[np.ndarray] = []
        self.rows = np.zeros(len(nodes), np.int64)
        if len(nodes):
            self.rows[leaf] = row // LEAF
        for _ in range(levels):
            parents, own = np.unique(nodes >> 2, return_inverse=True)
            bits = np.zeros((len(parents), 4), bool)
            bits[own, nodes & 3] = True
            self.bits.insert(0, bits)
            nodes = parents
        self.children = [np.cumsum(b.ravel()).reshape(b.shape) - 1 for b in self.bits]
        self.empty = len(nodes) == 0

    def child(self, level: int, node: np.ndarray, quadrant: int) -> np.ndarray:
        """The next level's number of one quadrant of each node; -1 is all zero."""
        if self.empty:
            return np.full(len(node), -1)
        at = np.maximum(node, 0)
        there = (node >= 0) & self.bits[level][at, quadrant]
        return np.where(there, self.children[level][at, quadrant], -1)


def levels_for(rows: int, cols: int) -> int:
    return max(0, (-(-max(rows, cols, 1) // LEAF) - 1).bit_length())


def distances(a: Quadtree, b: Quadtree, total_a: np.ndarray, total_b: np.ndarray, cols: int, same: bool) -> np.ndarray:
    """The sums over ``cols`` columns of |p - q| for all rows of ``a`` against all of ``b``.

    ``total_a`` and ``total_b`` divide the counts of each row. With ``same`` both are one
    matrix and only pairs with the first row above the second need be right.
    """
    size_a, size_b = -(-len(total_a) // LEAF), -(-len(total_b) // LEAF)
    pad_a, pad_b = np.ones(size_a * LEAF, np.int64), np.ones(size_b * LEAF, np.int64)
    pad_a[: len(total_a)], pad_b[: len(total_b)] = total_a, total_b
    pad_a, pad_b = pad_a.reshape(-1, LEAF), pad_b.reshape(-1, LEAF)
    base_a, base_b = scaled(np.zeros_like(pad_a), pad_a), scaled(np.zeros_like(pad_b), pad_b)
    # Columns that are empty on both sides, for each pair of blocks of rows.
    uniform = np.zeros((size_a, size_b), np.int64)
    out = np.zeros((size_a, size_b, LEAF, LEAF), np.int64)
    root = -1 if a.empty else 0, -1 if b.empty else 0
    node_a, node_b = np.array(root[:1]), np.array(root[1:])
    row_a = row_b = col = np.zeros(1, np.int64)
    for level in range(a.levels):
        found = []
        span = 1 << (a.levels - level - 1)
        for down_a in (0, 1):
            for down_b in (0, 1):
                for right in (0, 1):
                    r, s, c = row_a * 2 + down_a, row_b * 2 + down_b, col * 2 + right
                    inside = (r * span < size_a) & (s * span < size_b) & (c * span * LEAF < cols)
                    if same:
                        inside &= r <= s
                    x = a.child(level, node_a[inside], 2 * down_a + right)
                    y = b.child(level, node_b[inside], 2 * down_b + right)
                    found.append((x, y, r[inside], s[inside], c[inside]))
        node_a, node_b, row_a, row_b, col = (np.concatenate(part) for part in zip(*found, strict=True))
        zero = (node_a < 0) & (node_b < 0)
        width = np.minimum((col[zero] + 1) * span * LEAF, cols) - col[zero] * span * LEAF
        priced = np.zeros((-(-size_a // span), -(-size_b // span)), np.int64)
        np.add.at(priced, (row_a[zero], row_b[zero]), width)
        uniform += np.repeat(np.repeat(priced, span, 0), span, 1)[:size_a, :size_b]
        node_a, node_b, row_a, row_b, col = (part[~zero] for part in (node_a, node_b, row_a, row_b, col))
    if a.levels == 0 and a.empty and b.empty:
        uniform += cols
        node_a = node_a[:0]
    prices_a, prices_b = scaled(a.blocks, pad_a[a.rows][:, :, None]), scaled(b.blocks, pad_b[b.rows][:, :, None])
    for at in range(0, len(node_a), LEAF_PAIRS):
        x, y, r, s, c = (part[at : at + LEAF_PAIRS] for part in (node_a, node_b, row_a, row_b, col))
        p, q = _prices(x, prices_a, base_a[r]), _prices(y, prices_b, base_b[s])
        # Places beyond the last column are in no block.
        past = (c * LEAF)[:, None] + np.arange(LEAF) >= cols
        gaps = np.abs(p[:, :, None, :] - q[:, None, :, :])
        gaps *= ~past[:, None, None, :]
        np.add.at(out, (r, s), gaps.sum(-1))
    out += uniform[:, :, None, None] * np.abs(base_a[:, None, :, None] - base_b[None, :, None, :])
    return out.swapaxes(1, 2).reshape(size_a * LEAF, size_b * LEAF)[: len(total_a), : len(total_b)]


def _prices(node: np.ndarray, prices: np.ndarray, base: np.ndarray) -> np.ndarray:
    flat = np.repeat(base[:, :, None], LEAF, 2)
    full = node >= 0
    flat[full] = prices[node[full]]
    return flat


# What tasks send on: sums of a pair of groups over the columns seen, or a term of a group.
_SENT = "lang string, a int, b int, value bigint, cols bigint, term string"
_NAMES = ["lang", "a", "b", "value", "cols", "term"]
_TYPES = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string())


def _batch(columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def _pairs(tile: tuple[str, int, int], rows: int, sums: np.ndarray, seen: int) -> pa.RecordBatch:
    lang, tile_a, tile_b = tile
    i, j = np.nonzero(np.triu(np.ones(sums.shape, bool), 1) if tile_a == tile_b else np.ones(sums.shape, bool))
    return _batch(([lang] * len(i), i + tile_a * rows, j + tile_b * rows, sums[i, j], np.full(len(i), seen), [None] * len(i)))


def _tile_sums(batches, rows: int):
    """Descends the trees of each (lang, tile, tile, panel); sums of a pair are sent once a task.

    Cells of a panel come with one row that holds the totals of all groups of both tiles, up to
    ``rows`` each.
    """
    keys = ["lang", "tile_a", "tile_b", "panel"]
    tile, sums, seen = None, None, 0
    for run in sorted_runs(batches, keys):
        changes = np.any([c[1:] != c[:-1] for c in (run.column(k).to_numpy() for k in keys)], axis=0)
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), run.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            part = run.slice(start, stop - start)
            lang, tile_a, tile_b = (part.column(n)[0].as_py() for n in keys[:3])
            if tile != (lang, tile_a, tile_b):
                if tile is not None:
                    yield _pairs(tile, rows, sums, seen)
                tile, sums, seen = (lang, tile_a, tile_b), 0, 0
            side = part.column("side").to_numpy()
            head = int(np.flatnonzero(side < 0)[0])
            totals = [np.array(part.column(n)[head].as_py(), np.int64) for n in ("totals_a", "totals_b")]
            of_lang = part.column("of_lang")[head].as_py()
            cells = part.take(np.flatnonzero(side >= 0))
            side, row, count, total = (cells.column(n).to_numpy() for n in ("side", "row", "n", "total"))
            terms, by_name = np.unique(np.array(cells.column("term").cast(pa.binary()).to_pylist(), object), return_inverse=True)
            # Frequent terms stand together, so that rare ones leave whole quadrants empty.
            most = np.zeros(len(terms), np.int64)
            most[by_name] = total
            col = np.empty(len(terms), np.int64)
            col[np.argsort(-most, kind="stable")] = np.arange(len(terms))
            levels = levels_for(max(map(len, totals)), len(terms))
            a, b = (Quadtree(row[own], col[by_name[own]], count[own], levels) for own in (side != 1, side != 0))
            sums = sums + distances(a, b, totals[0], totals[1], len(terms), tile_a == tile_b)
            seen += len(terms)
            if tile_a == tile_b:
                gain = scaled(count, totals[0][row]) - scaled(total, np.int64(of_lang))
                yield _top_terms(lang, tile_a * rows + row, gain, terms, by_name)
    if tile is not None:
        yield _pairs(tile, rows, sums, seen)


def _top_terms(lang: str, row: np.ndarray, gain: np.ndarray, terms: np.ndarray, by_name: np.ndarray) -> pa.RecordBatch:
    """Of each group the terms of this panel that may be among its first."""
    at = np.flatnonzero(gain > 0)
    at = at[np.lexsort((by_name[at], -gain[at], row[at]))]
    starts = np.flatnonzero(blocks.first_in_group(row[at])) if len(at) else np.zeros(0, np.int64)
    rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    at = at[rank < TOP_TERMS]
    return _batch(([lang] * len(at), row[at], [None] * len(at), gain[at], [None] * len(at), [terms[c].decode() for c in by_name[at]]))


def _groups(docs: DataFrame, cells: DataFrame, lang: str, source: str) -> DataFrame:
    """(lang, source, row, total, of_lang, v) of every group that occurs, with or without kept terms.

    ``row`` numbers the groups of a language, the fullest first; ``total`` and ``of_lang``
    divide the counts of the group and of its language, which keeps ``v`` terms.
    """
    empty = F.lit("")
    every = docs.select(F.coalesce(F.col(lang).cast("string"), empty).alias("lang"), F.coalesce(F.col(source).cast("string"), empty).alias("source")).distinct()
    counted = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    kept = cells.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("m"))
    joined = every.join(counted, ["lang", "source"], "left").join(kept, "lang", "left").fillna(0, ["n", "v", "m"])
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "source")
    return joined.select(
        "lang", "source", (F.row_number().over(order) - 1).alias("row"), (F.col("n") + SMOOTHING * F.col("v")).alias("total"), (F.col("m") + SMOOTHING * F.col("v")).alias("of_lang"), "v"
    )


def _tiled(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Cells dealt to pairs of tiles and panels, and one row with the totals for each of these."""
    level = F.floor(F.log2("total")).cast("int")
    levelled = cells.withColumn("level", level)
    sizes, _ = sized(levelled.where("first").groupBy("lang", "level").agg(F.ceil(F.count(F.lit(1)) / F.lit(PANEL)).alias("panels")))
    tiles = groups.groupBy("lang", "of_lang", F.expr(f"row div {TILE}").cast("int").alias("tile")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("row", "total"))), lambda x: x["total"]).alias("totals")
    )
    tiles_of = groups.groupBy("lang").agg(F.expr(f"cast(max(row) div {TILE} as int)").alias("last"))
    a, b = tiles.select("lang", "of_lang", F.col("tile").alias("tile_a"), F.col("totals").alias("totals_a")), tiles.select("lang", F.col("tile").alias("tile_b"), F.col("totals").alias("totals_b"))
    panels = sizes.select("lang", "level", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("panels") - 1)).alias("at"))
    number = F.col("level").cast("bigint") * F.lit(1 << 40) + F.col("at")
    heads = a.join(b, "lang").where("tile_a <= tile_b").join(panels, "lang").select("lang", "tile_a", "tile_b", number.alias("panel"), F.lit(-1).alias("side"), "totals_a", "totals_b", "of_lang")
    placed = levelled.join(sizes, ["lang", "level"]).withColumn("at", F.pmod(F.xxhash64("term"), F.col("panels")))
    known, _ = sized(groups.join(tiles_of, "lang").select("lang", "source", "row", "last"))
    placed = placed.join(known, ["lang", "source"]).select(
        "lang", number.alias("panel"), "term", "n", "total", F.expr(f"row % {TILE}").cast("int").alias("row"), F.expr(f"row div {TILE}").cast("int").alias("tile"), F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    )
    side = F.when(F.col("tile") == F.col("other"), 2).when(F.col("tile") < F.col("other"), 0).otherwise(1)
    dealt = placed.select("lang", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), "panel", side.alias("side"), "row", "term", "n", "total")
    return dealt.unionByName(heads, allowMissingColumns=True)


def divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from the others.

    Part ``pair`` holds every other source of the language with the sum of the differences of
    all kept terms; part ``term`` the TOP_TERMS terms in which the source lies furthest above
    its language. A group without text has pairs but no terms; so has every group of a language
    that keeps no term, with value 0. An empty table gives no rows.
    """
    cells = durable(kept_cells(docs, lang, source, text, min_docs))
    groups = durable(_groups(docs, cells, lang, source))
    keys = ["lang", "tile_a", "tile_b", "panel"]
    sent = durable(_tiled(cells, groups).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(partial(_tile_sums, rows=TILE), _SENT))
    sums = sent.where("b is not null").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("cols").alias("cols"))
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value", "cols"))
    base = F.expr(f"case when v > 0 then {SCALE * SMOOTHING} div total end")
    mine = groups.select("lang", "source", F.col("row").alias("a"), "v", base.alias("base_a"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("row").alias("b"), base.alias("base_b"))
    # The rows asked for are all pairs of a language's sources; columns no tile has seen are empty in both.
    pairs = mine.join(others, "lang").where("a != b").join(both, ["lang", "a", "b"], "left")
    value = F.coalesce("value", F.lit(0)) + F.coalesce((F.col("v") - F.coalesce("cols", F.lit(0))) * F.abs(F.col("base_a") - F.col("base_b")), F.lit(0))
    found = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("bigint").alias("value"))
    terms = sent.where("b is null").join(groups.select("lang", "source", F.col("row").alias("a")), ["lang", "a"])
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= TOP_TERMS))
