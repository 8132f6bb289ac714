"""Links found in groups, and connected components of the links of all groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.session import durable, sized

CELL_ROWS = 4096


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of n items joined by the pairs (a, b), the smallest item that each one reaches."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def dealt_in_cells(rows: DataFrame, counted: DataFrame, keys: list[str], item: str, limit: int = CELL_ROWS) -> DataFrame:
    """``rows`` with columns (p, q, side), such that any two rows of a group meet in one cell.

    A group is what shares ``keys``; ``counted`` has the same groups (and maybe fewer columns).
    Groups of up to ``limit`` rows are one cell, (0, 0). A larger one is cut by a hash of
    ``item`` into blocks; each row goes to the cells of its block with all blocks, p <= q, and
    ``side`` tells which of the two it belongs to. So no cell holds much more than twice
    ``limit`` rows, and nothing is left out.
    """
    heavy, _ = sized(counted.groupBy(*keys).count().where(F.col("count") > limit).select(*keys, F.ceil(F.col("count") / limit).cast("int").alias("blocks")))
    joined = rows.join(heavy, keys, "left")
    own = F.pmod(F.xxhash64(F.col(item), F.lit(31)), F.coalesce("blocks", F.lit(1))).cast("int")
    joined = joined.withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    wide = joined.select(*rows.columns, "own", other.alias("other"))
    return wide.select(*rows.columns, F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).cast("int").alias("side"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) can reach.

    Alternates large-star and small-star steps until nothing changes, a number of rounds that
    grows with the logarithm of the number of nodes. Every round is one table of at most as
    many edges in reliable storage; a node with very many edges is split by the skew join, and
    its minimum is pre-aggregated.
    """
    now = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while (state := now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()) != before:
        before = state
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = now.join(least, F.col("v") == F.col("w")).select("u", F.col("m").alias("v")).distinct()
        low = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("w"))
        pairs = F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")), F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("e")
        now = durable(small.select(pairs).select(F.col("e.x").alias("u"), F.col("e.y").alias("v")).where("u <> v").distinct())
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(centres)
