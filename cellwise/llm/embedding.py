"""Embedding near-duplicates: sign hashes of random hyperplanes, cosine check, components.

Equal vectors are one vector with a multiplicity. Each is hashed by the signs of its products
with random hyperplanes, in several tables of several bits; vectors of one label that share a
table's code meet in one cell, where their cosines are computed in double precision by blocks
of a matrix product. A pair that meets in more than one table counts in the first one. Tasks
return link counts and the spanning forest of the links, not the pairs.

Bits grow with the logarithm of the largest label so that cells keep their size, and tables
are as many as keep the chance to miss a pair at the threshold below ``MISS``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph
from .spread import durable, map_runs

THRESHOLD = 0.93
MISS = 1e-6
CELL = 64


def shape(n: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for n vectors of one label."""
    bits = min(max(math.ceil(math.log2(max(n, 1) / CELL + 1)), 2), 30)
    agree = (1 - math.acos(min(threshold, 1 - 1e-9)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - agree)))


def codes(x: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """A row of ``tables`` codes of ``bits`` signs for each vector."""
    planes = np.random.default_rng((seed, x.shape[1])).standard_normal((x.shape[1], bits * tables))
    signs = (x @ planes >= 0).reshape(len(x), tables, bits)
    return (signs @ (1 << np.arange(bits))).astype(np.int32)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)


def _emitter(bits: int, tables: int, seed: int, with_vectors: bool):
    """Rows for every vector and table; vectors of one length at a time."""

    def emit(batches):
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                whole = batch.take(pa.array(np.flatnonzero(sizes == size)))
                for at in range(0, whole.num_rows, 1024):
                    part = whole.slice(at, 1024)
                    own = codes(_matrix(part.column("v")), bits, tables, seed)
                    for t in range(tables):
                        columns = {"label": part.column("label"), "size": part.column("size"), "t": pa.array(np.full(len(own), t, np.int32)), "code": pa.array(own[:, t])}
                        columns["id"] = part.column("id")
                        if with_vectors:
                            columns |= {"m": part.column("m"), "v": part.column("v"), "all": pa.FixedSizeListArray.from_arrays(pa.array(own.ravel()), tables).cast(pa.list_(pa.int32()))}
                        yield pa.RecordBatch.from_pydict(columns)

    return emit


def links(vectors: DataFrame, threshold: float, bits: int, tables: int, seed: int = 11) -> DataFrame:
    """(a, b, n): a vector, one of its neighbours (or null), and n rows linked to it in a cell.

    ``vectors`` has distinct (label, size, v) with an id and a multiplicity m.
    """
    keys = ["label", "size", "t", "code"]
    schema = "label {0}, size int, t int, code int, id {1}".format(vectors.schema["label"].dataType.simpleString(), vectors.schema["id"].dataType.simpleString())
    element = vectors.schema["v"].dataType.simpleString()
    counted = vectors.mapInArrow(_emitter(bits, tables, seed, False), schema)
    rows = vectors.mapInArrow(_emitter(bits, tables, seed, True), f"{schema}, m bigint, v {element}, all array<int>")
    cells = graph.dealt_in_cells(rows, counted, keys, "id")
    keys = [*keys, "p", "q"]

    def compare(run: pa.Table) -> pa.Table:
        run = run.combine_chunks()
        marks = [run.column(k).to_numpy() for k in keys]
        change = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1 if run.num_rows > 1 else np.zeros(0, int)
        out = {"a": [], "b": [], "n": []}
        for a, b in zip(np.concatenate([[0], change]), np.concatenate([change, [run.num_rows]]), strict=True):
            if b - a < 2:
                continue
            part = run.slice(a, b - a)
            x, own = _matrix(part.column("v")), _matrix(part.column("all")).astype(np.int32)
            x /= np.sqrt((x * x).sum(1, keepdims=True))
            side = part.column("side").to_numpy() if marks[4][a] != marks[5][a] else None
            left, right = _close(x, own, int(marks[2][a]), side, threshold)
            if len(left) == 0:
                continue
            ids, m = part.column("id").to_numpy(), part.column("m").to_numpy()
            n = np.bincount(left, m[right], b - a) + np.bincount(right, m[left], b - a)
            root = graph.roots(b - a, left, right)
            linked = np.flatnonzero(n)
            out["a"].append(ids[linked])
            out["b"].append(ids[root[linked]])
            out["n"].append(n[linked].astype(np.int64))
        return pa.table({k: np.concatenate([np.zeros(0, np.int64), *v]) for k, v in out.items()})

    return map_runs(cells, keys, compare, "a bigint, b bigint, n bigint")


def _close(x: np.ndarray, own: np.ndarray, table: int, side: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j at the threshold or above whose first common code is that of ``table``."""
    found = [[], []]
    for i in range(0, len(x), 512):
        for j in range(i, len(x), 512):
            near = x[i : i + 512] @ x[j : j + 512].T >= threshold
            if side is not None:
                near &= side[i : i + 512][:, None] != side[j : j + 512][None]
            left, right = np.nonzero(near)
            left, right = left + i, right + j
            keep = left < right
            left, right = left[keep], right[keep]
            first = (own[left] == own[right]).argmax(1) == table
            found[0].append(left[first])
            found[1].append(right[first])
    return np.concatenate(found[0]), np.concatenate(found[1])


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    A vector that is null, empty, all zero or holds a null or non-finite component, or has no
    label or no id, links with nothing. Vectors of different lengths do not link. Rows that
    share an id are one vertex whose links add up. Ids are whole numbers.
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(label).alias("label"), F.col(embedding).alias("v"))
    sound = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(sound, F.lit(False)) & F.col("label").isNotNull() & F.col("id").isNotNull())
    rows = rows.withColumns({"h": F.when(F.col("ok"), F.xxhash64("v")), "g": F.when(F.col("ok"), F.xxhash64(F.lit(9), "v"))})
    distinct = durable(rows.where("ok").groupBy("label", "h", "g").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("m"), F.first("v").alias("v")).withColumn("size", F.size("v")))
    largest = distinct.groupBy("label").count().agg(F.max("count")).head()[0] or 0
    bits, tables = shape(largest, threshold)
    found = durable(links(distinct.select("label", "size", "id", "m", "v"), threshold, bits, tables))
    reached = graph.components(found.select("a", "b"))
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    named = distinct.select("label", "h", "g", "id", "m").join(counts, F.col("id") == F.col("a"), "left").join(reached, F.col("id") == F.col("node"), "left")
    named = named.select("label", "h", "g", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    joined = rows.select("id", "label", "h", "g").join(named, ["label", "h", "g"], "left")
    component = F.coalesce("component_id", "id")
    return joined.select(F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))
