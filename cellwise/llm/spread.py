"""Moving work through Spark: sorted groups in tasks, durable tables, sizes."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.session import durable, shuffle_partitions

__all__ = ["durable", "importable", "sorted_runs", "map_runs", "text_size", "shuffle_partitions", "table"]


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver has it, if it is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sorted_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches of rows sorted by ``keys``, regrouped so that no key is cut in two."""
    held: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        part = pa.Table.from_batches([batch])
        columns = [part.column(k).to_numpy(zero_copy_only=False) for k in keys]
        if held and all(held[0].column(k)[0].as_py() == c[0] for k, c in zip(keys, columns, strict=True)):
            changes = np.flatnonzero(np.any([c[1:] != c[0] for c in columns], axis=0)) if batch.num_rows > 1 else []
            first = int(changes[0]) + 1 if len(changes) else part.num_rows
            held.append(part.slice(0, first))
            part = part.slice(first)
            if part.num_rows == 0:
                continue
            columns = [c[first:] for c in columns]
        if held:
            yield pa.concat_tables(held)
            held = []
        same = np.all([c == c[-1] for c in columns], axis=0)
        last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if last:
            yield part.slice(0, last)
        held = [part.slice(last)]
    if held:
        yield pa.concat_tables(held)


def map_runs(df: DataFrame, keys: list[str], function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``function`` over whole groups of ``keys``, many groups a call, after one shuffle by key."""

    def work(batches):
        for run in sorted_runs(batches, keys):
            yield from function(run).to_batches()

    dealt = df.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(work, schema)


def text_size(docs: DataFrame, text: str) -> tuple[int, int]:
    """(rows, bytes of text); only layout depends on them."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text))).alias("b")).head()
    return row["n"], int(row["b"] or 0)
