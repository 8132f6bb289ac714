"""Running sums over a table in order, in two levels."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellwise.session import durable


def prefix_sums(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with column ``name``, the sum of ``value`` over all rows before each in ``order``.

    Rows are cut into ranges of the order. Each range adds up on its own; only one total a
    range, as many numbers as there are partitions, is added up by the driver. Rows are written
    down with their range, since a range would not come out the same when sampled again. The
    order must be of a key without repeats.
    """
    ranged = durable(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    totals = sorted((r["_range"], r["n"]) for r in ranged.groupBy("_range").agg(F.sum(value).alias("n")).collect())
    before = accumulate((n or 0 for _, n in totals), initial=0)
    starts = [(part, start) for (part, _), start in zip(totals, before, strict=False)]
    known = F.broadcast(df.sparkSession.createDataFrame(starts, "_range int, _start bigint"))
    own = F.sum(value).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    sums = ranged.join(known, "_range").withColumn(name, F.coalesce(own, F.lit(0)) + F.col("_start"))
    return sums.drop("_range", "_start")
