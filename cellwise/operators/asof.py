"""Rows joined to the latest mark that is not after them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellwise.session import durable


def latest_mark(rows: DataFrame, marks: DataFrame, by: str, at: str, name: str) -> DataFrame:
    """``rows`` with column ``name``: the columns of the last mark of the same ``by`` up to ``at``.

    A mark counts for rows of its own time. Both sides are united and cut into ranges of
    (by, at), so a frequent ``by`` is spread over many tasks; a range carries its last mark
    along its rows, and what it leaves at its end, one mark a range, is carried over by the
    driver. Rows of one ``by`` and one time stay together. NULL stands for no mark; a NULL
    time comes before all marks.
    """
    mark = F.struct(*(F.col(c) for c in marks.columns))
    kind = marks.select(mark.alias(name)).schema[name].dataType.simpleString()
    both = rows.withColumn("_side", F.lit(1)).unionByName(
        marks.select(by, at, F.lit(0).alias("_side"), mark.alias(name)), allowMissingColumns=True
    )
    order = [F.asc_nulls_first(by), F.asc_nulls_first(at), F.asc("_side")]
    ranged = durable(both.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    place = F.struct(by, at)
    ends = ranged.where("_side = 0").groupBy("_range").agg(F.max_by(name, place).alias(name)).collect()
    left = {r["_range"]: r[name] for r in ends}
    ranges = sorted(r["_range"] for r in ranged.select("_range").distinct().collect())
    carried, last = [], None
    for number in ranges:
        carried.append((number, last))
        last = left.get(number, last)
    schema = f"_range int, _carried {kind}"
    known = F.broadcast(rows.sparkSession.createDataFrame(carried, schema))
    own = F.last(name, ignorenulls=True).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    found = ranged.join(known, "_range").withColumn(name, F.coalesce(own, F.col("_carried")))
    # Marks stand in order of ``by`` too: the last one may belong to another.
    found = found.where("_side = 1").withColumn(name, F.when(F.col(name)[by].eqNullSafe(F.col(by)), F.col(name)))
    return found.select(*rows.columns, name)
