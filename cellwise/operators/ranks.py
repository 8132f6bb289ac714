"""Exact order statistics of groups of any size."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellwise.session import durable, sized


def nearest_ranks(share: float):
    """The 0-based rank ``round((n - 1) * share)``, half up, kept within the group."""

    def ranks(n):
        rank = F.floor((n - 1) * F.lit(share) + F.lit(0.5))
        return F.array(F.greatest(F.lit(0), F.least(n - 1, rank)).cast("bigint"))

    return ranks


def middle_ranks(n):
    """The middle element, or the two around the middle of an even count."""
    return F.array(F.floor((n - 1) / 2).cast("bigint"), F.floor(n / 2).cast("bigint"))


def _named(name: str, ranks: Column) -> Column:
    return F.transform(ranks, lambda r: F.struct(F.lit(name).alias("pick"), r.alias("rank")))


def joined_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys of which NULLs match one another, as they do in a grouping."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_right_{k}" for k in keys])


def order_statistics(df: DataFrame, keys: list[str], value: str, picks: dict, single: bool = False) -> DataFrame:
    """Per group, one column for each pick: the mean of the values at the ranks it names.

    With ``single`` each pick names one rank, and its value comes back in its own type.

    ``picks`` maps a column name to a function from the group's count to 0-based ranks.

    A rank needs the whole group in order, which for a hot group is more than one task
    can hold. So equal values are counted first, the distinct (group, value) pairs are
    cut into ranges of about equal size, and a window over range totals, a few numbers
    per group, finds the range that holds each rank. Only those ranges are then walked.
    The ranges are written down once, since both passes must see the same cut.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_x")).agg(F.count("*").alias("_c"))
    ranged = durable(counted.repartitionByRange(*keys, "_x").withColumn("_b", F.spark_partition_id()))
    in_order = Window.partitionBy(*keys).orderBy("_b")
    blocks = ranged.groupBy(*keys, "_b").agg(F.sum("_c").alias("_m")).select(
        *keys,
        "_b",
        "_m",
        F.sum("_m").over(Window.partitionBy(*keys)).alias("_n"),
        (F.sum("_m").over(in_order) - F.col("_m")).alias("_before"),
    )
    wanted = F.explode(F.concat(*[_named(name, ranks(F.col("_n"))) for name, ranks in picks.items()]))
    # A few rows per group. With their number known they filter the ranges in place.
    targets, _ = sized(
        blocks.withColumn("_w", wanted)
        .select(*keys, "_b", F.col("_w.pick").alias("_pick"), (F.col("_w.rank") - F.col("_before")).alias("_r"), "_m")
        .where("_r >= 0 and _r < _m")
        .groupBy(*keys, "_b")
        .agg(F.collect_list(F.struct("_pick", "_r")).alias("_targets"))
    )
    walked = joined_on(ranged, targets, [*keys, "_b"]).withColumn(
        "_upto", F.sum("_c").over(Window.partitionBy(*keys, "_b").orderBy("_x"))
    )
    hits = walked.select(
        *keys,
        "_x",
        F.explode(
            F.filter("_targets", lambda t: (t["_r"] < F.col("_upto")) & (t["_r"] >= F.col("_upto") - F.col("_c")))
        ).alias("_hit"),
    )
    return hits.groupBy(*keys).agg(
        *[(F.max if single else F.avg)(F.when(F.col("_hit._pick") == name, F.col("_x"))).alias(name) for name in picks]
    )
