"""Sums of doubles that do not depend on the order of their rows.

A floating sum rounds at every step, so its last bits follow the partitions. Here each
value is cut into four whole numbers on a fixed grid of 21 bits. Whole numbers add up
exactly in any order, combine before the shuffle like every sum, and only the grid cells
of a finished group are joined into a double, which rounds once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a grid cell. A value has 53, and may begin anywhere in the first of four cells.
BITS = 21
PARTS = 4

# Cells above the topmost one that a sum of up to 2^63 there can reach.
_CARRY = 3


def exact_sums(df: DataFrame, keys: list[str], value: str, name: str = "total") -> DataFrame:
    """Per group the sum of ``value`` as the nearest double to the exact one.

    NULLs are skipped and a group of NULLs alone gives NULL, as with SUM. A NaN, or infinities of
    both signs, give NaN; infinities of one sign stay. A zero sum is 0.0, never -0.0. Totals too
    small for a normal double are rounded twice. About 10^12 rows of like size fit a group;
    beyond that the sum of the cells overflows, which ANSI mode reports.
    """
    x = F.col(value).cast("double")
    finite = (F.abs(x) < float("inf")) & (x != 0)
    cut = df.select(*keys, x.alias("_x"), F.when(finite, F.floor(F.log2(F.abs(x)) / BITS).cast("int")).alias("_top"))
    scaled = _scaled(F.col("_x"), -F.col("_top"))
    parts = []
    for p in range(PARTS):
        cut = cut.withColumn("_rest", scaled if p == 0 else (F.col("_rest") - F.col(f"_{p - 1}")) * float(1 << BITS))
        cut = cut.withColumn(f"_{p}", F.when(F.col("_top").isNotNull(), F.col("_rest")).cast("bigint"))
        parts.append(F.sum(f"_{p}"))
    cells = cut.groupBy(*keys, "_top").agg(
        F.array(*parts).alias("_sums"),
        F.count("_x").alias("_n"),
        # NaN and infinities: their sum is the same in any order.
        F.sum(F.when(F.col("_top").isNull() & (F.col("_x") != 0), F.col("_x"))).alias("_special"),
    )
    groups = cells.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("_top").isNotNull(), F.struct("_top", "_sums"))).alias("_cells"),
        F.sum("_n").alias("_n"),
        F.sum("_special").alias("_special"),
    )
    total = F.when(F.size("_cells") == 0, F.lit(0.0)).otherwise(F.col("_total"))
    joined = _joined(groups, keys)
    return joined.select(*keys, F.when(F.col("_n") > 0, F.coalesce("_special", total)).alias(name))


def _scaled(x: Column, cells: Column) -> Column:
    """x times 2^(BITS cells), in two steps because the power alone may overflow."""
    half = F.floor(cells * BITS / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), cells * BITS - half)


def _joined(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``_total``: the cells of each group carried into one number and rounded once."""
    zero = F.lit(0).cast("bigint")

    def at(place: Column) -> Column:
        def add(sum_: Column, cell: Column) -> Column:
            p = cell["_top"] - place
            return sum_ + F.when(p.between(0, PARTS - 1), F.get(cell["_sums"], p)).otherwise(zero)

        return F.aggregate("_cells", zero, add)

    def carried(state: Column, v: Column) -> Column:
        v = state["carry"] + v * F.col("_sign")
        digit = v.bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint"))
        return F.struct(F.shiftright(v, BITS).alias("carry"), F.concat(F.array(digit), state["digits"]).alias("digits"))

    tops = F.transform("_cells", lambda c: c["_top"])
    high = (F.array_max(tops) + _CARRY).alias("_high")
    kept = [*keys, "_cells", "_n", "_special", "_high"]
    out = groups.select(*keys, "_cells", "_n", "_special", high)
    places = F.sequence(F.array_min(tops) - (PARTS - 1), F.col("_high"))
    out = out.select(*kept, F.transform(places, at).alias("_sums"))
    # The carry out of the topmost cell is 0, or -1 for a negative number.
    out = out.withColumn("_sign", 1 + 2 * F.aggregate("_sums", zero, lambda c, v: F.shiftright(c + v, BITS)))
    start = F.struct(zero.alias("carry"), F.array(*[zero] * PARTS).alias("digits"))
    out = out.select(*kept, "_sign", F.aggregate("_sums", start, carried, lambda s: s["digits"]).alias("_digits"))
    # From the first digit that is not zero: three digits, then as much of the fourth as fits
    # a BIGINT, and one bit for whatever is below. The cast to a double rounds it to nearest.
    first = F.array_position(F.transform("_digits", lambda d: d != 0), True).cast("int")
    out = out.withColumn("_first", first)
    digit = [F.get("_digits", F.col("_first") - 1 + p) for p in range(PARTS)]
    out = out.withColumn("_head", F.shiftleft(digit[0], 2 * BITS) + F.shiftleft(digit[1], BITS) + digit[2])
    out = out.withColumn("_next", digit[3])
    out = out.withColumn("_shift", F.when(F.col("_head") < 1 << 48, 14).when(F.col("_head") < 1 << 54, 8).otherwise(0))
    taken, left = F.expr(f"shiftright(_next, {BITS} - _shift)"), F.expr(f"_next & (shiftleft(1L, {BITS} - _shift) - 1)")
    below = (left != 0) | F.exists(F.slice("_digits", F.col("_first") + PARTS, F.size("_digits")), lambda d: d != 0)
    number = (F.expr("shiftleft(_head, _shift)") + taken).bitwiseOR(F.when(below, 1).otherwise(0).cast("bigint"))
    rounded = number.cast("double") * F.pow(F.lit(2.0), -F.col("_shift")) * F.col("_sign")
    total = _scaled(rounded, F.col("_high") - F.col("_first") - 1)
    return out.select(*keys, "_cells", "_n", "_special", F.when(F.col("_first") > 0, total).otherwise(0.0).alias("_total"))
