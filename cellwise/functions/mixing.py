"""Deterministic pseudo-random columns.

Every draw is a hash of its coordinates and a seed, so generated data depends neither
on partitioning nor on task retries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8


def hashed(*keys: Column | int) -> Column:
    return F.xxhash64(*[F.lit(k).cast("bigint") if isinstance(k, int) else k for k in keys])


def uniform(*keys: Column | int) -> Column:
    """Uniform in [0, 1) from the top 53 bits of the hash."""
    return F.shiftrightunsigned(hashed(*keys), 11).cast("double") * F.lit(2.0**-53)


def gaussian(*keys: Column | int) -> Column:
    """Standard normal by the Box-Muller transform."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(*keys, 1)))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(*keys, 2))


def permutation_keys(row: Column, seed: int) -> Column:
    """The keys of one pseudo-random permutation per row, an array for :func:`permuted`."""
    return F.array(*[hashed(row, seed, r) for r in range(ROUNDS + 1)])


def permuted(slot: Column, keys: Column, n: int) -> Column:
    """Where the permutation with these keys puts ``slot``, both in 0 .. n-1.

    A rotation makes every position equally likely; swap-or-not rounds (Hoang, Morris
    and Rogaway, 2012) then exchange x with key - x or leave both, decided by one hash
    of the pair. Each step is a bijection for any n, so distinct slots get distinct
    positions without a set, a sort or an array of all n candidates.
    """
    size = F.lit(n).cast("bigint")

    def swap_or_not(x: Column, key: Column) -> Column:
        partner = F.pmod(F.pmod(key, size) - x, size)
        swap = hashed(F.greatest(x, partner), key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, partner).otherwise(x)

    rotated = F.pmod(slot + F.pmod(F.get(keys, F.lit(0)), size), size)
    return F.aggregate(F.slice(keys, 2, ROUNDS), rotated, swap_or_not)


def permuted_rows(df: DataFrame, slot: Column, row: str, seed: int, n: int, name: str) -> DataFrame:
    """``row`` and column ``name``, where :func:`permuted` puts ``slot``, for every row of ``df``.

    ``df`` has one line for each run of slots and ``slot`` explodes it, so the keys and what they
    leave modulo n are worked out once a run. The rounds are plain columns, compiled with
    what reads them, and divide nothing; a fold over an array is interpreted for each slot.
    """
    size = F.lit(n).cast("bigint")
    keys = permutation_keys(F.col(row), seed)
    keyed = df.withColumn("_keys", keys)
    keyed = keyed.withColumns(
        {f"_k{r}": F.get("_keys", F.lit(r)) for r in range(1, ROUNDS + 1)}
        | {f"_m{r}": F.pmod(F.get("_keys", F.lit(r)), size) for r in range(ROUNDS + 1)}
    )
    rounds = [c for r in range(1, ROUNDS + 1) for c in (f"_k{r}", f"_m{r}")]

    def modulo(x: Column, low: bool) -> Column:
        return F.when(x < 0, x + size).otherwise(x) if low else F.when(x >= size, x - size).otherwise(x)

    at = keyed.select(row, *rounds, "_m0", slot.alias("_slot"))
    at = at.select(row, *rounds, (F.col("_slot") + F.col("_m0")).alias("_x"))
    at = at.select(row, *rounds, modulo(F.col("_x"), False).alias("_x"))
    for r in range(1, ROUNDS + 1):
        left = rounds[2 * r :]
        at = at.select(row, *rounds[2 * r - 2 :], "_x", (F.col(f"_m{r}") - F.col("_x")).alias("_p"))
        at = at.select(row, f"_k{r}", *left, "_x", modulo(F.col("_p"), True).alias("_p"))
        swap = hashed(F.greatest("_x", "_p"), F.col(f"_k{r}")).bitwiseAND(F.lit(1)) == 1
        at = at.select(row, *left, F.when(swap, F.col("_p")).otherwise(F.col("_x")).alias("_x"))
    return at.select(row, F.col("_x").alias(name))
