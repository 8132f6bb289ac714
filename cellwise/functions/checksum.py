"""CRC-32 of a text held in pieces.

The checksum of two joined texts follows from their checksums and the length of the
second one, so a text never has to be put together to be summed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_POLYNOMIAL = 0xEDB88320
_LENGTH_BITS = 63  # all lengths that a BIGINT holds
_GROUP = 1024


def _squared(operator: list[int]) -> list[int]:
    return [_applied(operator, column) for column in operator]


def _applied(operator: list[int], value: int) -> int:
    out = 0
    for bit, column in enumerate(operator):
        if value >> bit & 1:
            out ^= column
    return out


def _zero_operators() -> list[int]:
    """For each power of two, the 32 columns of the map that appends so many zero bytes."""
    operator = [_POLYNOMIAL] + [1 << bit for bit in range(31)]  # one zero bit
    for _ in range(3):
        operator = _squared(operator)  # one zero byte
    columns = []
    for _ in range(_LENGTH_BITS):
        columns += operator
        operator = _squared(operator)
    return columns


def _bit(value: Column, position: Column) -> Column:
    # shiftright takes a plain number of bits only
    return F.call_function("shiftright", value, position.cast("int")).bitwiseAND(F.lit(1)) == 1


def _shifted(crc: Column, length: Column, table: Column) -> Column:
    def through(value: Column, power: Column) -> Column:
        def add(total: Column, bit: Column) -> Column:
            column = F.get(table, (power * 32 + bit).cast("int"))
            return F.when(_bit(value, bit), total.bitwiseXOR(column)).otherwise(total)

        return F.aggregate(F.sequence(F.lit(0), F.lit(31)), F.lit(0).cast("bigint"), add)

    def step(value: Column, power: Column) -> Column:
        return F.when(_bit(length, power), through(value, power)).otherwise(value)

    return F.aggregate(F.sequence(F.lit(0), F.lit(_LENGTH_BITS - 1)), crc, step)


def combined_crc32(pieces: DataFrame, count: int) -> DataFrame:
    """CRC-32 of pieces (pos BIGINT from 0, text STRING) in order, as 8 hex digits.

    Groups of _GROUP neighbours are combined level by level, so no task ever holds more
    than that many partial checksums. ``count`` is the number of pieces; without any, the
    text is empty and its checksum 00000000.
    """
    # One string constant, folded into an array once, instead of a literal per number.
    table = F.split(F.lit(",".join(map(str, _zero_operators()))), ",").cast("array<bigint>")
    # An empty piece changes no checksum, and gives a text without pieces its one row.
    nothing = pieces.sparkSession.range(1).select(F.col("id").alias("pos"), F.lit("").alias("text"))
    level = pieces.select("pos", "text").unionByName(nothing).select(
        "pos", F.crc32(F.encode("text", "UTF-8")).alias("crc"), F.octet_length("text").cast("bigint").alias("len")
    )
    while True:
        group = F.floor(F.col("pos") / _GROUP)
        parts = level.groupBy(group.alias("pos")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "crc", "len"))).alias("parts")
        )
        zero = F.struct(F.lit(0).cast("bigint").alias("crc"), F.lit(0).cast("bigint").alias("len"))
        joined = F.aggregate(
            "parts",
            zero,
            lambda acc, p: F.struct(
                _shifted(acc.crc, p.len, F.col("table")).bitwiseXOR(p.crc).alias("crc"), (acc.len + p.len).alias("len")
            ),
        )
        level = (
            parts.withColumn("table", table)
            .withColumn("joined", joined)
            .select("pos", F.col("joined.crc").alias("crc"), F.col("joined.len").alias("len"))
        )
        count = -(-count // _GROUP)
        if count <= 1:
            break
    return level.select(F.lower(F.lpad(F.hex("crc"), 8, "0")).alias("crc32"))
