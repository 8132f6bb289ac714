"""Matrices and vectors from delimited text, one matrix row per line.

Readers work on a DataFrame of numbered lines (row BIGINT, value STRING), which
:func:`read_lines` makes from files and any table with a line column can supply.

Two modes treat bad tokens. ``strict`` drops lines that are not numeric, numbers the
rest, and fails on an empty token inside a line. ``lenient`` numbers the raw lines,
drops empty tokens before counting columns and skips tokens that are no number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.text import filled_tokens, is_numeric_line, normalized_line, number, tokens, trimmed
from cellwise.model import DenseMatrix, Matrix, Shape, Vector, drop_zeros
from cellwise.operators.prefix import prefix_sums
from cellwise.session import fits_broadcast

# One block of the line index: file path, start, count, first id.
_BYTES_PER_BLOCK = 512


@dataclass(frozen=True)
class ScannedLines:
    """Numbered lines (row, value) with what the first scan has counted.

    ``narrowest`` and ``widest`` are token counts of a line, ``nonzeros`` numbers that are not
    zero, for the tokens that the mode reads; all 0 where there is no line.
    """

    df: DataFrame
    count: int
    narrowest: int
    widest: int
    nonzeros: int


def scan_lines(spark: SparkSession, paths: str | list[str], keep: str = "all") -> ScannedLines:
    """Numbered lines in file order, files in path order, counted and measured in one scan.

    ``keep`` is ``all``, ``filled`` (no blank lines) or ``numeric``; lines are numbered
    after that filter. A scan task reads whole file blocks, so ids grow by one within a
    block; the row number is the block's offset plus the distance to its first id. One row a
    block is written down, with its counts; offsets are prefix sums over these in two levels,
    and go to the lines by a join, broadcast if the counted blocks fit.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    numeric = keep == "numeric"
    if keep == "filled":
        lines = lines.where(trimmed(F.col("value")) != "")
    elif numeric:
        lines = lines.where(is_numeric_line(F.col("value")))
    elif keep != "all":
        raise ValueError(f"keep must be 'all', 'filled' or 'numeric', not {keep!r}")
    lines = lines.withColumn("id", F.monotonically_increasing_id())

    parts = tokens(F.col("value")) if numeric else filled_tokens(F.col("value"))
    values = F.transform(parts, lambda t: t.try_cast("double") if numeric else number(t))
    width = F.size(parts)
    blocks = lines.groupBy("file", "start").agg(
        F.count("*").alias("n"),
        F.min("id").alias("first_id"),
        F.min(width).alias("narrowest"),
        F.max(width).alias("widest"),
        F.sum(F.size(F.filter(values, lambda x: x != 0))).alias("nonzeros"),
    )
    offsets = prefix_sums(blocks, ["file", "start"], "n", "offset")
    found = offsets.agg(
        F.count("*"), *(F.coalesce(f, F.lit(0)) for f in (F.sum("n"), F.min("narrowest"), F.max("widest"), F.sum("nonzeros")))
    ).first()
    offsets = offsets.select("file", "start", "first_id", "offset")
    if fits_broadcast(spark, found[0], _BYTES_PER_BLOCK):
        offsets = F.broadcast(offsets)
    numbered = lines.join(offsets, ["file", "start"]).select(
        (F.col("offset") + F.col("id") - F.col("first_id")).alias("row"), "value"
    )
    return ScannedLines(numbered, *found[1:])


def read_lines(spark: SparkSession, paths: str | list[str], keep: str = "all") -> DataFrame:
    """Numbered lines (row, value) of text files; see :func:`scan_lines`."""
    return scan_lines(spark, paths, keep).df


def numeric_lines(lines: DataFrame) -> DataFrame:
    """Lines whose non-blank tokens all are numbers, at least one of them."""
    return lines.where(is_numeric_line(F.col("value")))


def strict_cells(lines: DataFrame) -> DataFrame:
    """Nonzero cells of numeric lines; an empty token inside a line is an error."""
    return drop_zeros(
        lines.select(F.col("row").alias("i"), F.posexplode(tokens(F.col("value"))).alias("j", "t")).select(
            "i", F.col("j").cast("bigint").alias("j"), F.col("t").cast("double").alias("v")
        )
    )


def lenient_cells(lines: DataFrame) -> DataFrame:
    """Nonzero cells of any lines; later tokens move left past an empty one."""
    return drop_zeros(
        lines.select(F.col("row").alias("i"), F.posexplode(filled_tokens(F.col("value"))).alias("j", "t")).select(
            "i", F.col("j").cast("bigint").alias("j"), number(F.col("t")).alias("v")
        )
    )


def dense_lines(lines: DataFrame) -> DataFrame:
    """Numeric lines as (k, row ARRAY<DOUBLE>)."""
    return lines.select(
        F.col("row").alias("k"),
        F.transform(tokens(F.col("value")), lambda t: t.cast("double")).alias("row"),
    )


def _measured(lines: DataFrame) -> tuple[Shape, int]:
    """Shape and nonzero count of numeric lines in one pass; ragged rows are an error."""
    row = F.transform(tokens(F.col("value")), lambda t: t.cast("double"))
    per_line = lines.select(F.size(row).alias("n"), F.size(F.filter(row, lambda x: x != 0)).alias("nonzeros"))
    rows, low, high, nonzeros = per_line.agg(F.count("*"), F.min("n"), F.max("n"), F.sum("nonzeros")).first()
    if low != high:
        raise ValueError(f"ragged rows: between {low} and {high} columns")
    return Shape(rows, high or 0), nonzeros or 0


def grid_matrix(lines: DataFrame, mode: str = "strict") -> Matrix:
    """Numbered lines as a sparse matrix.

    Strict input must be rectangular. Lenient input is as wide as its widest line.
    """
    if mode == "strict":
        shape, nonzeros = _measured(lines)
        return Matrix(strict_cells(lines), shape, nonzeros=nonzeros)
    if mode == "lenient":
        width = F.size(filled_tokens(F.col("value")))
        rows, high = lines.agg(F.max("row"), F.max(width)).first()
        return Matrix(lenient_cells(lines), Shape(0 if rows is None else rows + 1, high or 0))
    raise ValueError(f"mode must be 'strict' or 'lenient', not {mode!r}")


def _strict_shape(lines: ScannedLines) -> Shape:
    if lines.narrowest != lines.widest:
        raise ValueError(f"ragged rows: between {lines.narrowest} and {lines.widest} columns")
    return Shape(lines.count, lines.widest)


def read_grid(spark: SparkSession, paths: str | list[str], mode: str = "strict") -> Matrix:
    """Text grid as a sparse matrix; one scan counts and measures it, one more reads the cells."""
    if mode == "strict":
        lines = scan_lines(spark, paths, "numeric")
        return Matrix(strict_cells(lines.df), _strict_shape(lines), nonzeros=lines.nonzeros)
    if mode == "lenient":
        lines = scan_lines(spark, paths)
        return Matrix(lenient_cells(lines.df), Shape(lines.count, lines.widest), nonzeros=lines.nonzeros)
    raise ValueError(f"mode must be 'strict' or 'lenient', not {mode!r}")


def read_dense(spark: SparkSession, paths: str | list[str]) -> DenseMatrix:
    """Text grid as a dense matrix; empty input gives 0x0, ragged rows are an error."""
    lines = scan_lines(spark, paths, "numeric")
    return DenseMatrix(dense_lines(lines.df), _strict_shape(lines), lines.nonzeros)


def read_vector(
    spark: SparkSession,
    paths: str | list[str],
    orientation: str = "auto",
    mode: str = "lenient",
    sparse: bool = False,
    first_line_only: bool = False,
) -> Vector:
    """Text vector.

    ``column`` is one number per line, ``row`` one line of numbers (further lines are an
    error, unless ``first_line_only`` says to leave them), ``auto`` decides by a comma in the first line that is not blank. Lenient
    input skips tokens that are no number but keeps their index; strict input drops
    lines that are not numeric and fails on a column line with several values.
    """
    scanned = scan_lines(spark, paths, "numeric" if mode == "strict" else "filled")
    lines = scanned.df
    if scanned.count == 0:
        raise ValueError("empty vector input")
    first = lines.where("row = 0")
    if orientation == "auto":
        orientation = "row" if first.where(F.col("value").contains(",")).head() else "column"
    if orientation == "row":
        if not first_line_only and scanned.count > 1:
            raise ValueError("not a row vector: there are several lines")
        n = first.select(F.size(filled_tokens(F.col("value")))).head()[0]
        pairs = first.select(F.posexplode(filled_tokens(F.col("value"))).alias("k", "t"))
    elif orientation == "column":
        n = scanned.count
        if mode == "strict" and scanned.widest > 1:
            raise ValueError("not a column vector: a line holds several values")
        pairs = lines.select(F.col("row").alias("k"), F.col("value").alias("t"))
    else:
        raise ValueError(f"orientation must be 'auto', 'row' or 'column', not {orientation!r}")
    pairs = pairs.select(F.col("k").cast("bigint").alias("k"), number(F.col("t")).alias("x"))
    pairs = pairs.where("x is not null")
    return Vector(pairs.where("x != 0") if sparse else pairs, n)


def normalize_text(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Free text as CSV lines: (key, pos, value) for every line that is not blank."""
    split = texts.select(F.col(key), F.posexplode(F.split(F.col(text), r"\r?\n")).alias("pos", "line"))
    return split.select(key, "pos", normalized_line(F.col("line")).alias("value")).where("value != ''")
