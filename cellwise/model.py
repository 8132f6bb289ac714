"""Data model: matrices as (i, j, v) triplets, vectors as (k, x) pairs.

Both are lazy DataFrames with their dimensions kept beside them as plain numbers.
Indices are BIGINT and count from 0, values are DOUBLE. A cell that is absent is zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Shape:
    rows: int
    cols: int

    @property
    def cells(self) -> int:
        return self.rows * self.cols

    def __str__(self) -> str:
        return f"{self.rows}x{self.cols}"


@dataclass(frozen=True)
class Segments:
    """Products before they are added up: cells (i, a_v), each with the packed cells of a row of the right matrix.

    Dealt out by i to ``tasks`` partitions, the products of each add up in memory.
    """

    df: DataFrame
    tasks: int


@dataclass(frozen=True)
class Matrix:
    """Sparse matrix: ``df`` holds one row per stored cell.

    ``terms`` are triplets that still may repeat an (i, j) pair and add up to ``df``.
    Sums over rows are linear in the cells, so they can read the terms and skip the
    shuffle that adds repeated pairs up. ``nonzeros`` is the number of cells where a
    reader has counted them already. ``segments`` are products that add up to ``df``; who needs
    whole rows can gather these and spares a second shuffle of the cells.
    """

    df: DataFrame
    shape: Shape
    terms: DataFrame | None = None
    nonzeros: int | None = None
    segments: Segments | None = None

    @property
    def summands(self) -> DataFrame:
        return self.df if self.terms is None else self.terms

    @property
    def transposed(self) -> Matrix:
        def flip(df: DataFrame) -> DataFrame:
            return df.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")

        terms = None if self.terms is None else flip(self.terms)
        return Matrix(flip(self.df), Shape(self.shape.cols, self.shape.rows), terms, self.nonzeros)


@dataclass(frozen=True)
class DenseMatrix:
    """Dense matrix: ``df`` is (k, row ARRAY<DOUBLE>), one row per matrix row."""

    df: DataFrame
    shape: Shape
    nonzeros: int | None = None

    def cells(self) -> DataFrame:
        """All cells as triplets, zeros included."""
        return self.df.select(
            F.col("k").alias("i"), F.posexplode("row").alias("p", "v")
        ).select("i", F.col("p").cast("bigint").alias("j"), "v")

    def to_sparse(self) -> Matrix:
        return Matrix(drop_zeros(self.cells()), self.shape, nonzeros=self.nonzeros)


@dataclass(frozen=True)
class Vector:
    """Vector of length ``n``; ``dense`` says that every index is present in ``df``.

    ``nonzeros`` is their number where a reader has counted them already.
    """

    df: DataFrame
    n: int
    dense: bool = False
    nonzeros: int | None = None

    def to_sparse(self) -> Vector:
        return Vector(self.df.where("x != 0"), self.n)


def drop_zeros(df: DataFrame) -> DataFrame:
    """Keep the nonzero cells. -0.0 counts as zero; NaN and infinities stay."""
    return df.where("v != 0")


def coo_from_table(
    df: DataFrame, i: str, j: str, v: str, shape: Shape, duplicates: str = "sum"
) -> Matrix:
    """A table with row, column and value columns as a matrix.

    Cells outside the shape, and rows with a NULL index, are left out. Repeated (i, j) pairs are added up, then zeros
    are dropped. With ``duplicates="none"`` the caller vouches that no pair repeats, which spares the
    shuffle and lets the zero filter reach the scan.
    """
    terms = df.select(
        F.col(i).cast("bigint").alias("i"),
        F.col(j).cast("bigint").alias("j"),
        F.col(v).cast("double").alias("v"),
    ).where(F.col("i").between(0, shape.rows - 1) & F.col("j").between(0, shape.cols - 1))
    if duplicates == "none":
        return Matrix(drop_zeros(terms), shape)
    if duplicates != "sum":
        raise ValueError(f"duplicates must be 'sum' or 'none', not {duplicates!r}")
    summed = terms.groupBy("i", "j").agg(F.sum("v").alias("v"))
    return Matrix(drop_zeros(summed), shape, terms)


def vector_from_table(
    df: DataFrame, k: str, x: str, n: int, dense: bool = False, duplicates: str = "sum"
) -> Vector:
    """A table with index and value columns as a vector of length ``n``.

    Indices that are NULL or outside 0 .. n-1 are left out and repeated ones added up, so ``n`` bounds the
    rows. With ``duplicates="none"`` the caller vouches that no index repeats, which spares
    the shuffle.
    """
    pairs = df.select(F.col(k).cast("bigint").alias("k"), F.col(x).cast("double").alias("x"))
    pairs = pairs.where(F.col("k").between(0, n - 1))
    if duplicates == "sum":
        pairs = pairs.groupBy("k").agg(F.sum("x").alias("x"))
    elif duplicates != "none":
        raise ValueError(f"duplicates must be 'sum' or 'none', not {duplicates!r}")
    return Vector(pairs, n, dense)


def indices(spark: SparkSession, n: int, name: str = "i", partitions: int | None = None) -> DataFrame:
    """The index range 0 .. n-1, generated in parallel."""
    return spark.range(0, n, 1, partitions).select(F.col("id").alias(name))


def by_row(m: Matrix, sort: str = "global") -> DataFrame:
    """Cells in row order. ``sort="within"`` clusters rows without a total order."""
    return _ordered(m.df, ["i", "j"], sort)


def by_col(m: Matrix, sort: str = "global") -> DataFrame:
    """Cells in column order; see :func:`by_row`."""
    return _ordered(m.df, ["j", "i"], sort)


def _ordered(df: DataFrame, keys: list[str], sort: str) -> DataFrame:
    # Both range-partition on the full key, so a hot row is cut between partitions.
    if sort == "global":
        return df.orderBy(*keys)
    if sort == "within":
        return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    raise ValueError(f"sort must be 'global' or 'within', not {sort!r}")
