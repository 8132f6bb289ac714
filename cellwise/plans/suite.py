"""The benchmark suites: which matrices exist, and which products are timed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellwise.model import DenseMatrix, Matrix, Shape, Vector
from cellwise.sources import generate as g

# Sizes and densities of the suites.
MEDIUM = {"100x100_1pct": (100, 100, 0.01), "100x100_5pct": (100, 100, 0.05), "100x100_10pct": (100, 100, 0.10),
          "100x100_30pct": (100, 100, 0.30), "50x100_5pct": (50, 100, 0.05), "100x50_5pct": (100, 50, 0.05)}
LARGE = {"1k_1pct": (1000, 0.01), "1k_5pct": (1000, 0.05), "5k_0.1pct": (5000, 0.001), "5k_1pct": (5000, 0.01),
         "10k_0.1pct": (10000, 0.001), "10k_0.5pct": (10000, 0.005)}
SCALE_SIZES = [500, 1000, 2000, 4000]
SCALE_DENSITY = 0.01
SPARSITY_SIZE = 2000
SPARSITY_LEVELS = [0.001, 0.005, 0.01, 0.05, 0.1, 0.2]
SHAPES = {"tall": (1000, 100), "wide": (100, 1000), "square": (1000, 1000)}
PATTERN_SIZE = 1000

# The small matrices and vectors, row by row.
SMALL = {
    "matrix_3x3_sparse": [[4, 0, 9], [0, 7, 0], [0, 0, 5]],
    "rect_3x5": [[1, 0, 2, 0, 3], [0, 4, 0, 5, 0], [6, 0, 7, 0, 8]],
}
SMALL_DENSE = {
    "matrix_3x3_dense": [[1, 2, 3], [4, 5, 6], [7, 8, 9]],
    "rect_5x3": [[1, 2, 3], [0, 0, 0], [4, 5, 6], [0, 0, 0], [7, 8, 9]],
}
SMALL_VECTORS = {"vector_3": [1, 2, 3], "vector_4": [1, 2, 3, 4], "vector_5": [1, 0, 2, 0, 3]}
SMALL_DIAGONAL = [5, 3, 8, 2]

Operand = Matrix | DenseMatrix | Vector


def _dense(spark: SparkSession, rows: list[list[float]]) -> DenseMatrix:
    data = [(k, [float(v) for v in row]) for k, row in enumerate(rows)]
    return DenseMatrix(spark.createDataFrame(data, "k bigint, row array<double>"), Shape(len(rows), len(rows[0])))


def _vector(spark: SparkSession, values: list[float]) -> Vector:
    data = [(k, float(x)) for k, x in enumerate(values)]
    return Vector(spark.createDataFrame(data, "k bigint, x double"), len(values), dense=True)


def operands() -> dict[str, Callable[[SparkSession], Operand]]:
    """Every suite matrix and vector by name, made on demand."""
    diagonal_values = F.element_at(F.array(*map(F.lit, SMALL_DIAGONAL)), (F.col("i") + 1).cast("int"))
    made: dict[str, Callable[[SparkSession], Operand]] = {
        "identity_5x5": lambda s: g.identity(s, 5),
        "zero_4x4": lambda s: g.zero(s, 4, 4),
        "diagonal_4x4": lambda s: g.diagonal(s, 4, diagonal_values),
        "upper_triangular_4x4": lambda s: g.upper_triangular(s, 4),
        "sparse_vector_100": lambda s: g.sparse_vector(s, 100, 0.1),
        "tridiagonal_1000": lambda s: g.banded(s, PATTERN_SIZE, PATTERN_SIZE, 1),
        "banded_1000_width10": lambda s: g.banded(s, PATTERN_SIZE, PATTERN_SIZE, 10),
        "block_diagonal_1000": lambda s: g.block_diagonal(s, PATTERN_SIZE, PATTERN_SIZE, 10, 0.5),
        "power_law_1000": lambda s: g.power_law(s, PATTERN_SIZE, PATTERN_SIZE, 10_000),
        "row_hotspot_1000": lambda s: g.row_hotspot(s, PATTERN_SIZE, PATTERN_SIZE, 0.01, 10),
    }
    for name, rows in SMALL.items():
        made[name] = lambda s, rows=rows: g.from_rows(s, rows)
    for name, rows in SMALL_DENSE.items():
        made[name] = lambda s, rows=rows: _dense(s, rows)
    for name, values in SMALL_VECTORS.items():
        made[name] = lambda s, values=values: _vector(s, values)
    for name, (rows, cols, density) in MEDIUM.items():
        made[f"matrix_{name}"] = lambda s, r=rows, c=cols, d=density: g.uniform_draws(s, r, c, d)
    for name, (n, density) in LARGE.items():
        made[f"matrix_{name}"] = lambda s, n=n, d=density: g.uniform_rows(s, n, n, d)
    for n in SCALE_SIZES:
        made[f"scale_{n}x{n}"] = lambda s, n=n: g.uniform_rows(s, n, n, SCALE_DENSITY)
    for level in SPARSITY_LEVELS:
        label = f"{level * 100:.1f}".replace(".", "_")
        made[f"sparsity_2000x2000_{label}pct"] = lambda s, d=level: g.uniform_rows(s, SPARSITY_SIZE, SPARSITY_SIZE, d)
    for name, (rows, cols) in SHAPES.items():
        made[f"shape_{name}_{rows}x{cols}"] = lambda s, r=rows, c=cols: g.uniform_rows(s, r, c, SCALE_DENSITY)
    for n in (50, 100, 500, 1000, 2000, 4000, 5000, 10000):
        made[f"vector_{n}"] = lambda s, n=n: g.dense_vector(s, n, values="counting" if n <= 10 else "normal")
    return made


@dataclass(frozen=True)
class Case:
    name: str
    left: str
    right: str


# The timed products.
CASES = [
    Case("small_spmv_3x3", "matrix_3x3_sparse", "vector_3"),
    Case("small_spmm_3x3", "matrix_3x3_sparse", "matrix_3x3_dense"),
    Case("small_identity_rect", "identity_5x5", "rect_5x3"),
    Case("small_zero_x_diag", "zero_4x4", "diagonal_4x4"),
    Case("med_100x100_1pct_x_100", "matrix_100x100_1pct", "vector_100"),
    Case("med_100x100_5pct_x_100", "matrix_100x100_5pct", "vector_100"),
    Case("med_100x100_10pct_x_100", "matrix_100x100_10pct", "vector_100"),
    Case("med_100x100_30pct_x_100", "matrix_100x100_30pct", "vector_100"),
    Case("med_rect_50x100_x_100", "matrix_50x100_5pct", "vector_100"),
    Case("med_rect_100x50_mul", "matrix_100x50_5pct", "matrix_50x100_5pct"),
    Case("lg_1k_1pct_x_1k", "matrix_1k_1pct", "vector_1000"),
    Case("lg_5k_0_1pct_x_5k", "matrix_5k_0.1pct", "vector_5000"),
    Case("lg_10k_0_1pct_x_10k", "matrix_10k_0.1pct", "vector_10000"),
    Case("pat_tridiag_1000_x", "tridiagonal_1000", "vector_1000"),
    Case("pat_banded10_1000_x", "banded_1000_width10", "vector_1000"),
    Case("pat_blockdiag_1000_x", "block_diagonal_1000", "vector_1000"),
    Case("pat_powerlaw_1000_x", "power_law_1000", "vector_1000"),
    Case("pat_rowhot_1000_x", "row_hotspot_1000", "vector_1000"),
    Case("bench_scale_1000", "scale_1000x1000", "vector_1000"),
    Case("bench_sparsity_2000_1pct", "sparsity_2000x2000_1_0pct", "vector_2000"),
]
