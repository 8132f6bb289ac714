"""Sparse linear algebra on Spark DataFrames."""

from cellwise.model import (
    DenseMatrix,
    Matrix,
    Shape,
    Vector,
    by_col,
    by_row,
    coo_from_table,
    drop_zeros,
    vector_from_table,
)
from cellwise.operators.iterate import l1_distance, l1_norm, power_iteration
from cellwise.operators.layout import checksum, dense_rows, glance, preview, vector_line
from cellwise.operators.multiply import multiply, multiply_text, spdm, spmm, spmspv, spmv
from cellwise.operators.profile import is_sparse, shape_profile

__all__ = [
    "DenseMatrix", "Matrix", "Shape", "Vector", "by_col", "by_row", "checksum", "coo_from_table", "dense_rows",
    "drop_zeros", "glance", "is_sparse", "l1_distance", "l1_norm", "multiply", "multiply_text", "power_iteration",
    "preview", "shape_profile", "spdm", "spmm", "spmspv", "spmv", "vector_from_table", "vector_line",
]
