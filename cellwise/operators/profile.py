"""Shape and sparsity of inputs, and the checks made before a multiplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.text import filled_tokens, number, tokens, trimmed
from cellwise.model import DenseMatrix, Matrix, Shape, Vector

# Fixed value: an operand is sparse when less than this share of it is nonzero.
SPARSE_BELOW = 0.5

# Fixed value: the summary tables flag results with more cells than this. Nothing else looks at it.
MAX_SAVED_CELLS = 2_000_000


def _numbers(line):
    return F.filter(F.transform(filled_tokens(line), number), lambda x: x.isNotNull())


def _rated(counts: DataFrame) -> DataFrame:
    rate = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("nonzeros") / F.col("total"))
    return counts.select("nonzeros", "total", rate.alias("rate"), (rate < SPARSE_BELOW).alias("is_sparse"))


def value_sparsity(df: DataFrame, value: str) -> DataFrame:
    """One row: nonzero count, total count, their ratio, sparse or not."""
    return _rated(
        df.agg(
            F.count(F.when(F.col(value) != 0, 1)).alias("nonzeros"),
            F.count(value).alias("total"),
        )
    )


def line_sparsity(lines: DataFrame) -> DataFrame:
    """The same over the numeric tokens of text lines."""
    values = _numbers(F.col("value"))
    per_line = lines.select(
        F.size(F.filter(values, lambda x: x != 0)).alias("nonzero"), F.size(values).alias("all")
    )
    return _rated(
        per_line.agg(
            F.coalesce(F.sum("nonzero"), F.lit(0)).alias("nonzeros"),
            F.coalesce(F.sum("all"), F.lit(0)).alias("total"),
        )
    )


def matrix_sparsity(m: Matrix) -> DataFrame:
    """The same for stored cells against the full shape."""
    return _rated(m.df.agg(F.count("*").alias("nonzeros")).withColumn("total", F.lit(m.shape.cells).cast("bigint")))


def is_sparse(operand: Matrix | DenseMatrix | Vector) -> bool:
    if isinstance(operand, Vector):
        nonzeros = operand.df.where("x != 0").count() if operand.nonzeros is None else operand.nonzeros
        return operand.n == 0 or nonzeros / operand.n < SPARSE_BELOW
    if operand.nonzeros is not None:
        return operand.shape.cells == 0 or operand.nonzeros / operand.shape.cells < SPARSE_BELOW
    if isinstance(operand, Matrix) and operand.terms is not None:
        # Repeats only lower the number of cells, so few terms settle it without adding them up.
        if operand.terms.where("v != 0").count() < SPARSE_BELOW * operand.shape.cells:
            return True
    cells = operand.to_sparse() if isinstance(operand, DenseMatrix) else operand
    return matrix_sparsity(cells).first().is_sparse


def require_sparse_left(m: Matrix) -> None:
    if not is_sparse(m):
        raise ValueError("the left operand is not sparse: at least half of its cells are nonzero")


def shape_profile(lines: DataFrame) -> DataFrame:
    """One row of line and token counts, from which both shapes follow."""
    filled = F.size(filled_tokens(F.col("value")))
    numeric = F.size(_numbers(F.col("value")))
    per_line = lines.select(
        (trimmed(F.col("value")) != "").alias("is_filled"), filled.alias("filled"), numeric.alias("numeric")
    )
    return per_line.agg(
        F.count("*").alias("lines"),
        F.count(F.when(F.col("is_filled"), 1)).alias("filled_lines"),
        F.min(F.when(F.col("is_filled"), F.col("filled"))).cast("bigint").alias("min_tokens"),
        F.count(F.when(F.col("numeric") > 0, 1)).alias("numeric_lines"),
        F.min(F.when(F.col("numeric") > 0, F.col("numeric"))).cast("bigint").alias("min_numbers"),
        F.max(F.when(F.col("numeric") > 0, F.col("numeric"))).cast("bigint").alias("max_numbers"),
    )


def strict_shape(lines: DataFrame) -> Shape:
    """Rectangular shape from the numeric tokens; raises when there is none."""
    p = shape_profile(lines).first()
    if p.lines == 0:
        raise ValueError("empty input")
    if p.numeric_lines == 0:
        raise ValueError("no line holds a number")
    if p.min_numbers != p.max_numbers:
        raise ValueError(f"not rectangular: between {p.min_numbers} and {p.max_numbers} columns")
    return Shape(p.numeric_lines, p.min_numbers)


def lenient_shape(lines: DataFrame) -> Shape:
    """Filled lines by the fewest tokens found in one of them."""
    p = shape_profile(lines).first()
    return Shape(p.filled_lines, p.min_tokens or 0)


def check_multiply(left: Shape, right: Shape | int) -> None:
    inner = right if isinstance(right, int) else right.rows
    if left.cols != inner:
        shown = f"a vector of {right}" if isinstance(right, int) else str(right)
        raise ValueError(f"cannot multiply {left} by {shown}: {left.cols} columns meet {inner} rows")


def classify_vector_files(lines: DataFrame, file: str = "file", value: str = "value") -> DataFrame:
    """Per file: (file, lines, kind), kind saying how it reads as a vector."""
    toks = tokens(F.col(value))
    per_line = lines.select(
        file,
        F.size(toks).alias("width"),
        F.forall(toks, lambda t: (trimmed(t) != "") & number(t).isNotNull()).alias("numeric"),
        F.col(value).isNotNull().alias("present"),
    )
    stats = per_line.groupBy(file).agg(
        F.count(F.when(F.col("present"), 1)).alias("lines"),
        F.max("width").alias("widest"),
        F.min("width").alias("narrowest"),
        F.bool_and("numeric").alias("numeric"),
    )
    single = F.col("lines") == 1
    column = (F.col("widest") == 1) & (F.col("narrowest") == 1) & F.col("numeric")
    kind = (
        F.when(F.col("lines") == 0, "empty")
        .when(single & F.col("numeric"), "row vector")
        .when(single, "single line with other text")
        .when(column, "column vector")
        .otherwise("neither")
    )
    return stats.select(file, "lines", kind.alias("kind"))


def classify_text_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The same for text files by path, those without a line included.

    The listing that the driver has made to plan the scan is joined to what the lines give,
    since a file without a line gives no row to count. Paths are written with one slash
    after their scheme.
    """
    text = spark.read.text(paths)
    listed = spark.createDataFrame([(path,) for path in text.inputFiles()], "file string")

    def plain(path):
        return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")

    lines = text.select(plain(F.col("_metadata.file_path")).alias("file"), "value")
    found = listed.select(plain(F.col("file")).alias("file")).join(classify_vector_files(lines), "file", "left")
    return found.select("file", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("kind", F.lit("empty")).alias("kind"))


def result_cells(shapes: DataFrame) -> DataFrame:
    """Add the result size and the too-big-to-save flag to (a_rows, b_cols) pairs."""
    cells = F.col("a_rows").cast("bigint") * F.greatest(F.col("b_cols"), F.lit(1))
    return shapes.select("*", cells.alias("cells"), (cells > MAX_SAVED_CELLS).alias("preview_used"))
