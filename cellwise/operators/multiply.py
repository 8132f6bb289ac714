"""Products of a sparse matrix with vectors and matrices.

Each is a join on the inner index, a product, and a sum by output index. The choices
below are about which rows move, and all rest on sizes that are known or measured:

* A side is broadcast only when its row count is proven to fit the session's
  ``spark.sql.autoBroadcastJoinThreshold``. Then nothing is shuffled for the join, and
  a hot inner index stays spread over the tasks that read it.
* A vector beyond that is broadcast as arrays if these fit: they take a sixth of the pairs.
* Otherwise both sides are shuffled on the inner index. For a vector each index meets
  one entry, so a hot column is skew in bytes, which adaptive execution splits. For two
  matrices the work of index k is the product of its two counts, invisible in bytes, so
  :func:`_spread` cuts such an index into a grid of pieces of bounded work.
* Sums combine before their shuffle, and absent rows are filled with zeros inside the
  same sum instead of by a join.
* Where one left cell forms many products, the right matrix is stored as segments: the
  cells of one inner index in one row. The left cells take their segments to the rows of
  the result, and only there the segments are opened, so no product is ever shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.mixing import hashed
from cellwise.model import DenseMatrix, Matrix, Segments, Shape, Vector, drop_zeros, indices
from cellwise.operators.exact import exact_sums
from cellwise.operators.profile import check_multiply, is_sparse, require_sparse_left
from cellwise.session import BYTES_PER_CELL, broadcast_bytes, fits_broadcast, shuffle_partitions, sized

# Most products one piece of an inner index may form, and the side of a square piece.
PIECE_WORK = 1 << 24
PIECE_SIDE = 1 << 12

# Products per left cell from which clustering rows moves clearly less than the products.
ROW_CLUSTER_GAIN = 4

# Products that one task adds up where it has whole rows of the result, about.
TASK_PRODUCTS = 1 << 21

# Products whose segments one task of the join sends on, about.
JOIN_PRODUCTS = 1 << 23

# Cells of one inner index that one segment holds, and columns of a dense panel.
SEGMENT = 4096

# Entries of a vector that travel as one array: two to this power.
PANEL_BITS = 12


def _sized(x: Vector) -> DataFrame:
    """The vector with the join hint its proven size allows."""
    spark = x.df.sparkSession
    if fits_broadcast(spark, x.n):
        return F.broadcast(x.df)
    if x.dense and fits_broadcast(spark, x.n // shuffle_partitions(spark)):
        # Its indices are unique and hash evenly, so one partition fits a hash table and
        # the matrix side needs no sort.
        return x.df.hint("shuffle_hash")
    return x.df


def _fits_panels(spark: SparkSession, n: int) -> bool:
    """Whether n entries fit a broadcast as arrays, a sixth of what they take as pairs."""
    return -(-n >> PANEL_BITS) * (BYTES_PER_CELL + (8 << PANEL_BITS)) <= broadcast_bytes(spark)


def vector_panels(x: Vector) -> DataFrame:
    """The vector as (panel, values): an entry for each index, the sum of repeated ones, NULL where there is none."""
    every = indices(x.df.sparkSession, x.n, "k").withColumn("x", F.lit(None).cast("double"))
    entries = x.df.unionByName(every).groupBy("k").agg(F.sum("x").alias("x"))
    panels = entries.groupBy(F.shiftright("k", PANEL_BITS).alias("panel")).agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("held"))
    return panels.select("panel", F.col("held.x").alias("values"))


def _paneled_products(cells: DataFrame, x: Vector) -> DataFrame:
    """(i, y) of each cell; the cells stay where they are and the vector comes to them in arrays."""
    met = cells.join(F.broadcast(vector_panels(x)), F.shiftright("j", PANEL_BITS) == F.col("panel"))
    at = F.col("j").bitwiseAND(F.lit((1 << PANEL_BITS) - 1)).cast("int")
    return met.select("i", (F.col("v") * F.get("values", at)).alias("y"))


def _row_sums(products: DataFrame, rows: int, zero_fill: bool, exact: bool = False) -> DataFrame:
    if zero_fill:
        zeros = indices(products.sparkSession, rows).withColumn("y", F.lit(0.0))
        products = products.unionByName(zeros)
    if exact:
        return exact_sums(products, ["i"], "y", "x").withColumnRenamed("i", "k")
    return products.groupBy("i").agg(F.sum("y").alias("y")).select(F.col("i").alias("k"), F.col("y").alias("x"))


def spmv(a: Matrix, x: Vector, zero_fill: bool = True, exact: bool = False) -> Vector:
    """y_i = sum over k of A_ik x_k, one entry per row of A.

    With ``zero_fill=False`` only rows that met an entry of x appear. With ``exact=True`` the
    products of a row are added up without rounding, so equal tables give equal bits.
    """
    check_multiply(a.shape, x.n)
    # Rows that exist only because repeated cells cancel would show without zero fill.
    cells = a.summands if zero_fill and not exact else a.df
    spark = x.df.sparkSession
    if zero_fill and not exact and not fits_broadcast(spark, x.n) and _fits_panels(spark, x.n):
        # An index without an entry gives a NULL, which the sums pass over.
        products = _paneled_products(cells, x)
    else:
        products = cells.join(_sized(x), F.col("j") == F.col("k")).select("i", (F.col("v") * F.col("x")).alias("y"))
    return Vector(_row_sums(products, a.shape.rows, zero_fill, exact), a.shape.rows, dense=zero_fill)


def spmspv(a: Matrix, x: Vector, zero_fill: bool = True) -> Vector:
    """The same for a sparse x: its zeros are left out, so the join filters A's columns."""
    return spmv(a, x.to_sparse(), zero_fill)


@dataclass(frozen=True)
class InnerProfile:
    """Counts that decide how a product of two matrices is joined.

    Cells on each side and their greatest number at one inner index, the products in all
    and at the heaviest index, and the cells of the fullest row on the left.
    """

    left: int
    right: int
    left_top: int
    right_top: int
    products: int
    heaviest: int
    fullest_row: int


def inner_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias(name))


def inner_profile(a: Matrix, b: Matrix) -> InnerProfile:
    """Measure the profile in one job.

    Repeated triplets are counted as they stand: every test of the strategy needs upper
    bounds only, and so neither matrix has to be added up for it.
    """
    both = inner_counts(a.summands, "j", "a").join(inner_counts(b.summands, "i", "b"), "k", "full")
    # Counts are multiplied as decimals: two hot sides can exceed BIGINT.
    work = F.coalesce("a", F.lit(0)).cast("decimal(19,0)") * F.coalesce("b", F.lit(0)).cast("decimal(19,0)")
    inner = both.agg(
        F.sum("a").alias("left"),
        F.sum("b").alias("right"),
        F.max("a").alias("left_top"),
        F.max("b").alias("right_top"),
        F.sum(work).alias("products"),
        F.max(work).alias("heaviest"),
    )
    rows = a.summands.groupBy("i").agg(F.count("*").alias("n")).agg(F.max("n").alias("fullest_row"))
    measured: dict[str, int] = {}
    for row in inner.unionByName(rows, allowMissingColumns=True).collect():
        measured |= {name: int(value) for name, value in row.asDict().items() if value is not None}
    return InnerProfile(**{field.name: measured.get(field.name, 0) for field in fields(InnerProfile)})


def spmm_strategy(spark: SparkSession, p: InnerProfile) -> str:
    """How to bring cells with equal inner index together.

    ``broadcast_right`` and ``broadcast_left`` where that side is proven small;
    ``split`` where one index would form more products than one task should; ``segments``
    where a left cell forms several products, no inner index outweighs an average partition
    and no row of the result is more than one task should hold;
    ``hash_right`` and ``hash_left`` where one shuffled partition of that side, its
    fullest index included, fits a hash table; else ``merge``.
    """
    parts = shuffle_partitions(spark)
    if fits_broadcast(spark, p.right):
        return "broadcast_right"
    if fits_broadcast(spark, p.left):
        return "broadcast_left"
    if p.heaviest > PIECE_WORK:
        return "split"
    even = p.left_top * parts <= p.left and p.right_top * parts <= p.right
    if even and p.products > ROW_CLUSTER_GAIN * p.left and p.fullest_row * p.right_top <= PIECE_WORK:
        return "segments"
    if p.right <= p.left and fits_broadcast(spark, p.right // parts + p.right_top):
        return "hash_right"
    if fits_broadcast(spark, p.left // parts + p.left_top):
        return "hash_left"
    return "merge"


def _spread(a: DataFrame, b: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cut heavy inner indices into pieces, giving both sides matching (k, p, q) keys.

    Index k with a left and b right cells becomes a grid of ``p_n`` by ``q_n`` pieces.
    A left cell belongs to one p and is repeated for each q, a right cell the other way
    round, so every pair of cells meets in exactly one piece and no piece forms more
    than about PIECE_WORK products. Indices below that work stay whole and unrepeated.
    """
    side = F.lit(PIECE_SIDE)
    p_n = F.ceil(F.col("a") * F.least(F.col("b"), side) / F.lit(PIECE_WORK))
    q_n = F.ceil(F.col("b") * F.least(F.col("a"), side) / F.lit(PIECE_WORK))
    heavy, _ = sized(counts.select("k", p_n.alias("p_n"), q_n.alias("q_n")).where("p_n > 1 or q_n > 1"))

    def pieces(n: str):
        return F.coalesce(F.col(n), F.lit(1)).cast("bigint")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), pieces(n) - 1))

    left = a.join(heavy, "k", "left").withColumn("p", F.pmod(hashed(F.col("i")), pieces("p_n")))
    right = b.join(heavy, "k", "left").withColumn("q", F.pmod(hashed(F.col("j")), pieces("q_n")))
    return (
        left.withColumn("q", every("q_n")).drop("p_n", "q_n"),
        right.withColumn("p", every("p_n")).drop("p_n", "q_n"),
    )


def _clustered(m: Matrix, key: str, tasks: int | None = None) -> DataFrame:
    """The cells of a matrix, those with one ``key`` together; repeated ones are added up there.

    One shuffle does both, into ``tasks`` partitions if given. Only for keys of bounded counts:
    nothing is combined before it.
    """
    deal = [key] if tasks is None else [tasks, key]
    if m.terms is None:
        return m.df.repartition(*deal)
    return drop_zeros(m.terms.repartition(*deal).groupBy("i", "j").agg(F.sum("v").alias("v")))


def row_segments(b: Matrix, top: int, width: int = SEGMENT, tasks: int | None = None) -> DataFrame:
    """The matrix stored as (k, segment, cells): the (j, b_v) of one row in one array.

    ``top`` bounds the cells of a row. Rows of more than ``width`` cells are cut by column,
    so that no segment holds more than ``width`` of them.
    """
    cell = F.struct("j", F.col("v").alias("b_v"))
    if top <= width:
        rows = _clustered(b, "i", tasks).groupBy(F.col("i").alias("k"))
        return rows.agg(F.collect_list(cell).alias("cells")).select("k", F.lit(0).cast("bigint").alias("segment"), "cells")
    rows = b.df.groupBy(F.col("i").alias("k"), F.expr(f"j div {width}").alias("segment"))
    return rows.agg(F.collect_list(cell).alias("cells"))


_PACKED = ("low", "high", "small", "large")


def _segments_met(a: Matrix, b: Matrix, p: InnerProfile) -> Segments:
    """Each cell of ``a`` with the segments of its inner index.

    A segment takes many times the bytes of the cell that it goes out with. So the tasks of the
    join follow the products, not the bytes that they read, and none writes more as tables grow.
    """
    parts = shuffle_partitions(a.df.sparkSession)
    joins = -(-p.products // JOIN_PRODUCTS)
    joins = max(parts, joins) if joins > 1 else None
    left = _clustered(a, "j", joins).select("i", F.col("j").alias("k"), F.col("v").alias("a_v"))
    right = row_segments(b, p.right_top, tasks=joins).select("k", *packed_cells("cells", b.shape.cols))
    return Segments(left.join(right, "k").drop("k"), -(-p.products // TASK_PRODUCTS))


def packed_cells(cells: str, cols: int) -> list[Column]:
    """An array of cells (j, b_v) as arrays of plain numbers of few bytes: low, high, small, large.

    A column index is its lowest two bytes and the rest. Values are in ``small`` if all of them
    are whole numbers of two bytes, and in ``large`` if not; the other one is NULL.
    """
    rest = "tinyint" if cols <= 1 << 23 else "int" if cols <= 1 << 47 else "bigint"
    js, vs = F.array_sort(cells)["j"], F.array_sort(cells)["b_v"]
    whole = F.coalesce(F.forall(vs, lambda v: (F.abs(v) <= 32767) & (F.floor(v) == v)), F.lit(False))
    return [
        F.transform(js, lambda j: (j.bitwiseAND(F.lit(65535)) - 32768).cast("smallint")).alias("low"),
        F.transform(js, lambda j: F.shiftright(j, 16).cast(rest)).alias("high"),
        F.when(whole, F.transform(vs, lambda v: v.cast("smallint"))).alias("small"),
        F.when(~whole, vs).alias("large"),
    ]


def gathered(segments: Segments, tasks: int = 0, markers: DataFrame | None = None) -> DataFrame:
    """The cells (i, j, v) of the products, whole rows in one partition and known to be.

    There are as many partitions as it takes to add up the products of each in memory, or
    ``tasks`` if that is more. ``markers`` (i, j) are cells that come out too, with a NULL
    value where there is no product.
    """
    parts = shuffle_partitions(segments.df.sparkSession)
    tasks = max(tasks, segments.tasks)
    met = segments.df
    if markers is not None:
        cell = F.array(F.struct("j", F.lit(None).cast("double").alias("b_v"))).alias("cells")
        bare = markers.select("i", F.lit(None).cast("double").alias("a_v"), cell)
        met = met.unionByName(bare.select("i", "a_v", *[c.cast(met.schema[n].dataType).alias(n) for n, c in zip(_PACKED, packed_cells("cells", 1 << 62), strict=True)]))
    met = met.repartition(tasks, "i") if tasks > parts else met.repartition("i")
    b_v = F.coalesce(F.col("small").cast("array<double>"), F.col("large"))
    opened = met.select("i", "a_v", "low", "high", b_v.alias("b_v")).select("i", "a_v", F.inline(F.arrays_zip("low", "high", "b_v")))
    j = F.shiftleft(F.col("high").cast("bigint"), 16) + F.col("low") + 32768
    return _cell_sums(opened.select("i", "a_v", j.alias("j"), "b_v"))


def _segment_product(a: Matrix, b: Matrix, p: InnerProfile) -> DataFrame:
    """Cells of the product: segments travel to the rows of ``a`` and are opened there."""
    return gathered(_segments_met(a, b, p))


def _cell_sums(joined: DataFrame) -> DataFrame:
    return joined.groupBy("i", "j").agg(F.sum(F.col("a_v") * F.col("b_v")).alias("v"))


def spmm(a: Matrix, b: Matrix, profile: InnerProfile | None = None) -> Matrix:
    """C_ij = sum over k of A_ik B_kj, for the cells where at least one k meets.

    Sums that cancel to zero stay as stored zeros. The profile is measured unless given.
    """
    check_multiply(a.shape, b.shape)
    spark = a.df.sparkSession
    p = profile or inner_profile(a, b)
    strategy = spmm_strategy(spark, p)
    if strategy == "segments":
        met = _segments_met(a, b, p)
        return Matrix(gathered(met), Shape(a.shape.rows, b.shape.cols), segments=met)
    left = a.df.select("i", F.col("j").alias("k"), F.col("v").alias("a_v"))
    right = b.df.select(F.col("i").alias("k"), "j", F.col("v").alias("b_v"))
    keys = ["k"]
    if strategy == "broadcast_right":
        right = F.broadcast(right)
        if p.products > ROW_CLUSTER_GAIN * p.left and p.fullest_row * shuffle_partitions(spark) <= p.left:
            # Whole rows in one task: the cells of A move instead of their many products,
            # and the sums need no shuffle. Only where no row outweighs a partition.
            left = left.repartition("i")
    elif strategy == "broadcast_left":
        left = F.broadcast(left)
    elif strategy == "split":
        counts = inner_counts(a.summands, "j", "a").join(inner_counts(b.summands, "i", "b"), "k")
        left, right = _spread(left, right, counts)
        keys = ["k", "p", "q"]
    elif strategy == "hash_right":
        right = right.hint("shuffle_hash")
    elif strategy == "hash_left":
        left = left.hint("shuffle_hash")
    return Matrix(_cell_sums(left.join(right, keys)), Shape(a.shape.rows, b.shape.cols))


def dense_panels(b: DenseMatrix, width: int = SEGMENT) -> DataFrame:
    """The matrix stored as (k, first, values): its rows cut into panels of ``width`` columns."""
    if b.shape.cols <= width:
        return b.df.select("k", F.lit(0).cast("bigint").alias("first"), F.col("row").alias("values"))
    firsts = F.sequence(F.lit(0).cast("bigint"), F.lit(b.shape.cols - 1).cast("bigint"), F.lit(width).cast("bigint"))
    cut = b.df.select("k", "row", F.explode(firsts).alias("first"))
    return cut.select("k", "first", F.slice("row", (F.col("first") + 1).cast("int"), width).alias("values"))


def spdm(a: Matrix, b: DenseMatrix) -> Matrix:
    """The same for a dense B, whose zeros take part and give stored zeros.

    B's rows travel as panels, one row for each panel of an inner index. Where no row of the
    result is more than one task should hold, the left cells bring their panels to it and
    these are opened there, so that no product is shuffled; else products are added up
    before they move.
    """
    check_multiply(a.shape, b.shape)
    spark = a.df.sparkSession
    left = a.df.select("i", F.col("j").alias("k"), F.col("v").alias("a_v"))
    right = dense_panels(b)
    keys = ["k"]
    width = max(1, b.shape.cols)
    fullest, busiest, cells = _left_counts(a)
    gather = fullest * width <= PIECE_WORK and fullest * shuffle_partitions(spark) <= cells
    if fits_broadcast(spark, b.shape.rows, BYTES_PER_CELL + 8 * b.shape.cols):
        right = F.broadcast(right)
        left = left.repartition("i") if gather else left
    elif busiest * width > PIECE_WORK:
        # One right row per index: cut the left side where its count times B's width is heavy.
        limit = max(1, PIECE_WORK // width)
        counts = inner_counts(a.df, "j", "a").where(F.col("a") > limit)
        heavy, _ = sized(counts.select("k", F.ceil(F.col("a") / F.lit(limit)).alias("p_n")))
        p_n = F.coalesce(F.col("p_n"), F.lit(1)).cast("bigint")
        left = left.join(heavy, "k", "left").withColumn("p", F.pmod(hashed(F.col("i")), p_n)).drop("p_n")
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), p_n - 1))
        right = right.join(heavy, "k", "left").withColumn("p", every).drop("p_n")
        keys = ["k", "p"]
    met = left.join(right, keys).select("i", "a_v", "first", "values")
    if gather and not fits_broadcast(spark, b.shape.rows, BYTES_PER_CELL + 8 * b.shape.cols):
        met = met.repartition("i")
    opened = met.select("i", "a_v", "first", F.posexplode("values").alias("at", "b_v"))
    return Matrix(_cell_sums(opened.withColumn("j", F.col("first") + F.col("at"))), Shape(a.shape.rows, b.shape.cols))


def _left_counts(a: Matrix) -> tuple[int, int, int]:
    """Upper bounds on the cells of the fullest row and of the fullest column, and on all cells."""
    found = [0, 0, 0]
    by = [a.summands.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n")).agg(F.max("n").alias("top"), F.sum("n").alias("cells")).withColumn("side", F.lit(side)) for side, key in enumerate("ij")]
    for row in by[0].unionByName(by[1]).collect():
        found[row["side"]] = row["top"] or 0
        found[2] = row["cells"] or 0
    return found[0], found[1], found[2]


def multiply(
    a: Matrix, b: Matrix | DenseMatrix | Vector, require_sparse_left_operand: bool = True
) -> Vector | Matrix:
    """A times whatever is on the right, by the kernel that fits it.

    A one-column right side is a vector. One row as long as A is wide is a vector lying
    on its side. Everything else must have as many rows as A has columns.
    """
    if a.shape.rows == 0:
        raise ValueError("the left operand is empty")
    if require_sparse_left_operand:
        require_sparse_left(a)
    if isinstance(b, Vector):
        return spmspv(a, b) if is_sparse(b) else spmv(a, b)
    if b.shape.rows == 0:
        return Matrix(a.df.limit(0), Shape(0, 0))
    lying = b.shape.rows == 1 and b.shape.cols == a.shape.cols and a.shape.cols != 1
    if b.shape.cols == 1 or lying:
        cells = b.cells() if isinstance(b, DenseMatrix) else b.df
        index = "j" if lying else "i"
        length = b.shape.cols if lying else b.shape.rows
        x = Vector(cells.select(F.col(index).alias("k"), F.col("v").alias("x")), length, isinstance(b, DenseMatrix), b.nonzeros)
        return spmspv(a, x) if is_sparse(x) else spmv(a, x)
    if isinstance(b, DenseMatrix):
        return spdm(a, b)
    return spmm(a, b)


def multiply_text(
    spark: SparkSession, left: str, right: str, require_sparse_left_operand: bool = True
) -> Vector | Matrix:
    """Multiply two text grids. The right one is kept dense when it is not sparse.

    Each file is scanned twice: once to count and measure it, once for the product.
    """
    from cellwise.sources.text import read_dense, read_grid

    a = read_grid(spark, left)
    b = read_dense(spark, right)
    return multiply(a, b.to_sparse() if is_sparse(b) else b, require_sparse_left_operand)


def multiply_text_lenient(spark: SparkSession, left: str, right: str, vector: bool) -> Vector | Matrix:
    """Multiply lenient text: tokens that are no number are skipped, no operand is refused.

    ``vector`` says that the right file is a vector, lying or standing; then only rows that
    met an entry of it come out, zeros of the file being entries. A right matrix may have more
    or fewer rows than the left has columns: what has no counterpart forms no product.
    """
    from cellwise.sources.text import read_grid, read_vector

    a = read_grid(spark, left, "lenient")
    if vector:
        x = read_vector(spark, right, first_line_only=True)
        return spmv(Matrix(a.df, Shape(a.shape.rows, x.n)), x, zero_fill=False)
    b = read_grid(spark, right, "lenient")
    inner = max(a.shape.cols, b.shape.rows)
    return spmm(Matrix(a.df, Shape(a.shape.rows, inner)), Matrix(b.df, Shape(inner, b.shape.cols)))
