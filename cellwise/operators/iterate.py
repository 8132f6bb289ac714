"""Damped power iteration and the vector norms it uses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.mixing import hashed
from cellwise.model import Matrix, Vector, indices
from cellwise.operators.exact import exact_sums
from cellwise.operators.multiply import _row_sums, inner_counts, spmv
from cellwise.session import BYTES_PER_CELL, broadcast_bytes, durable, fits_broadcast, shuffle_partitions, sized

# Cells of one column kept together when a matrix is laid out for repeated use.
COLUMN_PIECE = 1 << 20

# Cells that one partition of such a layout holds, about.
PARTITION_CELLS = 1 << 23


def l1_norm(x: Vector, exact: bool = False) -> DataFrame:
    """One row: the sum of absolute values, with 0 replaced by 1; ``exact`` adds without rounding."""
    sums = x.df.agg(F.sum(F.abs("x")).alias("total"))
    if exact:
        sums = exact_sums(x.df.select(F.abs("x").alias("x")), [], "x")
    total = F.coalesce("total", F.lit(0.0))
    return sums.select(F.when(total == 0, F.lit(1.0)).otherwise(total).alias("norm"))


def l1_distance(a: Vector, b: Vector) -> DataFrame:
    """One row: the sum of absolute differences; an index missing on one side is zero there.

    Both sides are added up under one key instead of joined, so neither has to be
    sorted and the sums combine before their only shuffle.
    """
    if a.n != b.n:
        raise ValueError(f"vectors of {a.n} and {b.n} entries have no distance")
    signed = a.df.select("k", "x").unionByName(b.df.select("k", (-F.col("x")).alias("x")))
    gaps = signed.groupBy("k").agg(F.abs(F.sum("x")).alias("gap"))
    return gaps.agg(F.coalesce(F.sum("gap"), F.lit(0.0)).alias("distance"))


@dataclass(frozen=True)
class Iterated:
    """``history`` is (step, norm, residual) of all steps, where a state folder keeps them."""

    vector: Vector
    residual: float
    steps: int
    history: DataFrame | None = None


class _State:
    """The last two products y of an iteration, and a row of ``steps`` for each complete step.

    Products take turns between two tables, so the one before is whole while the next is
    written, and no older one is left. The row of a step is appended last and names the
    table of its product: what has no row did not happen.
    """

    SCHEMA = "step int, norm double, residual double, place int, n bigint, alpha double"

    def __init__(self, spark: SparkSession, folder: str, n: int, alpha: float):
        self.spark, self.folder, self.n, self.alpha = spark, folder.rstrip("/"), n, alpha

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.folder}/steps")

    def last(self) -> Row | None:
        try:
            last = self.rows().orderBy(F.desc("step")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if last and (last.n, last.alpha) != (self.n, self.alpha):
            raise ValueError(f"the state is of {last.n} entries and alpha {last.alpha}, not {self.n} and {self.alpha}")
        return last

    def read(self, place: int) -> DataFrame:
        return self.spark.read.schema("k bigint, x double").parquet(f"{self.folder}/product-{place}")

    def write(self, y: DataFrame, place: int) -> DataFrame:
        y.write.mode("overwrite").parquet(f"{self.folder}/product-{place}")
        return self.read(place)

    def complete(self, step: int, norm: float, residual: float, place: int) -> None:
        row = [(step, norm, residual, place, self.n, self.alpha)]
        self.spark.createDataFrame(row, self.SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/steps")

    def history(self) -> DataFrame:
        return self.rows().select("step", "norm", "residual")


class _ColumnLayout:
    """A matrix shuffled by column once, so that later steps move only vectors.

    A column with more than COLUMN_PIECE cells is cut into pieces by row, each a key of
    its own; the vector entry is repeated for them. The cached partitions are hashed on
    (k, p), which is the join key, so the matrix is neither shuffled nor sorted again,
    and no partition holds more of a hot column than one piece.
    """

    def __init__(self, a: Matrix, persist: bool = True):
        self.shape = a.shape
        # Counted and laid out: what is costly to derive is derived once.
        self.source = a.df.persist() if persist else None
        columns = inner_counts(a.df, "j", "a").agg(
            F.sum("a").alias("cells"), F.count(F.when(F.col("a") > COLUMN_PIECE, 1)).alias("heavy")
        ).first()
        self.parts = self._partitions(a, columns.cells or 0)
        counts = inner_counts(a.df, "j", "a").where(F.col("a") > COLUMN_PIECE)
        if not columns.heavy:
            counts = counts.limit(0)
        self.heavy, self.heavy_columns = sized(
            counts.select("k", F.ceil(F.col("a") / F.lit(COLUMN_PIECE)).cast("bigint").alias("p_n"))
        )
        piece = F.pmod(hashed(F.col("i")), F.coalesce(F.col("p_n"), F.lit(1)))
        cells = self._with_pieces(a.df.withColumnRenamed("j", "k")).select("i", "k", piece.alias("p"), "v")
        self.cells = cells.repartition(self.parts, "k", "p").persist()

    @staticmethod
    def _partitions(a: Matrix, cells: int) -> int:
        """As few partitions as keep all cores busy and the work of one bounded.

        A step shuffles one sum for each row that a partition has cells of. The fewer the
        partitions, the more products are added up before they move.
        """
        spark = a.df.sparkSession
        most = shuffle_partitions(spark)
        table = broadcast_bytes(spark) // BYTES_PER_CELL
        entries = -(-a.shape.cols // table) if table else most
        return max(min(most, max(spark.sparkContext.defaultParallelism, entries)), -(-cells // PARTITION_CELLS))

    def _with_pieces(self, df: DataFrame) -> DataFrame:
        """Add p_n, the pieces of a heavy column k; NULL for one left whole."""
        if not self.heavy_columns:
            return df.withColumn("p_n", F.lit(None).cast("bigint"))
        return df.join(self.heavy, "k", "left")

    def times(self, x: Vector) -> DataFrame:
        last = F.coalesce(F.col("p_n"), F.lit(1)) - 1
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
        entries = self._with_pieces(x.df).select("k", every.alias("p"), "x")
        entries = entries.repartition(self.parts, "k", "p")
        if fits_broadcast(x.df.sparkSession, x.n // self.parts):
            entries = entries.hint("shuffle_hash")
        met = self.cells.join(entries, ["k", "p"])
        return _row_sums(met.select("i", (F.col("v") * F.col("x")).alias("y")), self.shape.rows, True)

    def release(self) -> None:
        self.cells.unpersist()
        if self.source is not None:
            self.source.unpersist()


def power_iteration(
    a: Matrix,
    steps: int = 20,
    alpha: float = 0.85,
    layout: bool | None = None,
    persist: bool = True,
    state: str | None = None,
) -> Iterated:
    """v' = alpha * y / |y| + (1 - alpha) / N with y = A v, |y| the L1 norm or 1 if zero.

    Starts from 1/N and runs exactly ``steps`` rounds. Each round writes y to durable
    storage once, which keeps the plan of a round the size of one product however many
    rounds ran, and survives the loss of executors. The driver sees two numbers a round.

    The matrix is laid out by column once when the vector is too large to broadcast
    (``layout=None`` decides by its length). Otherwise its cells are kept for the rounds
    as they are; ``persist=False`` reads them anew each time, which suits a plain table.

    ``state`` names a folder in shared storage that survives the driver too: it keeps the
    last two products and the norm and residual of each step. A call with the folder of an
    earlier one goes on after its last complete step, and runs nothing if that is ``steps``.
    The caller vouches for the same matrix; size and alpha are compared. One run may use
    a folder at a time. The vector of a result is read from there, so it is to be used before
    a later call goes further.
    """
    if a.shape.rows != a.shape.cols:
        raise ValueError(f"power iteration needs a square matrix, not {a.shape}")
    n = a.shape.cols
    spark = a.df.sparkSession
    kept_state = _State(spark, state, n, alpha) if state else None
    last = kept_state.last() if kept_state else None
    done = last.step if last else 0
    if done > steps:
        raise ValueError(f"the state has {done} steps, more than {steps}")

    def damped(y: DataFrame, norm: float) -> Vector:
        scaled = F.lit(alpha) * (F.col("x") / F.lit(norm)) + F.lit((1.0 - alpha) / n)
        return Vector(y.select("k", scaled.alias("x")), n, dense=True)

    if last:
        v, residual = damped(kept_state.read(last.place), last.norm), last.residual
    else:
        v, residual = Vector(indices(spark, n, "k").withColumn("x", F.lit(1.0 / n)), n, dense=True), 0.0
    if layout is None:
        layout = not fits_broadcast(spark, n)
    running = done < steps
    laid_out = _ColumnLayout(a, persist) if layout and running else None
    kept = a.df.persist() if persist and running and not layout else None
    cells = a if kept is None else Matrix(kept, a.shape)
    try:
        for step in range(done + 1, steps + 1):
            product = laid_out.times(v) if laid_out else spmv(cells, v).df
            y = kept_state.write(product, step % 2) if kept_state else durable(product)
            norm = l1_norm(Vector(y, n, dense=True)).first().norm
            previous, v = v, damped(y, norm)
            if kept_state or step == steps:
                residual = l1_distance(v, previous).first().distance
            if kept_state:
                kept_state.complete(step, norm, residual, step % 2)
    finally:
        if laid_out:
            laid_out.release()
        if kept is not None:
            kept.unpersist()
    history = kept_state.history() if kept_state and steps else None
    return Iterated(v, residual, steps, history)
