"""Queries over the test tables, one for each operator.

Matrices are views of the tables: orders by parts, parts by suppliers and so on. All
dimensions come from the tables, so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import cellwise as cw
from cellwise.model import DenseMatrix, Matrix, Shape, Vector
from cellwise.operators import layout, profile
from cellwise.operators.exact import exact_sums
from cellwise.operators.multiply import multiply, multiply_text, multiply_text_lenient
from cellwise.plans import benchstats
from cellwise.session import durable, scratch_path
from cellwise.sources import generate, text

Query = Callable[[SparkSession, str], DataFrame]

POWER_STEPS = 20
SEGMENT = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Tables:
    """The test tables of one folder and the matrices seen in them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        self.__dict__[name] = table(self.spark, self.folder, name)
        return self.__dict__[name]

    @cache
    def size(self, name: str) -> int:
        return getattr(self, name).count()

    def order_part(self) -> Matrix:
        shape = Shape(self.size("orders"), self.size("part"))
        return cw.coo_from_table(self.lineitem, "l_orderkey", "l_partkey", "l_quantity", shape)

    def part_supplier(self) -> Matrix:
        shape = Shape(self.size("part"), self.size("supplier"))
        return cw.coo_from_table(self.lineitem, "l_partkey", "l_suppkey", "l_quantity", shape)

    def customer_nation(self) -> Matrix:
        shape = Shape(self.size("customer"), self.size("nation"))
        ones = self.customer.withColumn("one", F.lit(1.0))
        return cw.coo_from_table(ones, "c_custkey", "c_nationkey", "one", shape, duplicates="none")

    def sizes(self) -> Vector:
        return cw.vector_from_table(self.part, "p_partkey", "p_size", self.size("part"), dense=True, duplicates="none")

    def branded_sizes(self) -> Vector:
        branded = self.part.where("p_brand = 'Brand#2'")
        return cw.vector_from_table(branded, "p_partkey", "p_size", self.size("part"), duplicates="none")

    def balances(self) -> Vector:
        whole = self.supplier.withColumn("whole", F.floor("s_acctbal"))
        return cw.vector_from_table(whole, "s_suppkey", "whole", self.size("supplier"), dense=True, duplicates="none")

    def label_indicator(self) -> Matrix:
        labels, n = self.embeddings.agg(F.max("label") + 1, F.count("*")).first()
        ones = self.embeddings.select("label", "vec_id", F.lit(1.0).alias("one"))
        return cw.coo_from_table(ones, "label", "vec_id", "one", Shape(labels, n), duplicates="none")

    def embedding_rows(self) -> DenseMatrix:
        rows = self.embeddings.select(F.col("vec_id").alias("k"), F.col("embedding").cast("array<double>").alias("row"))
        n, width = rows.agg(F.count("*"), F.max(F.size("row"))).first()
        return DenseMatrix(rows, Shape(n, width))

    def part_graph(self) -> Matrix:
        """Part t follows part f in an order; each column f adds up to 1."""
        lines = self.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
        at = lines.groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.count("*").alias("c"))
        here = at.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("f"), F.col("c").alias("c_f"))
        there = at.select(
            "l_orderkey",
            (F.col("l_linenumber") - 1).alias("l_linenumber"),
            F.col("l_partkey").alias("t"),
            F.col("c").alias("c_t"),
        )
        edges = (
            here.join(there, ["l_orderkey", "l_linenumber"]).groupBy("f", "t").agg(F.sum(F.col("c_f") * F.col("c_t")).alias("w"))
        )
        leaving = edges.groupBy("f").agg(F.sum("w").alias("out"))
        weights = edges.join(leaving, "f").select("t", "f", (F.col("w") / F.col("out")).alias("v"))
        n = self.size("part")
        return cw.coo_from_table(weights, "t", "f", "v", Shape(n, n), duplicates="none")

    def event_grid(self) -> Matrix:
        cells = (
            self.events.select((F.col("user_id") % 7).alias("i"), (F.col("event_id") % 5).alias("j"))
            .groupBy("i", "j")
            .agg(F.count("*").alias("v"))
        )
        # One row and one column wider than the cells, so that both have an empty one.
        return cw.coo_from_table(cells, "i", "j", "v", Shape(8, 6), duplicates="none")

    def mixed_lines(self) -> DataFrame:
        """Lines some of which hold a brand name or an empty token."""
        return self.part.selectExpr(
            "p_partkey as row",
            """concat_ws(',', string(p_size), string(p_partkey % 3),
               case when p_partkey % 7 = 0 then p_brand when p_partkey % 5 = 0 then ''
                    else string(int(floor(p_retailprice))) end, '0') as value""",
        )

    def number_lines(self) -> DataFrame:
        return self.part.selectExpr(
            "p_partkey as row",
            "concat_ws(',', string(p_size), string(p_partkey % 3), '0', string(p_partkey % 4)) as value",
        )

    def written_lines(self, name: str) -> str:
        """The number lines as text files, in key order."""
        path = scratch_path(self.spark, name)
        self.number_lines().orderBy("row").select("value").write.text(path)
        return path


def _rounded(x: Vector, digits: int) -> DataFrame:
    return x.df.select("k", F.round("x", digits).alias("x"))


def spmv(t: Tables) -> DataFrame:
    return cw.spmv(t.order_part(), t.sizes()).df


def spmspv(t: Tables) -> DataFrame:
    return cw.spmspv(t.order_part(), t.branded_sizes()).df


def kernel_only(t: Tables) -> DataFrame:
    return cw.spmspv(t.order_part(), t.branded_sizes(), zero_fill=False).df


def spmm(t: Tables) -> DataFrame:
    return cw.spmm(t.order_part(), t.part_supplier()).df


def spdm(t: Tables) -> DataFrame:
    product = cw.spdm(t.label_indicator(), t.embedding_rows())
    return product.df.select("i", "j", F.round("v", 6).alias("v"))


def multiply_dispatch(t: Tables) -> DataFrame:
    return multiply(t.order_part(), t.branded_sizes()).df


def multiply_to_text(t: Tables) -> DataFrame:
    b = t.part_supplier()
    return cw.dense_rows(cw.spmm(b.transposed, b))


def multiply_files(t: Tables) -> DataFrame:
    left, right = scratch_path(t.spark, "left"), scratch_path(t.spark, "right")
    layout.write_matrix_text(t.customer_nation(), left)
    regions = cw.vector_from_table(t.nation, "n_nationkey", "n_regionkey", t.size("nation"), dense=True, duplicates="none")
    layout.write_vector_text(regions, right)
    return multiply_text(t.spark, left, right).df


def _customer_text_times(t: Tables, right: Matrix) -> Vector | Matrix:
    """Customers by nations times a small matrix, both read back from text."""
    paths = scratch_path(t.spark, "left"), scratch_path(t.spark, "right")
    layout.write_matrix_text(t.customer_nation(), paths[0])
    layout.write_matrix_text(right, paths[1])
    return multiply_text(t.spark, *paths)


def multiply_text_sparse(t: Tables) -> DataFrame:
    ones = t.nation.withColumn("one", F.lit(1.0))
    shape = Shape(t.size("nation"), t.size("region"))
    return _customer_text_times(t, cw.coo_from_table(ones, "n_nationkey", "n_regionkey", "one", shape)).df


def multiply_text_dense(t: Tables) -> DataFrame:
    cells = t.nation.select(
        "n_nationkey", F.posexplode(F.array(F.col("n_nationkey") + 1, F.col("n_regionkey") + 1)).alias("j", "v")
    )
    return _customer_text_times(t, cw.coo_from_table(cells, "n_nationkey", "j", "v", Shape(t.size("nation"), 2))).df


def multiply_text_row(t: Tables) -> DataFrame:
    cells = t.nation.select(F.lit(0).alias("i"), "n_nationkey", "n_regionkey")
    return _customer_text_times(t, cw.coo_from_table(cells, "i", "n_nationkey", "n_regionkey", Shape(1, t.size("nation")))).df


def _lenient_parts(t: Tables) -> str:
    """Part lines as text: a token that is no number, and an empty one that later tokens pass."""
    path = scratch_path(t.spark, "lenient")
    line = "concat_ws(',', string(p_size), 'x', string(p_partkey % 7), '', string(p_partkey % 3)) as value"
    t.part.orderBy("p_partkey").selectExpr(line).write.text(path)
    return path


def _region_lines(t: Tables, line: str) -> str:
    path = scratch_path(t.spark, "regions")
    t.region.coalesce(1).orderBy("r_regionkey").selectExpr(f"{line} as value").write.text(path)
    return path


def multiply_text_lenient_vector(t: Tables) -> DataFrame:
    """Lenient lines times a standing vector of five numbers, the third of them none."""
    right = _region_lines(t, "case when r_regionkey = 2 then 'none' else string(r_regionkey + 1) end")
    return multiply_text_lenient(t.spark, _lenient_parts(t), right, vector=True).df


def multiply_text_lenient_matrix(t: Tables) -> DataFrame:
    """Lenient lines times a matrix with more rows than they have columns, and a word in it."""
    right = _region_lines(t, "concat_ws(',', string(r_regionkey + 1), 'word', string(r_regionkey * 2))")
    return multiply_text_lenient(t.spark, _lenient_parts(t), right, vector=False).df


def spmv_repeated_keys(t: Tables) -> DataFrame:
    """Against the quantity of each part, which the vector adds up over its lines."""
    x = cw.vector_from_table(t.lineitem, "l_partkey", "l_quantity", t.size("part"))
    return cw.spmv(t.part_supplier().transposed, x).df


def power_iteration(t: Tables) -> DataFrame:
    return _rounded(cw.power_iteration(t.part_graph(), steps=POWER_STEPS).vector, 9)


def power_iteration_laid_out(t: Tables) -> DataFrame:
    return _rounded(cw.power_iteration(t.part_graph(), steps=POWER_STEPS, layout=True).vector, 9)


def power_residual(t: Tables) -> DataFrame:
    found = cw.power_iteration(t.part_graph(), steps=POWER_STEPS)
    return t.spark.range(1).select(F.lit(found.steps).alias("steps"), F.round(F.lit(found.residual), 9).alias("residual"))


def power_history(t: Tables) -> DataFrame:
    """Norm and residual of all steps: five in a first call, the others in one that goes on from its state."""
    graph, state = t.part_graph(), scratch_path(t.spark, "power")
    # Both calls read the graph from storage.
    graph = Matrix(durable(graph.df), graph.shape)
    cw.power_iteration(graph, steps=5, state=state)
    found = cw.power_iteration(graph, steps=POWER_STEPS, state=state)
    return found.history.select("step", F.round("norm", 9).alias("norm"), F.round("residual", 9).alias("residual"))


def spmv_exact(t: Tables) -> DataFrame:
    """Orders times part prices, to the last bit."""
    prices = cw.vector_from_table(t.part, "p_partkey", "p_retailprice", t.size("part"), dense=True, duplicates="none")
    return cw.spmv(t.order_part(), prices, exact=True).df


def exact_totals(t: Tables) -> DataFrame:
    return exact_sums(t.events, ["event_type"], "value")


def l1_norm(t: Tables) -> DataFrame:
    return cw.l1_norm(t.sizes())


def l1_distance(t: Tables) -> DataFrame:
    prices = t.part.withColumn("whole", F.floor("p_retailprice"))
    return cw.l1_distance(t.sizes(), cw.vector_from_table(prices, "p_partkey", "whole", t.size("part"), dense=True, duplicates="none"))


def dense_rows(t: Tables) -> DataFrame:
    return cw.dense_rows(t.event_grid())


def dense_segments(t: Tables) -> DataFrame:
    return cw.dense_rows(t.part_supplier().transposed, width=SEGMENT)


def vector_line(t: Tables) -> DataFrame:
    return cw.vector_line(cw.spmv(t.order_part(), t.sizes()), width=SEGMENT)


def preview(t: Tables) -> DataFrame:
    return cw.preview(t.part_supplier())


def glance(t: Tables) -> DataFrame:
    return cw.glance(t.part_supplier())


def checksum(t: Tables) -> DataFrame:
    return cw.checksum(cw.spmv(t.order_part(), t.sizes()), width=SEGMENT)


def coo_from_table(t: Tables) -> DataFrame:
    return t.order_part().df


def by_row(t: Tables) -> DataFrame:
    return cw.by_row(t.part_supplier())


def by_col(t: Tables) -> DataFrame:
    return cw.by_col(t.part_supplier())


def sparsity(t: Tables) -> DataFrame:
    return profile.value_sparsity(t.lineitem, "l_tax")


def line_sparsity(t: Tables) -> DataFrame:
    return profile.line_sparsity(t.mixed_lines())


def matrix_sparsity(t: Tables) -> DataFrame:
    return profile.matrix_sparsity(t.order_part())


def shape_profile(t: Tables) -> DataFrame:
    return profile.shape_profile(t.mixed_lines())


def vector_class(t: Tables) -> DataFrame:
    """Part lines dealt out to as many pretended files as there are hundreds of parts."""
    files = max(1, t.size("part") // 40)
    lines = t.part.selectExpr(
        f"p_partkey % {files} as file",
        f"""case when p_partkey % {files} % 4 = 0 then string(p_size)
                 when p_partkey % {files} % 4 = 1 then concat(string(p_size), ',', string(p_partkey))
                 when p_partkey % {files} % 4 = 2 and p_partkey >= {files} then null
                 when p_partkey % {files} % 8 = 2 then concat(string(p_size), ',7')
                 when p_partkey % {files} % 4 = 2 then concat(p_brand, ',7')
                 when p_partkey >= {files} then p_brand else string(p_size) end as value""",
    ).where("value is not null")
    return profile.classify_vector_files(lines)


def vector_files(t: Tables) -> DataFrame:
    """Orders dealt out to real text files by customer modulo 40, beside an empty file."""
    path = scratch_path(t.spark, "vectors")
    lines = t.orders.where("o_custkey % 4 < 3").selectExpr(
        "o_custkey % 40 as file",
        """case when o_custkey % 4 = 0 then string(o_orderkey) when o_custkey % 4 = 1 then concat(o_orderkey, ',', o_custkey)
                else concat(o_orderpriority, ',', o_orderkey) end as value""",
    )
    lines.repartition("file").write.partitionBy("file").text(path)
    t.spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/file=none")
    # One folder a file in spirit: the parts of a folder are classified together.
    name = F.regexp_extract("file", "file=([^/]*)", 1)
    return profile.classify_text_files(t.spark, f"{path}/*/part-*").select(name.alias("file"), "lines", "kind")


def result_cells(t: Tables) -> DataFrame:
    shapes = t.part.selectExpr("p_partkey", "p_partkey * 100 as a_rows", "p_size - 1 as b_cols")
    return profile.result_cells(shapes)


def numeric_lines(t: Tables) -> DataFrame:
    return text.numeric_lines(t.mixed_lines())


def lenient_coo(t: Tables) -> DataFrame:
    return text.lenient_cells(t.mixed_lines())


def grid_to_coo(t: Tables) -> DataFrame:
    return text.strict_cells(t.number_lines())


def normalize_text(t: Tables) -> DataFrame:
    padded = t.part.selectExpr(
        "p_partkey", r"concat('  ', p_name, '   ', p_type, ' \r\n \n', string(p_size), '\t', p_brand, ' ') as raw"
    )
    return text.normalize_text(padded, "p_partkey", "raw")


def normalize_invisible(t: Tables) -> DataFrame:
    """Every invisible character that is removed, between words, in words and at both ends."""
    pasted = F.concat(
        F.lit("\ufeff "), "p_name", F.lit("\u200b"), "p_type", F.lit("\u00a0 \u2060\t"), "p_brand",
        F.lit("\u202a\u202b"), "p_size", F.lit(" \u202c\u202d\u202e\n\u00a0\n"),
    )
    return text.normalize_text(t.part.select("p_partkey", pasted.alias("raw")), "p_partkey", "raw")


def read_lines(t: Tables) -> DataFrame:
    return text.read_lines(t.spark, t.written_lines("lines"))


def read_grid(t: Tables) -> DataFrame:
    return text.read_grid(t.spark, t.written_lines("grid")).df


def read_dense(t: Tables) -> DataFrame:
    return text.read_dense(t.spark, t.written_lines("dense")).cells()


def read_column_vector(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "column")
    layout.write_vector_text(t.sizes(), path)
    return text.read_vector(t.spark, path).df


def read_row_vector(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "row")
    layout.write_vector_text(t.balances(), path, as_column=False)
    return text.read_vector(t.spark, path, sparse=True).df


def read_sparse_column(t: Tables) -> DataFrame:
    """A strict column of numbers, zeros among them, and of lines that are none and do not count."""
    path = scratch_path(t.spark, "sparse-column")
    line = "case when p_partkey % 7 = 3 then p_brand when p_partkey % 3 = 0 then '0' else string(p_retailprice) end as value"
    t.part.orderBy("p_partkey").selectExpr(line).write.text(path)
    return text.read_vector(t.spark, path, orientation="column", mode="strict", sparse=True).df


def nearest_rank(t: Tables) -> DataFrame:
    return benchstats.nearest_rank(t.events, ["event_type"], "value", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


def trial_stats(t: Tables) -> DataFrame:
    stats = benchstats.trial_summary(t.events, ["event_type"], "value")
    return stats.withColumn("std", F.round("std", 6))


def _partly_unnamed(t: Tables) -> DataFrame:
    return t.events.withColumn("name", F.when(F.col("user_id") % 10 != 0, F.col("event_type")))


def nearest_rank_null_keys(t: Tables) -> DataFrame:
    return benchstats.nearest_rank(_partly_unnamed(t), ["name"], "value", {"p50": 0.5, "p90": 0.9})


def trial_stats_null_keys(t: Tables) -> DataFrame:
    return benchstats.trial_summary(_partly_unnamed(t), ["name"], "value").withColumn("std", F.round("std", 6))


def merge_summaries(t: Tables) -> DataFrame:
    named = t.events.select(
        F.col("event_type").alias("name"),
        benchstats.ablation_label(
            F.when(F.col("user_id") % 2 == 0, F.array().cast("array<string>")).otherwise(
                F.array(F.lit("df_shuffle_200"), F.lit("df_no_broadcast"))
            )
        ).alias("ablation"),
        "event_id",
        "value",
    )
    totals = named.groupBy("name", "ablation").agg(F.max("value").alias("RDD_ms"), F.min("value").alias("DF_ms"))
    kernels = (
        named.where("name <> 'error'")
        .groupBy("name", "ablation", (F.col("event_id") % 3).alias("trial"))
        .agg(F.max("value").alias("RDD_kernel_ms"), F.min("value").alias("DF_kernel_ms"))
    )
    merged = benchstats.merge_summaries(totals, kernels, "trial")
    return merged.withColumns({c: F.round(c, 9) for c in ("speedup_total", "speedup_kernel")})


def kernel_table(t: Tables) -> DataFrame:
    trials = t.events.select(
        F.col("event_type").alias("name"),
        F.when(F.col("user_id") % 2 == 0, "baseline").otherwise("df_shuffle_200").alias("ablation"),
        F.when(F.col("event_id") % 2 == 0, "rdd").otherwise("df").alias("engine"),
        F.col("value").alias("ms"),
    )
    return benchstats.kernel_table(trials)


def total_table(t: Tables) -> DataFrame:
    """Events as timings, with run metrics and case shapes counted from them as well."""
    events = t.events.select(
        F.col("event_type").alias("name"),
        F.when(F.col("user_id") % 2 == 0, "baseline").otherwise("df_shuffle_200").alias("ablation"),
        F.when(F.col("event_id") % 2 == 0, "rdd").otherwise("df").alias("engine"),
        F.col("value").alias("ms"),
        "event_id",
        "user_id",
    )
    metrics = benchstats.TOTAL_COLUMNS[15:30]
    runs = events.groupBy("name", "ablation", "engine").agg(
        *[
            F.count(F.when(F.col("event_id") % (p + 2) == 0, 1)).alias(c.removeprefix("rdd_"))
            for p, c in enumerate(metrics[:-1])
        ],
        F.max("event_id").cast("string").alias("hash"),
    )
    cases = events.groupBy("name").agg(
        F.max("event_id").alias("A_rows"),
        F.max("user_id").alias("A_cols"),
        F.max("user_id").alias("B_rows"),
        F.lit(1).alias("B_cols"),
        F.max("event_id").alias("cells"),
        (F.max("event_id") > 2_000_000).alias("preview_used"),
    )
    table = benchstats.total_table(events, cases, runs)
    return table.withColumns({c: F.round(c, 6) for c in ("RDD_ms_std", "DF_ms_std")})


def event_log_rollup(t: Tables) -> DataFrame:
    """Each event as a line of a Spark event log: a finished task, or a job or stage event."""
    amount = F.floor("value").cast("bigint")
    task = F.struct(
        amount.alias("Executor Run Time"),
        (F.col("event_id") % 5).alias("JVM GC Time"),
        (F.col("event_id") % 11).alias("Memory Bytes Spilled"),
        (F.col("event_id") % 13).alias("Disk Bytes Spilled"),
        F.struct((amount * 3).alias("Bytes Read")).alias("Input Metrics"),
        F.struct((amount * 2).alias("Bytes Written")).alias("Output Metrics"),
        F.struct(amount.alias("Remote Bytes Read"), (F.col("user_id") % 7).alias("Local Bytes Read")).alias(
            "Shuffle Read Metrics"
        ),
        F.struct((F.col("user_id") % 9).alias("Shuffle Bytes Written")).alias("Shuffle Write Metrics"),
    )
    kind = (
        F.when(F.col("event_id") % 10 == 0, "SparkListenerJobStart")
        .when(F.col("event_id") % 10 == 1, "SparkListenerStageCompleted")
        .otherwise("SparkListenerTaskEnd")
    )
    lines = t.events.select(
        F.col("event_type").alias("label"),
        F.to_json(
            F.struct(kind.alias("Event"), F.when(kind == "SparkListenerTaskEnd", task).alias("Task Metrics"))
        ).alias("line"),
    )
    return benchstats.event_log_rollup(lines)


def event_log_runs(t: Tables) -> DataFrame:
    """One log of all events, cut into runs that begin at every fortieth event and last an hour."""
    amount = F.floor("value").cast("bigint")
    time = F.expr(
        "datediff(date(ts), date'1970-01-01') * 86400000L + hour(ts) * 3600000L + minute(ts) * 60000L"
        " + cast(floor(extract(second from ts) * 1000) as bigint)"
    )
    task = F.struct(amount.alias("Executor Run Time"), (F.col("event_id") % 5).alias("JVM GC Time"), F.struct((amount * 3).alias("Bytes Read")).alias("Input Metrics"))
    is_job = F.col("event_id") % 10 == 0
    line = F.struct(
        F.when(is_job, "SparkListenerJobStart").otherwise("SparkListenerTaskEnd").alias("Event"),
        F.when(is_job, time).alias("Submission Time"),
        F.when(~is_job, F.struct(time.alias("Finish Time"))).alias("Task Info"),
        F.when(~is_job, task).alias("Task Metrics"),
    )
    log = F.lit("all").alias("label")
    lines = t.events.select(log, F.to_json(line).alias("line"))
    runs = t.events.where("event_id % 40 = 0").select(log, F.col("event_id").cast("string").alias("run"), time.alias("time_ms"), (time + 3_600_000).alias("end_ms"))
    return benchstats.event_log_runs(lines, runs).select("label", "jobs", "tasks", "input_bytes", "gc_ms", "p50_ms", "max_ms")


def gen_identity(t: Tables) -> DataFrame:
    return cw.spmv(generate.identity(t.spark, t.size("part")), t.sizes()).df


def gen_diagonal(t: Tables) -> DataFrame:
    return cw.spmv(generate.diagonal(t.spark, t.size("part"), F.col("i") % 5 + 1), t.sizes()).df


def gen_zero(t: Tables) -> DataFrame:
    n = t.size("part")
    return cw.spmv(generate.zero(t.spark, n, n), t.sizes()).df


def gen_upper(t: Tables) -> DataFrame:
    return cw.spmv(generate.upper_triangular(t.spark, t.size("supplier")), t.balances()).df


def gen_banded(t: Tables) -> DataFrame:
    n = t.size("part")
    return cw.spmv(generate.banded(t.spark, n, n, 10, value=3 * F.col("i") + F.col("j") + 1), t.sizes()).df


def gen_block_diagonal(t: Tables) -> DataFrame:
    n = t.size("part")
    return _rounded(cw.spmv(generate.block_diagonal(t.spark, n, n, 10, 0.5), t.sizes()), 4)


def gen_uniform_draws(t: Tables) -> DataFrame:
    a = generate.uniform_draws(t.spark, t.size("part"), t.size("supplier"), 0.05)
    return _rounded(cw.spmv(a, t.balances()), 4)


def gen_uniform_rows(t: Tables) -> DataFrame:
    a = generate.uniform_rows(t.spark, t.size("part"), t.size("supplier"), 0.05)
    return _rounded(cw.spmv(a, t.balances()), 4)


def gen_power_law(t: Tables) -> DataFrame:
    n = t.size("part")
    a = generate.power_law(t.spark, n, t.size("supplier"), 10 * n)
    return _rounded(cw.spmv(a, t.balances()), 4)


def gen_power_law_exact(t: Tables) -> DataFrame:
    """Rows and draws of a power-law matrix with one draw for each order line."""
    degrees = generate.power_law_degrees(t.spark, t.size("part"), t.size("lineitem"))
    return generate.exact_degrees(degrees, t.size("lineitem")).agg(F.count("*").alias("n_rows"), F.sum("degree").alias("draws"))


def gen_row_hotspot(t: Tables) -> DataFrame:
    a = generate.row_hotspot(t.spark, t.size("part"), t.size("supplier"), 0.01, 10)
    return _rounded(cw.spmv(a, t.balances()), 4)


def gen_dense_vector(t: Tables) -> DataFrame:
    return _rounded(cw.spmv(t.part_supplier(), generate.dense_vector(t.spark, t.size("supplier"))), 4)


def gen_sparse_vector(t: Tables) -> DataFrame:
    return _rounded(cw.spmspv(t.part_supplier(), generate.sparse_vector(t.spark, t.size("supplier"), 0.1)), 4)


_ALL = [
    spmv, spmspv, kernel_only, spmm, spdm, multiply_dispatch, multiply_to_text, multiply_files,
    multiply_text_sparse, multiply_text_dense, multiply_text_row, multiply_text_lenient_vector, multiply_text_lenient_matrix, spmv_repeated_keys, power_residual,
    power_iteration, power_iteration_laid_out, power_history, spmv_exact, exact_totals, l1_norm, l1_distance,
    dense_rows, dense_segments, vector_line, preview, glance, checksum,
    coo_from_table, by_row, by_col,
    sparsity, line_sparsity, matrix_sparsity, shape_profile, vector_class, vector_files, result_cells,
    numeric_lines, lenient_coo, grid_to_coo, normalize_text, normalize_invisible,
    read_lines, read_grid, read_dense, read_column_vector, read_row_vector, read_sparse_column,
    nearest_rank, trial_stats, nearest_rank_null_keys, trial_stats_null_keys, merge_summaries, kernel_table, total_table, event_log_rollup, event_log_runs,
    gen_identity, gen_diagonal, gen_zero, gen_upper, gen_banded, gen_block_diagonal,
    gen_uniform_draws, gen_uniform_rows, gen_power_law, gen_power_law_exact, gen_row_hotspot, gen_dense_vector, gen_sparse_vector,
]


def _over_folder(query: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: query(Tables(spark, folder))


def queries() -> dict[str, Query]:
    return {query.__name__: _over_folder(query) for query in _ALL}
