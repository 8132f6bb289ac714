import math

import numpy as np
import pytest
from helpers import A, B, C, D, S, V, dense, grid, sparse, values, vector
from pyspark.sql import functions as F

import cellwise as cw
from cellwise.model import DenseMatrix, Matrix, Shape, Vector
from cellwise.operators import multiply as mul
from cellwise.sources import generate


def test_matrix_vector(spark):
    assert values(cw.spmv(sparse(spark, A), vector(spark, D))).tolist() == [31, 14, 0, 20]
    assert values(cw.spmv(sparse(spark, C), vector(spark, D))).tolist() == [33, 46, 0, 20, 25]
    assert cw.spmv(sparse(spark, A), vector(spark, D)).df.count() == 4


def test_matrix_sparse_vector(spark):
    assert values(cw.spmspv(sparse(spark, A), vector(spark, V))).tolist() == [0, 7, 0, 35]
    assert values(cw.spmspv(sparse(spark, C), vector(spark, V))).tolist() == [1, 63, 0, 35, 5]
    bare = cw.spmspv(sparse(spark, A), vector(spark, V), zero_fill=False)
    assert {r.k: r.x for r in bare.df.collect()} == {1: 7.0, 3: 35.0}


def test_matrix_matrix(spark):
    for left, right in [(A, S), (C, C)]:
        product = cw.spmm(sparse(spark, left), sparse(spark, right))
        assert np.array_equal(grid(product), np.array(left) @ np.array(right))
    product = cw.spdm(sparse(spark, A), dense(spark, B))
    assert np.array_equal(grid(product), np.array(A) @ np.array(B))


def test_dense_zeros_leave_stored_zeros(spark):
    a = sparse(spark, [[1, 0], [0, 0]])
    zeros = [[0, 0, 0], [5, 5, 5]]
    assert cw.spdm(a, dense(spark, zeros)).df.count() == 3
    assert cw.spmm(a, dense(spark, zeros).to_sparse()).df.count() == 0


def test_cancelled_sums_stay(spark):
    product = cw.spmm(sparse(spark, [[1, -1]]), sparse(spark, [[2], [2]]))
    assert [tuple(r) for r in product.df.collect()] == [(0, 0, 0.0)]
    assert cw.drop_zeros(product.df).count() == 0


def test_a_longer_vector_comes_to_the_cells_as_panels(spark, setting):
    """As pairs the vector is beyond a broadcast, as arrays it is not; no cell is shuffled for it."""
    n = 9000
    a, x = generate.uniform_rows(spark, 40, n, 0.02), generate.dense_vector(spark, n)
    whole = values(cw.spmv(a, x))
    # Repeated entries add up, one is NULL, most are absent.
    odd = Vector(spark.createDataFrame([(0, 1.0), (0, 2.0), (4096, 4.0), (8999, None)], "k bigint, x double"), n)
    b = Matrix(spark.createDataFrame([(0, 0, 10.0), (0, 8999, 1.0), (1, 4096, 1.0), (1, 5000, 7.0)], "i bigint, j bigint, v double"), Shape(3, n))
    setting("spark.sql.autoBroadcastJoinThreshold", "100000")
    product = cw.spmv(a, x)
    plan = product.df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert np.allclose(values(product), whole)
    assert values(cw.spmv(b, odd)).tolist() == [30, 4, 0]


def test_infinity_meets_zero_only_in_the_dense_product(spark):
    a = Matrix(spark.createDataFrame([(0, 0, math.inf)], "i bigint, j bigint, v double"), Shape(1, 1))
    assert math.isnan(cw.spdm(a, dense(spark, [[0]])).df.first().v)
    assert cw.spmm(a, dense(spark, [[0]]).to_sparse()).df.count() == 0


def test_shape_mismatch(spark):
    with pytest.raises(ValueError, match="4x5"):
        cw.spmv(sparse(spark, A), vector(spark, V[:3]))
    with pytest.raises(ValueError, match="4x5"):
        cw.spmm(sparse(spark, A), sparse(spark, A))
    with pytest.raises(ValueError, match="4x5"):
        cw.spdm(sparse(spark, A), dense(spark, A))


def test_multiply_picks_the_kernel(spark):
    a = sparse(spark, A)
    assert np.array_equal(grid(cw.multiply(a, dense(spark, B))), np.array(A) @ np.array(B))
    assert np.array_equal(grid(cw.multiply(a, sparse(spark, S))), np.array(A) @ np.array(S))
    column, row = [[d] for d in D], [D]
    for right in (vector(spark, D), dense(spark, column), dense(spark, row), sparse(spark, column)):
        assert values(cw.multiply(a, right)).tolist() == [31, 14, 0, 20]
    assert values(cw.multiply(a, vector(spark, V))).tolist() == [0, 7, 0, 35]
    empty = DenseMatrix(spark.createDataFrame([], "k bigint, row array<double>"), Shape(0, 0))
    assert cw.multiply(a, empty).df.count() == 0


def test_left_operand_must_be_sparse(spark):
    full = sparse(spark, [[4, 3], [9, 7]])
    with pytest.raises(ValueError, match="not sparse"):
        cw.multiply(full, vector(spark, [1, 2]))
    assert values(cw.multiply(full, vector(spark, [1, 2]), False)).tolist() == [10, 23]
    half = sparse(spark, [[4, 0], [0, 7]])
    with pytest.raises(ValueError, match="not sparse"):
        cw.multiply(half, vector(spark, [1, 2]))


def test_repeated_triplets_add_up(spark):
    rows = [(0, 0, 1.0), (0, 0, 2.0), (0, 1, 4.0), (0, 1, -4.0), (1, 1, 0.0)]
    m = cw.coo_from_table(spark.createDataFrame(rows, "r int, c int, q double"), "r", "c", "q", Shape(2, 2))
    assert [tuple(r) for r in m.df.collect()] == [(0, 0, 3.0)]
    x = vector(spark, [10, 100])
    assert values(cw.spmv(m, x)).tolist() == [30, 0]
    assert cw.spmv(m, x, zero_fill=False).df.collect() == [(0, 30.0)]


def test_zeros_of_any_sign_drop_and_nan_stays(spark):
    rows = [(0, 0, -0.0), (0, 1, math.nan), (1, 0, math.inf), (1, 1, 0.0)]
    m = cw.coo_from_table(spark.createDataFrame(rows, "i int, j int, v double"), "i", "j", "v", Shape(2, 2), "none")
    assert sorted((r.i, r.j) for r in m.df.collect()) == [(0, 1), (1, 0)]


def test_algebra(spark):
    a = generate.uniform_rows(spark, 30, 40, 0.1)
    b = generate.uniform_rows(spark, 40, 25, 0.2, seed=7)
    x = generate.dense_vector(spark, 25)
    assert np.allclose(grid(cw.spmm(a, generate.identity(spark, 40))), grid(a))
    assert cw.spmm(a, generate.zero(spark, 40, 3)).df.count() == 0
    once = values(cw.spmv(cw.spmm(a, b), x))
    twice = values(cw.spmv(a, cw.spmv(b, x)))
    assert np.allclose(once, twice)
    assert np.allclose(once, grid(a) @ grid(b) @ values(x))


def skewed_pair(spark):
    """Inner index 0 holds most cells of both sides."""
    rng = np.random.default_rng(1)
    left = np.where(rng.random((60, 12)) < 0.1, rng.integers(1, 9, (60, 12)), 0)
    right = np.where(rng.random((12, 50)) < 0.1, rng.integers(1, 9, (12, 50)), 0)
    left[:, 0], right[0, :] = 1, 2
    left[5, :] = 3
    return left.tolist(), right.tolist()


@pytest.mark.parametrize("strategy", ["broadcast_right", "broadcast_left", "split", "hash_right", "hash_left", "merge"])
def test_every_join_strategy_gives_the_same_product(spark, monkeypatch, strategy):
    left, right = skewed_pair(spark)
    monkeypatch.setattr(mul, "spmm_strategy", lambda *_: strategy)
    monkeypatch.setattr(mul, "PIECE_WORK", 64)
    monkeypatch.setattr(mul, "PIECE_SIDE", 8)
    product = cw.spmm(sparse(spark, left), sparse(spark, right))
    assert np.array_equal(grid(product), np.array(left) @ np.array(right))


def test_split_pieces_are_bounded_and_whole(spark, monkeypatch):
    left, right = skewed_pair(spark)
    monkeypatch.setattr(mul, "PIECE_WORK", 64)
    monkeypatch.setattr(mul, "PIECE_SIDE", 8)
    a, b = sparse(spark, left).df, sparse(spark, right).df
    counts = mul.inner_counts(a, "j", "a").join(mul.inner_counts(b, "i", "b"), "k")
    lp, rp = mul._spread(
        a.select("i", a.j.alias("k"), a.v.alias("a_v")), b.select(b.i.alias("k"), "j", b.v.alias("b_v")), counts
    )
    joined = lp.join(rp, ["k", "p", "q"])
    pairs = joined.select("k", "i", "j").collect()
    expected = {
        (k, i, j) for k in range(12) for i in range(60) for j in range(50) if left[i][k] and right[k][j]
    }
    assert len(pairs) == len(expected) and {tuple(p) for p in pairs} == expected
    heaviest = joined.groupBy("k", "p", "q").count().agg({"count": "max"}).first()[0]
    assert heaviest < 60 * 50 / 4


def test_strategy_follows_the_measured_sizes(spark, setting):
    left, right = skewed_pair(spark)
    profile = mul.inner_profile(sparse(spark, left), sparse(spark, right))
    assert profile.left == np.count_nonzero(left) and profile.right == np.count_nonzero(right)
    assert profile.heaviest == 60 * 50 and profile.fullest_row == 12 and profile.right_top == 50
    work = (np.array(left) != 0).sum(0) * (np.array(right) != 0).sum(1)
    assert profile.products == work.sum()
    assert mul.spmm_strategy(spark, profile) == "broadcast_right"
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert mul.spmm_strategy(spark, profile) == "merge"
    big = mul.InnerProfile(10**9, 10**8, 10**6, 10**6, 10**12, 10**12, 10**5)
    assert mul.spmm_strategy(spark, big) == "split"


def test_vector_is_hinted_only_within_the_limit(spark, setting):
    a, x = sparse(spark, A), vector(spark, D)

    def plan(v):
        return cw.spmv(a, v).df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(x)
    huge = Vector(x.df, 10**9, dense=True)
    assert "strategy=broadcast" not in mul._sized(huge)._jdf.queryExecution().analyzed().toString()
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "strategy=broadcast" not in plan(x)
    assert values(cw.spmv(a, x)).tolist() == [31, 14, 0, 20]


def test_hot_column_of_a_dense_product_is_cut(spark, setting, monkeypatch):
    left, _ = skewed_pair(spark)
    right = np.arange(12 * 4).reshape(12, 4).tolist()
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(mul, "PIECE_WORK", 32)
    product = cw.spdm(sparse(spark, left), dense(spark, right))
    assert np.array_equal(grid(product), np.array(left) @ np.array(right))


def test_row_clustering_keeps_the_product_and_drops_a_shuffle(spark):
    a = generate.uniform_rows(spark, 200, 30, 0.1)
    b = generate.uniform_rows(spark, 30, 40, 0.5, seed=3)
    profile = mul.inner_profile(a, b)
    product = cw.spmm(a, b, profile)
    assert np.allclose(grid(product), grid(a) @ grid(b))
    plan = product.df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(i") == final.count("Exchange hashpartitioning") == 1, plan


def test_segments_carry_any_index_and_value(spark, setting):
    """Columns beyond two bytes; whole, broken, large and infinite values, each as it was."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [[1.0, 127.0, 128.0, 255.0, 256.0, 32767.0], [-1.0, -128.0, -129.0, -32767.0, 7.0, 9.0], [0.5, 2.0, 3.0, 4.0, 5.0, 6.0]]
    rows += [[-32768.0, 32768.0, 1e300, 1.0, 2.0, 3.0], [math.inf, -math.inf, math.nan, 5e-324, 1.0, 2.0]]
    js = [0, 65535, 65536, 8_388_607, 8_388_608, 70_000_000]
    cells = [(i, j, v) for i, row in enumerate(rows) for j, v in zip(js, row, strict=True)]
    b = Matrix(spark.createDataFrame(cells, "i bigint, j bigint, v double"), Shape(5, 70_000_001))
    a = Matrix(spark.createDataFrame([(10 + i, i, 1.0) for i in range(5)], "i bigint, j bigint, v double"), Shape(15, 5))
    p = mul.inner_profile(a, b)
    met = mul._segments_met(a, b, p)
    found = {(r.i - 10, r.j): r.v for r in mul.gathered(met).collect()}
    assert len(found) == 30 and all(found[i, j] == v or math.isnan(v) and math.isnan(found[i, j]) for i, j, v in cells)
    near = Matrix(b.df.where("j < 8388608"), Shape(5, 8_388_608))
    found = {(r.i - 10, r.j): r.v for r in mul.gathered(mul._segments_met(a, near, p)).collect()}
    assert len(found) == 20 and all(found[i, j] == v or math.isnan(v) for i, j, v in cells if j < 8_388_608)


def test_tasks_that_send_segments_follow_the_products(spark, setting, monkeypatch):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(mul, "JOIN_PRODUCTS", 100)
    a = generate.uniform_rows(spark, 200, 30, 0.1)
    b = generate.uniform_rows(spark, 30, 40, 0.5, seed=3)
    product = cw.spmm(a, b)
    assert np.allclose(grid(product), grid(a) @ grid(b))
    plan = product.df._jdf.queryExecution().executedPlan().toString()
    assert mul.inner_profile(a, b).products // 100 == 120 and "hashpartitioning(j" in plan and ", 120)" in plan


def test_the_text_of_a_product_shuffles_no_cell_of_it(spark, setting):
    """Products go to the rows of the text, empty rows and segments included, and are added up there."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    a = generate.uniform_rows(spark, 60, 30, 0.1)
    a = Matrix(a.df.where("i % 7 <> 3"), a.shape)
    b = generate.uniform_rows(spark, 30, 200, 0.1, seed=3)
    b = Matrix(b.df.where("j < 70 or j > 150"), b.shape)
    product = cw.spmm(a, b)
    assert product.segments is not None
    text = cw.dense_rows(product, width=16)
    bare = cw.dense_rows(Matrix(product.df, product.shape), width=16)
    rows = sorted(tuple(r) for r in text.collect())
    assert rows == sorted(tuple(r) for r in bare.collect()) and len(rows) == 60 * 13
    assert bare._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(i") > text._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(i")


@pytest.mark.parametrize("is_dense, join", [(True, "ShuffledHashJoin"), (False, "SortMergeJoin")])
def test_hot_column_is_split_at_run_time(spark, setting, monkeypatch, is_dense, join):
    """A third of all cells in one column: its partition is read by several tasks."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200KB")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    setting("spark.sql.shuffle.partitions", "16")
    monkeypatch.setattr(mul, "fits_broadcast", lambda spark, rows, *_: is_dense and rows < 10_000)
    n = 20_000
    cell = spark.range(0, 600_000, 1, 8)
    column = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(n)))
    a = Matrix(cell.select((F.col("id") % n).alias("i"), column.alias("j"), F.lit(1.0).alias("v")), Shape(n, n))
    x = Vector(spark.range(n).select(F.col("id").alias("k"), F.lit(1.0).alias("x")), n, is_dense)
    y = cw.spmv(a, x).df
    assert sum(r.x for r in y.collect()) == 600_000
    final = y._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert f"{join}(skew=true)" in final


def test_partition_count_does_not_matter(spark, setting):
    expected = grid(cw.spmm(sparse(spark, C), sparse(spark, C)))
    setting("spark.sql.shuffle.partitions", "13")
    assert np.array_equal(grid(cw.spmm(sparse(spark, C), sparse(spark, C))), expected)


def test_segments_bring_no_product_into_a_shuffle(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    a = generate.uniform_rows(spark, 400, 90, 0.06)
    b = generate.uniform_rows(spark, 90, 70, 0.4, seed=3)
    profile = mul.inner_profile(a, b)
    assert mul.spmm_strategy(spark, profile) == "segments"
    product = cw.spmm(a, b, profile)
    assert np.allclose(grid(product), grid(a) @ grid(b))
    final = product.df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The plan is written from the result down: what is opened is never exchanged again.
    assert "Exchange" not in final.split("Generate inline")[0] and final.count("Exchange hashpartitioning") == 3


def test_segments_add_up_repeated_cells_and_cut_long_rows(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = np.random.default_rng(4)
    i, j, v = rng.integers(0, 60, 900), rng.integers(0, 40, 900), rng.integers(-3, 4, 900)
    table = spark.createDataFrame([(int(a), int(b), float(c)) for a, b, c in zip(i, j, v, strict=True)], "i bigint, j bigint, v double")
    a, b = cw.coo_from_table(table, "i", "j", "v", Shape(60, 40)), cw.coo_from_table(table, "j", "i", "v", Shape(40, 60))
    dense_a = grid(a)
    profile = mul.inner_profile(a, b)
    for width in (mul.SEGMENT, 7):
        parts = mul.row_segments(b, profile.right_top, width)
        assert parts.selectExpr("max(size(cells))").first()[0] <= max(width, 60)
        if width == 7:
            assert parts.where("size(cells) > 7").count() == 0 and parts.where("segment > 0").count() > 0
        cells = {(r["k"], c["j"]): c["b_v"] for r in parts.collect() for c in r["cells"]}
        assert cells == {(k, m): dense_a[m, k] for k in range(40) for m in range(60) if dense_a[m, k]}
    assert np.array_equal(grid(Matrix(mul._segment_product(a, b, profile), Shape(60, 60))), dense_a @ dense_a.T)


def test_tasks_of_a_product_follow_its_products(spark, setting, monkeypatch):
    """More products make more tasks, not larger sums that spill."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(mul, "TASK_PRODUCTS", 1000)
    a = generate.uniform_rows(spark, 400, 90, 0.06)
    b = generate.uniform_rows(spark, 90, 70, 0.4, seed=3)
    profile = mul.inner_profile(a, b)
    product = mul._segment_product(a, b, profile)
    assert profile.products > 40_000
    assert product.rdd.getNumPartitions() == -(-profile.products // 1000)
    assert np.allclose(grid(Matrix(product, Shape(400, 70))), grid(a) @ grid(b))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_dense_panels_bring_no_product_into_a_shuffle(spark, setting, monkeypatch, threshold):
    setting("spark.sql.autoBroadcastJoinThreshold", threshold)
    monkeypatch.setattr(mul, "SEGMENT", 8)
    a = generate.uniform_rows(spark, 300, 40, 0.1)
    right = np.random.default_rng(2).integers(-4, 5, (40, 21)).tolist()
    monkeypatch.setattr(mul.dense_panels, "__defaults__", (8,))
    product = cw.spdm(a, dense(spark, right))
    assert np.allclose(grid(product), grid(a) @ np.array(right))
    final = product.df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Exchange" not in final.split("Generate posexplode")[0]


def test_generated_rows_fill_all_partitions(spark, setting, monkeypatch):
    setting("spark.sql.shuffle.partitions", "6")
    for chunk in (1 << 16, 16):
        monkeypatch.setattr(generate, "_ROW_CHUNK", chunk)
        matrices = [generate.uniform_rows(spark, 600, 90, 0.5), generate.banded(spark, 600, 600, 30), generate.upper_triangular(spark, 200), generate.row_hotspot(spark, 600, 90, 0.05, 5)]
        for m in matrices:
            counts = [r["count"] for r in m.df.groupBy(F.spark_partition_id()).count().collect()]
            assert len(counts) >= 4 and max(counts) < 2.5 * sum(counts) / len(counts)
