import numpy as np
import pytest
from helpers import grid, values
from pyspark.sql import functions as F

import cellwise as cw
from cellwise.functions.mixing import gaussian, hashed, permutation_keys, permuted, permuted_rows, uniform
from cellwise.functions.text import two_decimals
from cellwise.plans import suite
from cellwise.sources import generate as g


def cells(m):
    rows = [(r.i, r.j) for r in m.df.collect()]
    assert len(set(rows)) == len(rows)
    return np.array(rows).reshape(-1, 2)


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 100, 1000):
        rows = spark.range(3).select(F.col("id").alias("row"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("s"))
        rows = rows.select("row", permuted(F.col("s").cast("bigint"), permutation_keys(F.col("row"), 5), n).alias("p"))
        for row in range(3):
            assert sorted(r.p for r in rows.where(F.col("row") == row).collect()) == list(range(n))


def test_positions_are_evenly_likely(spark):
    m = g.uniform_rows(spark, 4000, 50, 0.1)
    counts = np.bincount(cells(m)[:, 1], minlength=50)
    expected = 4000 * 5 / 50
    assert ((counts - expected) ** 2 / expected).sum() < 95  # chi-square, 49 degrees, p about 1e-4


def test_draws_look_normal_and_uniform(spark):
    df = spark.range(20000).select(gaussian(F.col("id"), 1).alias("z"), uniform(F.col("id"), 1).alias("u"))
    r = df.agg(F.mean("z"), F.stddev("z"), F.mean("u"), F.min("u"), F.max("u")).first()
    assert abs(r[0]) < 0.03 and abs(r[1] - 1) < 0.03 and abs(r[2] - 0.5) < 0.01 and r[3] >= 0 and r[4] < 1


def test_fixed_patterns(spark):
    assert np.array_equal(grid(g.identity(spark, 5)), np.eye(5))
    assert np.array_equal(grid(g.upper_triangular(spark, 4)), [[1, 2, 3, 4], [0, 5, 6, 7], [0, 0, 8, 9], [0, 0, 0, 10]])
    assert g.zero(spark, 4, 4).df.count() == 0
    ones = F.lit(1.0)
    for n, width in ((50, 1), (50, 10)):
        full = cells(g.banded(spark, n, n, width, value=ones))
        assert (abs(full[:, 0] - full[:, 1]) <= width).all()
        assert len(full) == n * (2 * width + 1) - width * (width + 1)
    wide = cells(g.banded(spark, 5, 20, 2, value=ones))
    tall = cells(g.banded(spark, 20, 5, 2, value=ones))
    assert {(j, i) for i, j in wide.tolist()} == {tuple(c) for c in tall.tolist()}


def test_long_rows_are_made_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(g, "_ROW_CHUNK", 3)
    assert np.array_equal(grid(g.upper_triangular(spark, 4)), [[1, 2, 3, 4], [0, 5, 6, 7], [0, 0, 8, 9], [0, 0, 0, 10]])
    m = g.row_hotspot(spark, 40, 30, 0.1, 4)
    monkeypatch.undo()
    assert np.array_equal(grid(m), grid(g.row_hotspot(spark, 40, 30, 0.1, 4)))


def test_random_rows(spark):
    m = g.uniform_rows(spark, 300, 200, 0.05)
    counts = np.bincount(cells(m)[:, 0], minlength=300)
    assert counts.max() == 10 and counts.sum() > 2990  # a value may round to zero
    sparse = g.uniform_rows(spark, 300, 20, 0.001)
    assert np.bincount(cells(sparse)[:, 0], minlength=300).max() == 1


def test_random_draws(spark):
    m = g.uniform_draws(spark, 100, 80, 0.1)
    n = len(cells(m))
    assert 700 < n <= 800
    vs = np.array([r.v for r in m.df.collect()])
    assert abs(vs.std() - 10) < 1 and np.allclose(vs, vs.round(2))


def test_draws_are_sent_in_blocks(spark, monkeypatch):
    """Each distinct position once, whatever the blocks, and no shuffle of single draws."""
    seed, rows, cols, n = 42, 90, 70, 3150
    ids = spark.range(n).select(F.pmod(hashed(F.col("id"), seed, 1), F.lit(rows)), F.pmod(hashed(F.col("id"), seed, 2), F.lit(cols)))
    wanted = {tuple(r) for r in ids.collect()}
    for limit in (1 << 23, 100):
        monkeypatch.setattr(g, "_TASK_CELLS", limit)
        m = g.uniform_draws(spark, rows, cols, 0.5)
        found = {tuple(c) for c in cells(m).tolist()}
        # A value may round to zero.
        assert found <= wanted and len(found) > 0.98 * len(wanted)
        shuffled = [line for line in m.df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
        assert shuffled and all("REPARTITION_BY_NUM" in line for line in shuffled)
    assert g.uniform_draws(spark, 1 << 40, 1 << 40, 100 / (1 << 80)).df.count() > 90
    assert g.uniform_draws(spark, 1 << 30, 1 << 30, 100 / (1 << 60)).df.count() > 90


def test_rows_are_compiled_and_dealt_by_cells(spark, monkeypatch):
    """No fold over an array for each cell, and no task makes more cells for a larger matrix."""
    monkeypatch.setattr(g, "_TASK_CELLS", 500)
    for m in (g.uniform_rows(spark, 200, 300, 0.1), g.row_hotspot(spark, 200, 300, 0.1, 3)):
        assert "aggregate(" not in m.df._jdf.queryExecution().executedPlan().toString().split("Generate explode")[0]
        per_task = m.df.groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) >= 12 and max(r["count"] for r in per_task) < 1500


def test_rows_follow_their_permutation(spark):
    """The columns of a row are where ``permuted`` puts its first slots."""
    slots = spark.range(20).select(F.col("id").alias("i"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(29).cast("bigint"))).alias("s"))
    wanted = slots.select("i", permuted(F.col("s"), permutation_keys(F.col("i"), 7), 101).alias("j"))
    made = permuted_rows(spark.range(20).select(F.col("id").alias("i")), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(29).cast("bigint"))), "i", 7, 101, "j")
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, wanted.collect()))


def test_two_decimals_are_those_of_round(spark):
    xs = [0.0, -0.001, 0.005, -0.005, 1.005, 2.675, -2.675, 12.345, 1e8 + 0.125, 1e15, -1e300, 0.0049999999, float("nan"), float("inf"), None]
    xs += [i / 1000 for i in range(-3000, 3000, 7)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select(two_decimals(F.col("x")).alias("a"), F.round("x", 2).alias("b")).collect()
    assert [repr(r.a) for r in rows] == [repr(r.b) for r in rows]


def test_blocks(spark):
    m = g.block_diagonal(spark, 105, 120, 10, 0.5)
    found = cells(m)
    assert (found[:, 0] // 10 == found[:, 1] // 10).all() and found[:, 0].max() < 100
    assert 0.4 < len(found) / 1000 < 0.6


def test_hot_rows(spark):
    counts = np.bincount(cells(g.row_hotspot(spark, 200, 400, 0.01, 10))[:, 0], minlength=200)
    assert (counts > 190).sum() == 10 and (counts <= 4).sum() == 190


def test_power_law_degrees(spark):
    d = np.array([r.degree for r in g.power_law_degrees(spark, 4000, 40000).collect()])
    assert abs(d.mean() - 10) < 1 and abs(d.std() - 12.65) < 1.5
    assert abs((d == 0).mean() - 0.047) < 0.015 and 50 < np.quantile(d, 0.99) < 70
    m = g.power_law(spark, 200, 30, 2000)
    assert np.bincount(cells(m)[:, 0]).max() <= 30


def test_vectors(spark):
    assert values(g.dense_vector(spark, 10, values="counting")).tolist() == list(range(1, 11))
    long = g.dense_vector(spark, 500)
    assert long.df.count() == 500 and abs(values(long).std() - 10) < 1.5
    assert g.sparse_vector(spark, 200, 0.1).df.count() == 20
    assert g.sparse_vector(spark, 5, 0.01).df.count() == 1


def test_partitioning_does_not_matter(spark, setting):
    m = g.power_law(spark, 60, 40, 400)
    expected = grid(m)
    setting("spark.sql.shuffle.partitions", "11")
    assert np.array_equal(grid(g.power_law(spark, 60, 40, 400)), expected)
    repeated = cw.Matrix(m.df.repartition(7), m.shape)
    assert np.array_equal(grid(repeated), expected)


def test_suite(spark):
    made = suite.operands()
    assert len(suite.CASES) == 20
    assert all(case.left in made and case.right in made for case in suite.CASES)
    known = {
        "small_spmv_3x3": [31, 14, 15],
        "small_spmm_3x3": [[67, 80, 93], [28, 35, 42], [35, 40, 45]],
        "small_identity_rect": suite.SMALL_DENSE["rect_5x3"],
        "small_zero_x_diag": np.zeros((4, 4)),
    }
    for case in suite.CASES[:4]:
        product = cw.multiply(made[case.left](spark), made[case.right](spark), False)
        found = values(product) if isinstance(product, cw.Vector) else grid(product)
        assert np.array_equal(found, known[case.name])
    assert np.array_equal(grid(made["diagonal_4x4"](spark)), np.diag([5, 3, 8, 2]))


@pytest.mark.parametrize("name", ["med_rect_100x50_mul", "pat_rowhot_1000_x"])
def test_suite_products(spark, name):
    case = next(c for c in suite.CASES if c.name == name)
    made = suite.operands()
    a, b = made[case.left](spark), made[case.right](spark)
    product = cw.multiply(a, b)
    if isinstance(product, cw.Vector):
        assert np.allclose(values(product), grid(a) @ values(b))
    else:
        assert np.allclose(grid(product), grid(a) @ grid(b))
