import numpy as np
import pytest
from helpers import A, C, grid, sparse, values, vector

import cellwise as cw
from cellwise.operators import iterate
from cellwise.sources import generate

G = [[0, 0, 0.5, 0], [1, 0, 0, 0], [0, 1, 0, 1], [0, 0, 0.5, 0]]

KNOWN = [
    (G, 1, [0.14375, 0.25, 0.4625, 0.14375], 0.425),
    (G, 2, [0.2340625, 0.1596875, 0.3721875, 0.2340625], 0.36125),
    (G, 20, [0.201948436, 0.20915617, 0.386946958, 0.201948436], 1.8926e-05),
    (C, 20, [0.195100187, 0.422905307, 0.03, 0.068229135, 0.28376537], 5.166e-07),
]


@pytest.mark.parametrize("matrix, steps, expected, residual", KNOWN)
@pytest.mark.parametrize("layout", [False, True])
def test_known_iterations(spark, matrix, steps, expected, residual, layout):
    result = cw.power_iteration(sparse(spark, matrix), steps=steps, layout=layout)
    assert np.allclose(values(result.vector), expected, atol=1e-9)
    assert result.residual == pytest.approx(residual, rel=1e-3)


def test_zero_matrix(spark):
    result = cw.power_iteration(generate.zero(spark, 4, 4), steps=3)
    assert np.allclose(values(result.vector), 0.0375)
    assert result.residual == 0


def test_square_only(spark):
    with pytest.raises(ValueError, match="square"):
        cw.power_iteration(sparse(spark, A))


def test_hot_column_is_cut_in_the_layout(spark, monkeypatch):
    monkeypatch.setattr(iterate, "COLUMN_PIECE", 5)
    m = np.eye(30)
    m[:, 3] = np.arange(1, 31)
    laid_out = iterate._ColumnLayout(sparse(spark, m.tolist()))
    assert [(r.k, r.p_n) for r in laid_out.heavy.collect()] == [(3, 6)]
    y = laid_out.times(vector(spark, range(30)))
    assert np.allclose([r.x for r in y.orderBy("k").collect()], m @ np.arange(30))
    laid_out.release()


def test_a_layout_has_few_partitions_and_reads_its_matrix_once(spark, setting, monkeypatch):
    """Sums of rows combine in few partitions; more cells still make more of them."""
    setting("spark.sql.shuffle.partitions", "37")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    m = generate.uniform_rows(spark, 60, 60, 0.2)
    once = cw.Matrix(m.df.mapInArrow(counted, "i bigint, j bigint, v double"), m.shape)
    laid_out = iterate._ColumnLayout(once)
    assert laid_out.parts == spark.sparkContext.defaultParallelism
    y = laid_out.times(generate.dense_vector(spark, 60))
    assert np.allclose([r.x for r in y.orderBy("k").collect()], grid(m) @ values(generate.dense_vector(spark, 60)))
    assert read.value == m.df.count()
    laid_out.release()
    monkeypatch.setattr(iterate, "PARTITION_CELLS", 10)
    assert iterate._ColumnLayout._partitions(m, 1000) == 100


def test_layout_moves_only_vectors(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    a = generate.uniform_rows(spark, 50, 50, 0.1)
    laid_out = iterate._ColumnLayout(a)
    laid_out.cells.count()
    y = laid_out.times(generate.dense_vector(spark, 50))
    assert np.allclose([r.x for r in y.orderBy("k").collect()], grid(a) @ values(generate.dense_vector(spark, 50)))
    plan = y._jdf.queryExecution().executedPlan().toString()
    matrix_side = plan[plan.index("InMemoryTableScan"):]
    before = plan[: plan.index("InMemoryTableScan")].splitlines()[-2:]
    assert matrix_side and not any("Exchange" in line for line in before), plan
    laid_out.release()


def test_norm_and_distance(spark):
    a, b = vector(spark, [1, -2, 3]), vector(spark, [0, 0, 5])
    assert cw.l1_norm(a).first().norm == 6
    assert cw.l1_norm(vector(spark, [0, 0])).first().norm == 1
    assert cw.l1_distance(a, b).first().distance == 5
    with pytest.raises(ValueError):
        cw.l1_distance(a, vector(spark, [1]))


@pytest.mark.parametrize("layout", [False, True])
@pytest.mark.parametrize("broken", ["l1_norm", "l1_distance"])
def test_goes_on_after_the_last_complete_step(spark, tmp_path, monkeypatch, layout, broken):
    matrix, folder = sparse(spark, C), str(tmp_path / "state")
    whole = cw.power_iteration(matrix, steps=6, layout=layout, state=str(tmp_path / "whole"))
    calls, real = [], getattr(iterate, broken)

    def failing(*args):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(iterate, broken, failing)
    with pytest.raises(RuntimeError, match="lost"):
        cw.power_iteration(matrix, steps=6, layout=layout, state=folder)
    assert [r.step for r in spark.read.parquet(f"{folder}/steps").orderBy("step").collect()] == [1, 2, 3]
    resumed = cw.power_iteration(matrix, steps=6, layout=layout, state=folder)
    # Three steps before the loss, the lost one, and three after it.
    assert len(calls) == 7
    assert np.allclose(values(resumed.vector), values(whole.vector), atol=1e-15)
    rows = [tuple(r) for r in resumed.history.orderBy("step").collect()]
    wanted = [tuple(r) for r in whole.history.orderBy("step").collect()]
    assert [r[0] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert np.allclose(rows, wanted, atol=1e-15) and resumed.residual == rows[-1][2]
    # Two products are left, whatever the number of steps.
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["product-0", "product-1", "steps"]
    again = cw.power_iteration(matrix, steps=6, layout=layout, state=folder)
    assert len(calls) == 7 and again.residual == resumed.residual
    assert np.allclose(values(again.vector), values(whole.vector), atol=1e-15)
    assert cw.power_iteration(matrix, steps=4).residual == pytest.approx(rows[3][2], abs=1e-12)


def test_state_of_another_iteration_is_refused(spark, tmp_path):
    folder = str(tmp_path / "state")
    cw.power_iteration(sparse(spark, C), steps=2, state=folder)
    with pytest.raises(ValueError, match="alpha"):
        cw.power_iteration(sparse(spark, C), steps=3, alpha=0.5, state=folder)
    with pytest.raises(ValueError, match="entries"):
        cw.power_iteration(sparse(spark, G), steps=3, state=folder)
    with pytest.raises(ValueError, match="more than 1"):
        cw.power_iteration(sparse(spark, C), steps=1, state=folder)
