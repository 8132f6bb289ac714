import re
import zlib

import numpy as np
import pytest
from helpers import A, B, C, D, dense, sparse, values, vector
from pyspark.sql import functions as F

import cellwise as cw
from cellwise.functions import checksum as crc
from cellwise.model import Matrix, Shape, Vector
from cellwise.operators import layout
from cellwise.sources import generate, text


def as_text(rows, separator=", "):
    return [separator.join(str(float(v)) for v in row) for row in rows]


def test_dense_rows(spark):
    product = np.array(A) @ np.array(B)
    lines = cw.dense_rows(cw.spdm(sparse(spark, A), dense(spark, B))).orderBy("i").collect()
    assert [r.line for r in lines] == as_text(product)
    assert lines[2].line == "0.0, 0.0, 0.0, 0.0"


@pytest.mark.parametrize("width", [1, 2, 3, 5, 99])
def test_segments_join_to_the_line(spark, width):
    rows = cw.dense_rows(sparse(spark, C), width).orderBy("i", "seg").collect()
    lines = {}
    for r in rows:
        lines.setdefault(r.i, []).append(r.line)
    assert [", ".join(parts) for parts in lines.values()] == as_text(C)
    assert len(rows) == 5 * -(-5 // width)


@pytest.mark.parametrize("block", [1, 4, 1 << 18])
def test_empty_segments_are_not_shuffled(spark, monkeypatch, block):
    """One marker a block of segments goes out, whatever the number of segments."""
    monkeypatch.setattr(layout, "BLOCK_CELLS", block)
    monkeypatch.setattr(layout, "TASK_SEGMENTS", 64 if block == 4 else 1 << 18)
    m = Matrix(spark.createDataFrame([(0, 3, 1.5), (0, 41, 2.0), (2, 0, 3.0), (2, 3, 4.0)], "i bigint, j bigint, v double"), Shape(4, 101))
    lines = cw.dense_rows(m, 2)
    found = {}
    for r in lines.orderBy("i", "seg").collect():
        found.setdefault(r.i, []).append(r.line)
    assert [len(found[i]) for i in range(4)] == [51] * 4
    full = np.zeros((4, 101))
    full[0, 3], full[0, 41], full[2, 0], full[2, 3] = 1.5, 2, 3, 4
    assert [", ".join(found[i]) for i in range(4)] == as_text(full)
    assert len(re.findall(r"Range \(0, (\d+)", lines._jdf.queryExecution().analyzed().toString())) == 1
    markers = int(re.findall(r"Range \(0, (\d+)", lines._jdf.queryExecution().analyzed().toString())[0])
    assert markers == 4 * -(-51 // max(1, block // 2))


def test_cells_outside_the_shape_are_left_out(spark):
    m = Matrix(sparse(spark, C).df, Shape(2, 3))
    assert [r.line for r in cw.dense_rows(m).orderBy("i").collect()] == ["4.0, 1.0, 9.0", "0.0, 7.0, 0.0"]


def test_vector_line(spark):
    y = cw.spmv(sparse(spark, A), vector(spark, D))
    assert [r.line for r in cw.vector_line(y).collect()] == ["31.0,14.0,0.0,20.0"]
    gaps = Vector(spark.createDataFrame([(2, 5.0)], "k bigint, x double"), 5)
    assert [r.line for r in cw.vector_line(gaps, 2).orderBy("seg").collect()] == ["0.0,0.0", "5.0,0.0", "0.0"]


def test_preview_and_glance(spark):
    wide = generate.uniform_rows(spark, 150, 300, 0.1)
    assert cw.preview(wide).count() == 100
    full = {r.i: r.line for r in cw.dense_rows(wide).where("i < 20").collect()}
    for r in cw.glance(wide).collect():
        assert r.line == full[r.i][:120] + " …"
    assert cw.glance(wide).count() == 20
    assert cw.glance(sparse(spark, A)).orderBy("i").first().line == "4.0, 0.0, 9.0, 0.0, 0.0"


def test_checksum_of_a_known_text(spark):
    y = cw.spmv(sparse(spark, [[4, 0, 9], [0, 7, 0], [0, 0, 5]]), vector(spark, [1, 2, 3]))
    assert cw.checksum(y).first().crc32 == "b00503e6"


@pytest.mark.parametrize("width", [1, 4, 64])
def test_checksum_equals_that_of_the_whole_text(spark, monkeypatch, width):
    monkeypatch.setattr(crc, "_GROUP", 3)
    m = generate.uniform_rows(spark, 17, 23, 0.2)
    lines = [r.line for r in cw.dense_rows(m).orderBy("i").collect()]
    assert cw.checksum(m, width).first().crc32 == f"{zlib.crc32('\n'.join(lines).encode()):08x}"


def test_order(spark):
    m = generate.uniform_rows(spark, 40, 30, 0.1)
    cells = [(r.i, r.j) for r in m.df.collect()]
    assert [(r.i, r.j) for r in cw.by_row(m).collect()] == sorted(cells)
    assert [(r.j, r.i) for r in cw.by_col(m).collect()] == sorted((j, i) for i, j in cells)
    within = cw.by_row(m, "within").withColumn("part", F.spark_partition_id()).collect()
    for part in {r.part for r in within}:
        rows = [(r.i, r.j) for r in within if r.part == part]
        assert rows == sorted(rows)


def test_text_round_trip(spark, tmp_path):
    m = generate.uniform_rows(spark, 30, 12, 0.2)
    path = str(tmp_path / "m")
    layout.write_matrix_text(m, path, number_format="%.2f")
    back = text.read_grid(spark, path)
    assert back.shape == m.shape
    assert sorted(map(tuple, back.df.collect())) == sorted(map(tuple, m.df.collect()))
    for as_column in (True, False):
        x = generate.dense_vector(spark, 25)
        path = str(tmp_path / f"x{as_column}")
        layout.write_vector_text(x, path, as_column)
        assert np.allclose(values(text.read_vector(spark, path)), values(x))


def test_written_segments_and_whole_rows(spark, tmp_path):
    m = cw.Matrix(spark.createDataFrame([(0, 0, 1.0), (1, 4, 2.0)], "i bigint, j bigint, v double"), cw.Shape(2, 5))
    layout.write_matrix_text(m, str(tmp_path / "rows"))
    layout.write_matrix_text(m, str(tmp_path / "segments"), width=3)
    written = {name: [r.value for r in spark.read.text(str(tmp_path / name)).collect()] for name in ("rows", "segments")}
    assert sorted(written["rows"]) == ["0.0,0.0,0.0,0.0,2.0", "1.0,0.0,0.0,0.0,0.0"]
    assert sorted(written["segments"]) == ["0.0,0.0", "0.0,0.0,0.0", "0.0,2.0", "1.0,0.0,0.0"]


def test_checksum_of_nothing(spark):
    empty = spark.createDataFrame([], "k bigint, x double")
    assert [r.crc32 for r in layout.checksum(cw.Vector(empty, 0)).collect()] == ["00000000"]


def test_repeats_and_bounds_of_tables(spark):
    rows = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 5.0), (2, 7.0), (-1, 9.0), (None, 3.0)], "k bigint, x double")
    assert sorted(map(tuple, cw.vector_from_table(rows, "k", "x", 2).df.collect())) == [(0, 3.0), (1, 5.0)]
    cells = spark.createDataFrame([(0, 0, 1.0), (5, 0, 2.0), (0, 2, 3.0), (1, 1, 4.0), (None, 0, 1.0)], "i bigint, j bigint, v double")
    for duplicates in ("sum", "none"):
        found = cw.coo_from_table(cells, "i", "j", "v", cw.Shape(2, 2), duplicates=duplicates)
        assert sorted(map(tuple, found.df.collect())) == [(0, 0, 1.0), (1, 1, 4.0)]

def test_table_formats(spark, tmp_path):
    m = sparse(spark, C)
    for file_format in ("parquet", "csv", "orc", "json"):
        path = str(tmp_path / file_format)
        layout.write_table(m.df, path, file_format)
        reader = spark.read.schema(m.df.schema)
        back = reader.csv(path, header=True) if file_format == "csv" else reader.format(file_format).load(path)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, m.df.collect()))
