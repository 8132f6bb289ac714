import math

import numpy as np
import pytest
from helpers import A, B, D, V, grid, text_file, values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cellwise.functions.text import INVISIBLE, clipped, number, tokens
from cellwise.model import Shape
from cellwise.operators import profile
from cellwise.operators.multiply import multiply_text, multiply_text_lenient
from cellwise.operators.prefix import prefix_sums
from cellwise.sources import text

BOM = "﻿"


def csv(rows):
    return "\n".join(",".join(map(str, row)) for row in rows) + "\n"


def numbered(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "row bigint, value string")


def column(spark, expression, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r.out for r in df.select(expression(F.col("t")).alias("out")).collect()]


def test_tokens_drop_empty_ends(spark):
    found = column(spark, tokens, ["1,,3", "1,2,,", ",", "", "a"])
    assert found == [["1", "", "3"], ["1", "2"], [], [""], ["a"]]


def test_numbers(spark):
    texts = ["1", " 2\t", "1e3", "-0.0", "NaN", "Infinity", "-Infinity", "nan", "inf", "INFINITY", "", "x", "1d"]
    found = column(spark, number, texts)
    assert found[:4] == [1, 2, 1000, 0] and math.isnan(found[4])
    assert found[5:] == [math.inf, -math.inf, None, None, None, None, None, 1]


def test_grid_with_byte_order_mark(spark, tmp_path):
    m = text.read_grid(spark, text_file(tmp_path / "a.csv", BOM + csv(A)))
    assert m.shape == Shape(4, 5) and np.array_equal(grid(m), A)


def test_dense_keeps_zeros(spark, tmp_path):
    m = text.read_dense(spark, text_file(tmp_path / "a.csv", csv(A)))
    assert m.shape == Shape(4, 5)
    assert [r.row for r in m.df.orderBy("k").collect()] == A
    assert m.cells().count() == 20
    assert text.read_dense(spark, text_file(tmp_path / "e.csv", "")).shape == Shape(0, 0)


def test_strict_numbers_after_dropping_lines(spark, tmp_path):
    path = text_file(tmp_path / "m.csv", "# left\n1,0\n\n0,2\nx,3\n")
    m = text.read_grid(spark, path)
    assert m.shape == Shape(2, 2) and np.array_equal(grid(m), [[1, 0], [0, 2]])


def test_strict_fails_where_lenient_moves_left(spark, tmp_path):
    path = text_file(tmp_path / "m.csv", "1,,3\n4,x,6\n\n7\n")
    with pytest.raises(PySparkException):
        text.strict_cells(text.read_lines(spark, path, "numeric")).collect()
    m = text.read_grid(spark, path, "lenient")
    assert m.shape == Shape(4, 3)
    assert np.array_equal(grid(m), [[1, 3, 0], [4, 0, 6], [0, 0, 0], [7, 0, 0]])
    with pytest.raises(ValueError, match="ragged"):
        text.read_grid(spark, text_file(tmp_path / "r.csv", "1,2\n3\n"))


def test_lines_are_numbered_across_files_and_blocks(spark, tmp_path, setting):
    setting("spark.sql.files.maxPartitionBytes", "64")
    setting("spark.sql.files.openCostInBytes", "16")
    lines = [f"{n}" for n in range(400)]
    for part, size in enumerate((250, 3, 147)):
        begin = sum((250, 3, 147)[:part])
        text_file(tmp_path / f"part-{part}.txt", "\n".join(lines[begin : begin + size]) + "\n")
    read = text.read_lines(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() > 4
    assert sorted((r.row, r.value) for r in read.collect()) == list(enumerate(lines))
    odd = text.read_lines(spark, str(tmp_path), "numeric").where("value % 2 = 1")
    assert odd.where("row <> value").count() == 0
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert sorted((r.row, r.value) for r in text.read_lines(spark, str(tmp_path)).collect()) == list(enumerate(lines))


def test_vectors_in_both_layouts(spark, tmp_path):
    row = text_file(tmp_path / "row.csv", BOM + ",".join(map(str, V)))
    col = text_file(tmp_path / "col.csv", "\n".join(map(str, V)) + "\n\n")
    for path in (row, col):
        v = text.read_vector(spark, path)
        assert v.n == 5 and values(v).tolist() == V and v.df.count() == 5
        assert text.read_vector(spark, path, sparse=True).df.count() == 2
    skipping = text.read_vector(spark, text_file(tmp_path / "s.csv", "3\nx\n\n5\n"))
    assert {r.k: r.x for r in skipping.df.collect()} == {0: 3.0, 2: 5.0}
    several = text_file(tmp_path / "f.csv", "\n1,2\n3,4\n")
    with pytest.raises(ValueError, match="several lines"):
        text.read_vector(spark, several)
    first_only = text.read_vector(spark, several, first_line_only=True)
    assert values(first_only).tolist() == [1, 2]
    strict = text.read_vector(spark, text_file(tmp_path / "t.csv", "# x\n3\n5\n"), "column", "strict")
    assert values(strict).tolist() == [3, 5]
    with pytest.raises(ValueError, match="column"):
        text.read_vector(spark, row, "column", "strict")
    with pytest.raises(ValueError, match="empty"):
        text.read_vector(spark, text_file(tmp_path / "e.csv", "\n \n"))


def test_normalize(spark):
    raw = f"{INVISIBLE}1 0\t2\r\n\r\n ​ \n 1, 2 \n3"
    df = spark.createDataFrame([(7, raw)], "id int, raw string")
    rows = text.normalize_text(df, "id", "raw").orderBy("pos").collect()
    assert [(r.pos, r.value) for r in rows] == [(0, "1,0,2"), (3, "1,,2"), (4, "3")]


def test_sparsity(spark):
    def of(lines):
        return profile.line_sparsity(numbered(spark, lines)).first()

    assert tuple(of(["1,0,0", "x,2"])) == (2, 4, 0.5, False)
    assert tuple(of(["1,0,0", "0,,"])) == (1, 4, 0.25, True)
    assert tuple(of([])) == (0, 0, 0.0, True)


def test_shapes(spark):
    assert profile.strict_shape(numbered(spark, ["1,2,3", "note", "4,5,6"])) == Shape(2, 3)
    assert profile.lenient_shape(numbered(spark, ["1,2,3", " ", "a,b"])) == Shape(2, 2)
    for lines, message in [([], "empty"), (["a", ""], "no line"), (["1", "1,2"], "not rectangular")]:
        with pytest.raises(ValueError, match=message):
            profile.strict_shape(numbered(spark, lines))


def test_vector_files(spark):
    files = {
        "row": ["1,2,3"], "row_end": ["1,2,,"], "text": ["1,x"], "gap": ["1,,2"], "col": ["1", " 2 "],
        "wide": ["1,2", "3,4"], "blank": ["1", ""], "one": ["5"],
    }
    lines = [(name, line) for name, content in files.items() for line in content] + [("none", None)]
    df = spark.createDataFrame(lines, "file string, value string")
    kinds = {r.file: r.kind for r in profile.classify_vector_files(df).collect()}
    assert kinds == {
        "row": "row vector", "row_end": "row vector", "text": "single line with other text",
        "gap": "single line with other text", "col": "column vector", "wide": "neither", "blank": "neither",
        "one": "row vector", "none": "empty",
    }


def test_result_cells(spark):
    df = spark.createDataFrame([(2000, 1000), (2001, 1000), (7, 0)], "a_rows int, b_cols int")
    found = [(r.cells, r.preview_used) for r in profile.result_cells(df).collect()]
    assert found == [(2_000_000, False), (2_001_000, True), (7, False)]


def test_clipping(spark):
    assert column(spark, lambda c: clipped(c, 3), ["abc", "abcd"]) == ["abc", "abc …"]


def test_multiply_text(spark, tmp_path):
    left = text_file(tmp_path / "a.csv", BOM + csv(A))
    assert np.array_equal(
        grid(multiply_text(spark, left, text_file(tmp_path / "b.csv", csv(B)))), np.array(A) @ np.array(B)
    )
    for x in ("\n".join(map(str, D)) + "\n", ",".join(map(str, D))):
        y = multiply_text(spark, left, text_file(tmp_path / "x.csv", x))
        assert values(y).tolist() == [31, 14, 0, 20]
    with pytest.raises(ValueError, match="not sparse"):
        multiply_text(spark, text_file(tmp_path / "b.csv", csv(B)), left)


def test_thousands_of_small_files_are_numbered_without_one_window(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    rng = np.random.default_rng(1)
    lines = []
    for n in range(1500):
        own = [f"{n}:{k}" for k in range(int(rng.integers(0, 4)))]
        (folder / f"{n:05d}.txt").write_text("".join(f"{line}\n" for line in own))
        lines += own
    scanned = text.scan_lines(spark, str(folder))
    assert [(r.row, r.value) for r in scanned.df.orderBy("row").collect()] == list(enumerate(lines)) and scanned.count == len(lines)
    assert "SinglePartition" not in scanned.df._jdf.queryExecution().executedPlan().toString()


def test_prefix_sums_over_several_ranges(spark, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    values = [(n, (n * 7) % 5) for n in range(1000)]
    df = spark.createDataFrame(values[::-1], "k bigint, n bigint").repartition(5)
    sums = prefix_sums(df, ["k"], "n", "before")
    assert sums.select(F.spark_partition_id()).distinct().count() > 1
    assert sorted(tuple(r) for r in sums.collect()) == [(k, n, sum(v for _, v in values[:k])) for k, n in values]
    assert prefix_sums(df.where("false"), ["k"], "n", "before").count() == 0


def test_lenient_text_products(spark, tmp_path):
    left = text_file(tmp_path / "a.csv", "1,x,2\n,3\n\n0,4,5,6\n")
    lying = text_file(tmp_path / "x.csv", "\n1,0,?,2\n9,9\n")
    standing = text_file(tmp_path / "y.csv", "1\n0\nz\n2\n")
    # Tokens move left past an empty one; rows that meet no entry are missing, entries may be zero.
    for path in (lying, standing):
        found = multiply_text_lenient(spark, left, path, vector=True)
        assert {r.k: r.x for r in found.df.collect()} == {0: 1.0, 1: 3.0, 3: 12.0}
    right = text_file(tmp_path / "b.csv", "1,2\n3\n0,q,5\n")
    product = multiply_text_lenient(spark, left, right, vector=False)
    cells = {(r.i, r.j): r.v for r in product.df.collect()}
    assert str(product.shape) == "4x3" and cells == {(0, 0): 1.0, (0, 1): 2.0, (0, 2): 10.0, (1, 0): 3.0, (1, 1): 6.0, (3, 0): 12.0, (3, 2): 25.0}


def test_each_text_file_of_a_product_is_scanned_twice(spark, tmp_path, monkeypatch):
    from cellwise.operators import multiply as mul

    scans = []
    scan = text.scan_lines
    monkeypatch.setattr(text, "scan_lines", lambda *a, **k: scans.append(a[1]) or scan(*a, **k))
    paths = [text_file(tmp_path / n, "1,0,0\n0,0,2\n0,0,0\n") for n in ("l.csv", "r.csv")]
    product = mul.multiply_text(spark, *paths)
    assert scans == paths
    assert {(r.i, r.j): r.v for r in product.df.collect()} == {(0, 0): 1.0}
