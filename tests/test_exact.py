import math
import random
import struct

import numpy as np
import pytest
from helpers import A, sparse, values, vector

import cellwise as cw
from cellwise.operators.exact import exact_sums


def bits(x):
    return None if x is None else struct.pack("<d", x)


def groups():
    draw = random.Random(5)
    mixed = [draw.uniform(-1, 1) * 2.0 ** draw.randint(-300, 300) for _ in range(500)]
    near = [draw.gauss(0, 1) for _ in range(3000)]
    return {
        "near": near,
        "cancelled": near + [-x for x in near] + [1e-30],
        "mixed": mixed,
        "mixed_cancelled": mixed + [-x for x in mixed[1:]],
        "prices": [round(draw.uniform(900, 100000), 2) for _ in range(3000)],
        "far": [1e300, 1.0, -1e300],
        "half_even": [2.0**53, 1.0],
        "half_up": [2.0**53, 1.0, 2.0**-200],
        "half_down": [2.0**53, 1.0, -(2.0**-200)],
        "powers": [2.0**e for e in range(-80, 81)] + [-(2.0**e) for e in range(-40, 81)],
        "negative": [-0.1] * 10,
        "largest": [1.7976931348623157e308, -1.7976931348623157e308, 5e-324, 5e-324],
        "zeros": [-0.0, 0.0],
        "minus_zero": [-0.0],
        "one": [0.1],
    }


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_nearest_double_for_any_partitions(spark, partitions):
    rows = [(g, x) for g, xs in groups().items() for x in xs] + [("near", None)]
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(partitions)
    found = {r.g: r.total for r in exact_sums(df, ["g"], "x").collect()}
    for g, xs in groups().items():
        assert bits(found[g]) == bits(math.fsum(xs) + 0.0), g


def test_specials_nulls_and_empty(spark):
    inf, nan = math.inf, math.nan
    cases = {"a": [inf, 1.0], "b": [-inf, inf], "c": [nan, 1.0], "d": [None, None], None: [1.5, None], "e": [-inf], "f": [1.7e308, 1.7e308]}
    df = spark.createDataFrame([(g, x) for g, xs in cases.items() for x in xs], "g string, x double")
    found = {r.g: r.total for r in exact_sums(df, ["g"], "x").collect()}
    assert found["a"] == inf and found["e"] == -inf and found["d"] is None and found[None] == 1.5 and found["f"] == inf
    assert math.isnan(found["b"]) and math.isnan(found["c"])
    assert exact_sums(df.where("false"), ["g"], "x").count() == 0
    assert [r.s for r in exact_sums(df.where("g is null"), [], "x", "s").collect()] == [1.5]
    assert [r.s for r in exact_sums(df.where("false"), [], "x", "s").collect()] == [None]


def test_products_and_norms(spark):
    x = [0.1, 0.7, -0.3, 1e-9, 3e8]
    exact = values(cw.spmv(sparse(spark, A), vector(spark, x), exact=True))
    assert exact.tolist() == [math.fsum(a * b for a, b in zip(row, x)) for row in A]
    without = cw.spmv(sparse(spark, A), vector(spark, x), zero_fill=False, exact=True).df.collect()
    assert sorted(r.k for r in without) == [0, 1, 3]
    y = np.random.default_rng(3).normal(size=999).tolist()
    assert cw.l1_norm(vector(spark, y), exact=True).first().norm == math.fsum(map(abs, y))
    assert cw.l1_norm(vector(spark, [0, 0]), exact=True).first().norm == 1
