"""Small inputs with known results, and numpy forms to compare with."""

import numpy as np

from cellwise.model import DenseMatrix, Shape, Vector
from cellwise.sources.generate import from_rows

A = [[4, 0, 9, 0, 0], [0, 7, 0, 0, 0], [0, 0, 0, 0, 0], [0, 0, 0, 5, 0]]
B = [[1, 4, 5, 6], [2, 6, 5, 1], [1, 1, 1, 2], [3, 3, 4, 3], [1, 2, 6, 2]]
S = [[1, 0, 0, 0], [0, 0, 4, 1], [2, 0, 0, 0], [3, 0, 0, 1], [0, 0, 2, 0]]
C = [[4, 1, 9, 0, 0], [0, 7, 0, 8, 0], [0, 0, 0, 0, 0], [0, 0, 0, 5, 0], [0, 5, 5, 0, 0]]
D = [1, 2, 3, 4, 5]
V = [0, 1, 0, 7, 0]


def sparse(spark, rows):
    return from_rows(spark, rows)


def dense(spark, rows):
    data = [(k, [float(v) for v in row]) for k, row in enumerate(rows)]
    return DenseMatrix(spark.createDataFrame(data, "k bigint, row array<double>"), Shape(len(rows), len(rows[0])))


def vector(spark, values, is_dense=True):
    data = [(k, float(x)) for k, x in enumerate(values)]
    return Vector(spark.createDataFrame(data, "k bigint, x double"), len(values), is_dense)


def grid(m):
    out = np.zeros((m.shape.rows, m.shape.cols))
    for r in m.df.collect():
        out[r.i, r.j] = r.v
    return out


def values(v):
    rows = v.df.collect()
    out = np.zeros(v.n)
    for r in rows:
        out[r.k] = r.x
    assert len({r.k for r in rows}) == len(rows)
    return out


def text_file(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)
