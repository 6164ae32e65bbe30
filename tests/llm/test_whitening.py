"""Whitening against numpy on all rows, exact integers, and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulstat.llm import whitening as W
from tests.llm.helpers import CLASHES

SF01 = "/root/testdata/sf0.01"
KIND = "vec_id long, embedding array<float>"


def expected(vectors):
    """Exact integers of every row, and the components of their covariance."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return dev, centred, e[::-1], u[:, ::-1]


def check(rows, ids, vectors, k):
    dev, centred, e, u = expected(vectors)
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(got) == set(ids) and len(rows) == k * len(ids)
    z = np.array([[got[i][c + 1]["whitened"] for c in range(k)] for i in ids])
    want = centred @ u[:, :k] / np.sqrt(e[:k])
    signs = np.sign((z * want).sum(axis=0))
    assert np.allclose(z * signs, want, atol=1e-7)
    assert [got[i][1]["deviation"] for i in ids] == dev
    assert all(abs(r["explained"] / (e[r["component"] - 1] / e.sum()) - 1) < 1e-6 and r["n"] == len(ids) for r in rows)
    errors = {r["identity_error"] for r in rows}
    assert len(errors) == 1 and errors.pop() < 1e-6
    assert np.abs(z.T @ z / len(ids) - np.eye(k)).max() < 1e-6


def test_table_equals_numpy(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    data = df.orderBy("vec_id").collect()
    check(W.component_rows(df).collect(), [r["vec_id"] for r in data], [r["embedding"] for r in data], 32)


def test_hot_vector_and_few_dimensions(spark):
    rng = np.random.default_rng(3)
    some = [[float(np.float32(c)) for c in v] for v in rng.normal(size=(60, 5))]
    rows = [(i, some[i % 60] if i % 3 else some[0]) for i in range(600)]
    got = W.component_rows(spark.createDataFrame(rows, KIND).repartition(7)).collect()
    check(got, [i for i, _ in rows], [v for _, v in rows], 5)
    model = W.whiten(spark.createDataFrame(rows, KIND), weights="one")[1]
    assert model.n == len({tuple(v) for _, v in rows}) < 61


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 0.25]), (2, [0.5, -0.25]), (2, [0.125, 0.75]), (None, [0.5, 0.25]), (9, [-0.5, 0.0])]
    odd = [(3, None), (4, []), (5, [0.5, None]), (6, [nan, 0.5]), (7, [0.5, -inf]), (8, [1.0]), (10, [1e30, 0.0])]
    df = spark.createDataFrame(good + odd, KIND)
    extra = df.withColumns({c: F.lit("?") for c in (*CLASHES, "n", "deviation", "whitened", "component", "pos")})
    out = W.component_rows(extra)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = out.collect()
    assert len(rows) == 2 * len(good) and {r["n"] for r in rows} == {5}
    dev = expected([v for _, v in good])[0]
    assert sorted((r["deviation"] for r in rows if r["component"] == 1)) == sorted(dev)
    assert W.component_rows(df.limit(0)).count() == 0
    assert W.component_rows(df.where("vec_id = 1")).count() == 0  # no variance
    assert W.component_rows(spark.createDataFrame(odd, KIND)).count() == 0


def test_flat_direction_gives_no_component(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a), float(b), float(a), 1.0]) for i, (a, b) in enumerate(rng.normal(size=(500, 2)))]
    got = W.component_rows(spark.createDataFrame(rows, KIND)).collect()
    assert {r["component"] for r in got} == {1, 2} and got[0]["identity_error"] < 1e-6


@pytest.mark.parametrize("y, n, rest", [([[3, -4], [0, 0]], 7, [2, -3]), ([[10 ** 9, 1]], 10, [5, 5]), ([[1 << 40, 0]], 3, [1, 1])])
def test_deviations_are_exact(y, n, rest):
    want = [sum((n * a - r) ** 2 for a, r in zip(row, rest)) for row in y]
    assert W.deviations(np.array(y, dtype=np.int64), n, rest) == [v if v < 1 << 63 else None for v in want]
