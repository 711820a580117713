import math

import numpy as np
import pytest

from shelfmark.llm import eigen, whitening
from shelfmark.llm.queries import QUERIES

TABLE = "vec_id long, embedding array<float>"


def matrices():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 5, 64, 150):
        x = rng.standard_normal((400, size))
        yield f"random {size}", x.T @ x
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield "cluster", q @ np.diag([5.0] * 6 + [5 - 1e-13] * 3 + [1.0] * 31) @ q.T
    yield "near", q @ np.diag([5, 5 - 1e-5, 5 - 2e-5, 5 - 1e-9] + [4.0] * 36) @ q.T
    yield "equal", np.eye(12)
    yield "zero", np.zeros((9, 9))
    yield "ones", np.ones((20, 20))
    yield "diagonal", np.diag(np.arange(20.0))
    yield "rank 4", (lambda x: x.T @ x)(rng.standard_normal((4, 30)))
    wilkinson = np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    for scale in (1.0, 1e-200, 1e150):
        yield f"wilkinson {scale}", scale * wilkinson


@pytest.mark.parametrize("name, matrix", list(matrices()))
def test_eigenvectors(name, matrix):
    values, vectors = eigen.leading(matrix, min(8, len(matrix)))
    expected = np.linalg.eigvalsh(matrix)[::-1][: len(values)]
    size = np.abs(expected).max() or 1.0
    assert np.abs(values - expected).max() <= 1e-13 * size
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() <= 1e-13
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() <= 1e-13 * size


def test_sturm_counts():
    rng = np.random.default_rng(2)
    d, s = rng.standard_normal(30), rng.standard_normal(29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(s, 1) + np.diag(s, -1))
    at = np.concatenate([values - 1e-9, values + 1e-9])
    assert (eigen.count_below(d, s, at) == [np.sum(values < v) for v in at]).all()


def test_query_equals_direct_computation(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([[math.floor(1024 * c) + 100_000 for c in r["embedding"]] for r in table], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviations = {r["vec_id"]: sum((n * v - s) ** 2 for v, s in zip(row, sums)) for r, row in zip(table, x)}
    y = x.astype(float) - (sums / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(values)[::-1][:8]
    white = y @ vectors[:, order] / np.sqrt(values[order])
    rows = QUERIES["op13_embedding_whitening"](spark, folder).collect()
    assert len(rows) == 8 * n and {r["n"] for r in rows} == {n}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-10
    place = {r["vec_id"]: i for i, r in enumerate(table)}
    got = np.zeros_like(white)
    for r in rows:
        k = r["component"] - 1
        got[place[r["vec_id"]], k] = r["whitened"]
        assert r["deviation"] == deviations[r["vec_id"]]
        assert abs(r["explained"] - values[order][k] / values.sum()) < 1e-12
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-9


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25, 1.0]), (1, [0.5, 0.25, 1.0]), (None, [0.1, -0.2, 1.0]), (3, None), (4, [None, 1.0, 1.0]),
            (5, [nan, 0.0, 0.0]), (6, [0.0, inf, 0.0]), (7, [-0.3, -0.7, 1.0]), (8, [0.5]), (9, [])]
    table = spark.createDataFrame(rows, TABLE).selectExpr("*", "1 as Whitened", "2 as deviation", "3 as vector", "4 as i")
    fitted = whitening.fit(table)
    assert fitted.n == 6 and len(fitted.values) == 3 and abs(sum(fitted.explained) - 1) < 1e-12
    assert whitening.identity_error(table, fitted) < 1e-10
    out = whitening.whiten(table, fitted)
    assert out.columns == ["vec_id", "embedding", "vector", "i", "whitened", "deviation"]
    assert sorted((r["vec_id"] or 0) for r in out.collect()) == [0, 1, 1, 7, 8, 9]
    flat = table.where("vec_id = 1")  # no variance at all
    still = whitening.fit(flat)
    assert list(still.values) == [0, 0, 0] and whitening.identity_error(flat, still) == 0
    assert {tuple(r["whitened"]) for r in whitening.whiten(flat, still).collect()} == {(0, 0, 0)}
    for nothing in (table.where("false"), table.where("vec_id = 9"), table.where("vec_id = 3")):
        empty = whitening.fit(nothing)
        assert empty.explained == () and whitening.identity_error(nothing, empty) == 0
        assert all(r["whitened"] == [] for r in whitening.whiten(nothing, empty).collect())
    huge = spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1e30, 3.0])], TABLE)
    large = whitening.fit(huge)
    x = [[(1 << 53) + 100_000, 101_024], [-(1 << 53) + 100_000, 102_048], [(1 << 53) + 100_000, 103_072]]
    sums = [sum(c) for c in zip(*x)]
    assert [int(r["deviation"]) for r in whitening.whiten(huge, large).orderBy("vec_id").collect()] == [
        sum((3 * v - s) ** 2 for v, s in zip(row, sums)) for row in x]


def test_sums_do_not_depend_on_partitions(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    one, many = (whitening.fit(table.repartition(k)) for k in (1, 7))
    assert one.sums == many.sums and np.allclose(one.values, many.values, rtol=1e-12)
