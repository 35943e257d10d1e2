"""Whitening against a plain eigendecomposition in exact sums, and on edge cases."""

import math

import numpy as np
import pytest

from lodestream.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, id long, vector string, n int"


def plain(vectors):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    centred = x - sums / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred, values[::-1], parts[:, ::-1]


def compared(rows, ids, vectors, count):
    n, deviation, centred, values, parts = plain(vectors)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(by) == len(rows) == len(ids) * count
    assert {r["n"] for r in rows} == {n}
    for k in range(count):
        got = np.array([by[i, k + 1]["whitened"] for i in ids])
        want = centred @ parts[:, k] / math.sqrt(values[k])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
        assert all(abs(by[i, k + 1]["explained"] * values.sum() / values[k] - 1) < 1e-9 for i in ids)
    assert [by[i, 1]["deviation"] for i in ids] == deviation
    assert all(0 <= r["identity_error"] < 1e-9 for r in rows)


def test_query(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    compared(queries.op12_whitening(spark, sf).collect(), [r["vec_id"] for r in table], [list(r["embedding"]) for r in table], 8)


def test_many_blocks(spark):
    r = np.random.default_rng(1)
    vectors = (r.normal(size=(400, 5)) * [3, 2, 1, 0.5, 0.1] + 40).astype(np.float32).tolist()
    rows = [(i, v, 0, "x", 1) for i, v in enumerate(vectors)]
    bad = [(-1, None), (-2, []), (-3, [1.0] * 4), (-4, [1.0, None, 1.0, 1.0, 1.0]), (-5, [float("nan")] + [1.0] * 4), (-6, [float("inf")] * 5)]
    rows += [(i, v, 0, "x", 1) for i, v in bad]
    df = spark.createDataFrame(rows, SCHEMA).repartition(40)
    compared(whitening.whiten_vectors(df).collect(), range(400), vectors, 5)


def test_equal_ids_and_rows(spark):
    rows = [(None, [1.0, 2.0], 0, "", 0), (7, [1.0, 2.0], 0, "", 0), (7, [1.0, 2.0], 0, "", 0), (7, [3.0, 9.0], 0, "", 0)]
    out = whitening.whiten_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 8 and {r["n"] for r in out} == {4}
    assert {r["whitened"] for r in out if r["component"] == 2} == {None}  # two points lie on a line
    assert all(r["identity_error"] < 1e-9 for r in out)


def test_nothing_varies(spark):
    out = whitening.whiten_vectors(spark.createDataFrame([(1, [2.0, 2.0], 0, "", 0)], SCHEMA)).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in out] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    for rows in ([], [(1, None, 0, "", 0)]):
        none = whitening.whiten_vectors(spark.createDataFrame(rows, SCHEMA))
        assert none.collect() == [] and none.columns[0] == "vec_id"


def test_exact_beyond_longs(spark):
    rows = [(1, [1e30, 0.0], 0, "", 0), (2, [-1e30, 1.0], 0, "", 0), (3, [0.0, 2.0], 0, "", 0)]
    out = {r["vec_id"]: r["deviation"] for r in whitening.whiten_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {1: None, 2: None, 3: 1024**2 * 9}
    grid, n = np.array([[3_000_000_000, 0], [0, 0]]), 2
    model = whitening.Whitening(n, (3_000_000_000, 0), np.eye(2), np.ones(2), 1.0)
    assert whitening.deviations_of(grid, model) == [9 * 10**18, 9 * 10**18]


@pytest.mark.parametrize("d", [1, 2, 7, 16])
def test_jacobi(d):
    r = np.random.default_rng(d)
    a = r.normal(size=(d, d)) * 10.0 ** -np.arange(d)
    sizes, v = whitening.jacobi(a)
    assert np.allclose(v.T @ v, np.eye(d), atol=1e-13) and np.allclose(sizes, np.linalg.svd(a)[1], rtol=1e-9, atol=1e-300)
    assert np.allclose(np.linalg.norm(a @ v, axis=0), sizes, rtol=1e-9)
