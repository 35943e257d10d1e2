"""Searches of the graph index against brute force: recall, exact scores, ties, copies and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestream.llm import graph_index, queries

SCHEMA = "vec_id long, embedding array<float>, query_id long, score string, rank int, id int, vector string"


def brute(rows, k=20):
    rows = sorted({(i, tuple(float(c) for c in v)) for i, v in rows})
    out = []
    for i, v in rows:
        if i % 20 == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in rows if j != i)
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(near[:k])]
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "s", 2, 3, "v") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in graph_index.nearest_neighbours(df, F.col("id") % 20 == 0, **options).collect())


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=1e-12)


def test_query_recall(spark, sf):
    table = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    got = [tuple(r) for r in queries.op13_graph_index(spark, sf).collect()]
    want = brute(table.items())
    assert len(got) == len(want) and all(abs(s - table[q] @ table[v]) < 1e-12 for q, _, v, s in got)
    hit = len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}) / len(want)
    assert hit >= 0.99
    for q in {r[0] for r in got}:
        mine = sorted((r for r in got if r[0] == q), key=lambda r: r[1])
        assert [r[1] for r in mine] == list(range(1, 21)) and mine == sorted(mine, key=lambda r: (-r[3], r[2]))


def test_copies_and_ties(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=(30, 6)).astype(np.float32).tolist()
    rows = [(i, base[i % 30] if i % 3 else base[0]) for i in range(900)]
    same(found(spark, rows), sorted(brute(rows)))


def test_any_lengths_of_vectors(spark):
    r = np.random.default_rng(4)
    rows = [(i, (r.normal(size=4) * 10.0 ** r.integers(-3, 4)).astype(np.float32).tolist()) for i in range(200)]
    got, want = found(spark, rows), sorted(brute(rows))
    assert len({x[:1] + x[2:3] for x in got} & {x[:1] + x[2:3] for x in want}) >= 0.9 * len(want) and len(got) == len(want)


def test_edge_rows(spark):
    v = [[1.0, 0.0], [0.5, 0.5], [0.0, 1.0], [-1.0, 0.0]]
    rows = [(0, v[0]), (1, v[1]), (2, v[2]), (20, v[3]), (20, v[3]), (1, v[1]), (40, v[0])]
    bad = [(60, None), (80, []), (100, [0.0, 0.0]), (120, [float("nan"), 1.0]), (140, [None, 1.0]), (160, [1.0]), (180, [float("inf"), 0.0]), (None, v[0])]
    same(found(spark, rows + bad), sorted(brute(rows)))
    assert found(spark, []) == found(spark, bad) == found(spark, [(0, v[0])]) == []
    shared = found(spark, [(0, v[0]), (0, v[1]), (3, v[2])])
    assert [x[:3] for x in shared] == [(0, 1, 3), (0, 1, 3)]  # two queries of one id; neither finds the other
    same(found(spark, [(0, v[0]), (5, [-0.0, 1.0]), (4, [0.0, 1.0])]), [(0, 1, 4, 0.0), (0, 2, 5, 0.0)])


def test_many_batches_and_shards(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=8).astype(np.float32).tolist()) for i in range(3000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        got = found(spark, rows, shard_bytes=8 * 8 * 200)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute(rows)
    assert len({x[:1] + x[2:3] for x in got} & {x[:1] + x[2:3] for x in want}) >= 0.99 * len(want)


@pytest.mark.parametrize("n", [1, 2, 5, 300])
def test_graph_reaches_every_node(n):
    points = np.random.default_rng(n).normal(size=(n, 5))
    graph = graph_index.PrunedGraph(points, degree=8)
    assert graph.next.shape == (n, 8) and not (graph.next == np.arange(n)[:, None]).any()
    nodes, score = graph.nearest(points, n)
    assert (np.sort(nodes, 1) == np.arange(n)).all() and np.allclose(np.sort(score, 1), np.sort(points @ points.T, 1))
