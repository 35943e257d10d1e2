"""Retrieval against brute force, upserts of single cells, typed styles and reviews on hand-written cases."""

import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestream.functions import style
from lodestream.operators import retrieval, reviews
from lodestream.plans.event_streams import checkpoint


def brute(rows, queries, k, match=False):
    there = {i: (np.array(v, float) / np.linalg.norm(v), m) for i, v, m in rows}
    out = {}
    for q, v, m in queries:
        u = np.array(v, float) / np.linalg.norm(v)
        near = sorted((-round(float(u @ w), 12), i) for i, (w, n) in there.items() if i != q and (not match or m == n))
        out[q] = [i for _, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["id"])
    return out




@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(7)
    centres = r.normal(size=(30, 16)) * 2
    return [(i, (centres[i % 30] + r.normal(size=16)).tolist(), "ab"[i % 2]) for i in range(6000)]


def test_recall_and_filters(spark, vectors):
    df = spark.createDataFrame(vectors, "id long, v array<double>, m string")
    cells = retrieval.fit_cells(df, "v", "id", cells=40, sample_rows=2000)
    made = retrieval.index(df, "v", cells)
    asked = [x for x in vectors if x[0] % 100 == 0]
    queries = spark.createDataFrame(asked, "query_id long, v array<double>, m string")
    for match in (None, "m"):
        got, want = found(retrieval.search(made, queries, "id", "v", cells, 10, 8, match)), brute(vectors, asked, 10, bool(match))
        assert got.keys() == want.keys() and sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 10 * len(want)
    # With all cells the answer is exact; few rows left by a filter are all found.
    assert found(retrieval.search(made, queries, "id", "v", cells, 10, 40)) == brute(vectors, asked, 10)
    few = [x for x in vectors if x[0] % 997 == 3]
    left = retrieval.matching(made.withColumn("text", F.concat(F.lit("t"), F.col("id") % 997, F.lit("!"))), {"m": "b"}, {"text": "t3!"})
    assert found(retrieval.search(left, queries, "id", "v", cells, 10, 1)) == brute([x for x in few if x[2] == "b"], asked, 10)


def test_odd_vectors_and_crowded_cells(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "SLICE_ROWS", 7)
    rows = [(i, [1.0, 0.0], "a") for i in range(100)] + [(200, [0.0, 2.0], "a"), (201, None, "a"), (202, [0.0, 0.0], "a"), (203, [float("nan"), 1.0], "a"), (204, [None, 1.0], "a")]
    df = spark.createDataFrame(rows, "id long, v array<double>, m string")
    cells = retrieval.fit_cells(df, "v", "id", cells=8)
    queries = spark.createDataFrame([(5, [2.0, 0.1], "a"), (300, [0.0, 1.0], "zz"), (301, None, "a")], "query_id long, v array<double>, m string")
    made = retrieval.index(df, "v", cells)
    assert made.count() == 101
    assert found(retrieval.search(made, queries, "id", "v", cells, 3)) == {5: [0, 1, 2], 300: [200, 0, 1]}
    assert found(retrieval.search(made, queries, "id", "v", cells, 3, match="m")) == {5: [0, 1, 2]}
    assert retrieval.search(made.limit(0), queries, "id", "v", cells, 3).count() == 0 and retrieval.fit_cells(df.limit(0), "v", "id") is None


def test_upsert_touches_its_cells_only(spark, tmp_path, vectors):
    path = str(tmp_path / "index")
    df = spark.createDataFrame(vectors[:600], "id long, v array<double>, m string")
    cells = retrieval.fit_cells(df, "v", "id", cells=12)
    retrieval.write_index(retrieval.index(df, "v", cells), path)
    files = lambda: {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = files()
    own = {r["id"]: r["cell"] for r in spark.read.parquet(path).collect()}
    moved = [(0, vectors[1][1], "new"), (9000, vectors[1][1], "new")]
    retrieval.upsert(spark, path, spark.createDataFrame(moved, df.schema), "id", "v", cells, checkpoint)
    after = {r["id"]: (r["cell"], r["m"]) for r in spark.read.parquet(path).collect()}
    assert after[0] == after[9000] == (own[1], "new") and len(after) == 601
    assert {i: c for i, (c, _) in after.items() if i not in (0, 9000)} == {i: c for i, c in own.items() if i}
    assert len(before.keys() & files().keys()) >= len(before) - 2
    lone = spark.createDataFrame([(i, v, m) for i, v, m in [(x[0], x[1], "z") for x in vectors[:600] if own[x[0]] == own[5]]], df.schema)
    away = lone.withColumn("v", F.lit(vectors[1][1]).cast("array<double>")) if own[5] != own[1] else lone
    retrieval.upsert(spark, path, away, "id", "v", cells, checkpoint)
    assert spark.read.schema("id long, v array<double>, m string, cell int").parquet(path).count() == 601


def test_rates_of_edits(spark):
    words = ["Because", "don't", "straight", "ok", "letters", "you"]
    df = spark.createDataFrame([(i,) for i in range(2000)], "i long").withColumn("t", F.lit(" ".join(words)))
    for name, (typos, shorts, lowers, bare) in style.RATES.items():
        c = {"careless": 0.1, "casual": 0.5, "careful": 0.9}[name]
        out = [r[0] for r in df.select(style.styled(F.col("t"), F.col("i"), style.rates(F.lit(c)))).collect()]
        again = [r[0] for r in df.repartition(5).orderBy("i").select(style.styled(F.col("t"), F.col("i"), style.rates(F.lit(c)))).collect()]
        assert out == again
        split = [t.split(" ") for t in out]
        assert {len(w) for w in split} == {6} and all(sorted(w[2].lower()) == sorted("straight") and w[3] == "ok" for w in split)
        near = lambda share, rate: abs(share - rate) < 0.04
        assert near(sum(w[2] != "straight" for w in split) / 2000, typos) and near(sum(w[5] == "u" for w in split) / 2000, shorts)
        assert near(sum(w[1] == "dont" for w in split) / 2000, bare) and near(sum(t[0].islower() and not t.startswith("bc") for t in out) / max(1, sum(not t.lower().startswith("bc") for t in out)), lowers)
    assert [r[0] for r in df.limit(3).select(style.styled(F.lit(None).cast("string"), F.col("i"), style.rates(F.lit(0.1)))).collect()] == [None] * 3
    assert all(re.match("[a-z]", r[0]) for r in df.limit(50).select(style.styled(F.col("t"), F.col("i"), style.rates(F.lit(None).cast("double"), F.lit("Gen Z")))).collect())


TURNS = "k int, turn long, text string, n_calls int, tags array<string>, user_text string"


def test_reviews(spark):
    rows = [
        (1, 0, "", 1, [], None), (1, 1, "hi", 0, [], "u"), (1, 2, " ", 2, [], None), (1, 3, "ask", 0, ["consent_gate"], "v"), (1, 4, "go", 1, [], None), (1, 5, "no\n\nCatch you", 0, ["adversarial_refusal"], "w"),
        (2, 0, "no", 0, ["adversarial_refusal"], None), (2, 1, None, 0, [], "x"),
    ]
    df = spark.createDataFrame(rows, TURNS)
    got = {(r["k"], r["turn"], r["code"]) for r in reviews.quick_issues(df, ["k"], "Catch you").collect()}
    assert got == {(1, 0, "silent call"), (1, 2, "silent call"), (1, 2, "two answers in a row"), (1, 5, "ends with a refusal"), (1, 5, "refusal with a closing")}
    made = [tuple(r) for r in reviews.mend_turns(df, ["k"], "Catch you", F.lit("ok"), F.lit("bye")).filter("turn > 4").orderBy("turn").collect()]
    assert made == [(1, 5, "no", 0, ["adversarial_refusal"], "w"), (1, 6, "bye", 0, [], "ok")]
    assert {(r["k"], r["code"]) for r in reviews.quick_issues(reviews.mend_turns(df, ["k"], "Catch you", F.lit("ok"), F.lit("bye")), ["k"], "Catch you").filter("code LIKE '%refusal%'").collect()} == set()


def test_flows(spark):
    replies = ['{"text": "x"}', '{"consent_flow": {}, "text": "kept"}', '{"consent_flow": true}', "[1]", None, "{"]
    df = spark.createDataFrame(list(enumerate(replies)), "i int, r string")
    got = [(r["i"], r["seq"], r["text"], r["user_text"], r["consent"]) for r in reviews.expand_flows(df, ["i"], "r").orderBy("i", "seq").collect()]
    assert [g for g in got if g[0] in (0, 2)] == [(0, 0, "x", None, None), (2, 0, "", None, None), (2, 1, "", "yes", "granted")] and {g[0] for g in got} <= {0, 1, 2}
