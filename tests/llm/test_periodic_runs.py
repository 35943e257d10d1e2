"""Periodic runs against a search of all periods, on edge cases, planted tails and the smallest table."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lodestream.llm import periodic_runs, queries

SCHEMA = "doc_id long, text string, id long, runs string, n_words int, collapsed string"


def brute_runs(words, least=12):
    found, n = [], len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(least, 2 * p):
                w = words[i : i + length]
                if not any(all(w[k] == w[k + q] for k in range(length - q)) for q in range(1, p)):
                    found.append((i, length, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    n = len(words)
    if doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 or not n:
        return words
    g = zlib.crc32(str(doc_id).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def edge_texts():
    r = random.Random(3)
    some = [" ".join(r.choice("ab") for _ in range(r.randrange(70))) for _ in range(40)]
    line = " ".join(f"w{i}" for i in range(30))
    return [
        None, "", " \n\t ", "x", "a " * 11, "a " * 12, "ab " * 5000, f"{line} {line}", f"{line} {line} w0", f"{line}\n x {line}", "a b " * 6, "a b " * 6 + "a",
        "é 日本 " * 9 + "z", "a b a b " * 9, "a  " * 12, "x y z " * 4 + "x y " * 6 + "q " * 20, *some,
    ]


def checked(rows, texts, least=12):
    got = {(r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in rows}
    want = set()
    for i, words in texts:
        runs = brute_runs(words, least)
        want.add((i, len(words), tuple(runs), brute_collapsed(words, runs)))
    assert got == want and len(rows) == len(texts)


@pytest.mark.parametrize("least", [2, 3, 12])
def test_edge_texts(spark, least):
    texts = list(enumerate(edge_texts()))
    texts += [texts[8], (None, "a b " * 9)]
    df = spark.createDataFrame([(i, t, 1, "r", 2, "c") for i, t in texts], SCHEMA)
    checked(periodic_runs.find_runs(df, least).collect(), [(i, words_of(t)) for i, t in texts], least)
    assert periodic_runs.find_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(df, 1)


def test_other_columns(spark):
    df = spark.createDataFrame([("k", "a b " * 9)], "`a.b` string, `t.x` string")
    row = periodic_runs.find_runs(df, id_col="`a.b`", text_col="`t.x`").collect()[0]
    assert row["a.b"] == "k" and row["collapsed"] == "a b"


def test_planted_table(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [(r["doc_id"], planted(r["doc_id"], words_of(r["text"]))) for r in table.collect()]
    short = [(i, w) for i, w in docs if len(w) < 1500]
    tails = periodic_runs.plant_tails(table)
    text = {r["doc_id"]: r["text"] for r in tails.collect()}
    assert {i: words_of(t) for i, t in text.items()} == dict(docs)
    found = periodic_runs.find_runs(tails)
    ids = [i for i, _ in short]
    checked(found.where(F.col("doc_id").isin(ids)).collect(), short)
    assert sum(bool(brute_runs(w)) for i, w in short if zlib.crc32(str(i).encode()) % 10 == 0) > 10
    assert found.where("size(runs) > 0").count() > 10


def test_query(spark, sf):
    table = {r["doc_id"]: planted(r["doc_id"], words_of(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: r.asDict() for r in queries.op11_periodic_runs(spark, sf).collect()}
    assert got.keys() == table.keys()
    for i, words in table.items():
        if len(words) > 1500:
            continue
        runs = brute_runs(words)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        want = {
            "doc_id": i, "n_runs": len(runs), "start": top[0], "length": top[1], "period": top[2], "exponent_milli": 1000 * top[1] // top[2] if runs else None,
            "runs_sha256": hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest(),
        }
        assert got[i] == want


def test_very_long_text(spark):
    words = [f"w{i % 70001}" for i in range(200_000)] + ["a", "b", "c"] * 100_000
    row = periodic_runs.find_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).collect()[0]
    assert [tuple(r) for r in row["runs"]] == [(0, 200_000, 70001), (200_000, 300_000, 3)]
    assert row["collapsed"] == " ".join(words[:70001] + ["a", "b", "c"])
