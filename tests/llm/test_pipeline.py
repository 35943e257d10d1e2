"""The pipeline against a plain version of its stages."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_operators import brute_components, brute_lines, brute_quality, brute_simhash

from lodestream.llm import pii


@pytest.fixture(scope="module")
def staged(spark, sf, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(path := str(tmp_path_factory.mktemp(name) / "t"))
        before, docs = docs, spark.read.parquet(path)
        out.append((before.collect(), docs.collect()))
        assert name == "packing" or tuple(docs.columns) == corpus_pipeline.COLUMNS
    return out


def test_stages(staged):
    before, after = staged[0]
    assert Counter(after) == Counter(r for r in before if not brute_quality(r["text"])[-1])
    before, after = staged[1]
    assert Counter((r["doc_id"], r["text"]) for r in after) == Counter((d, t) for d, _, _, t in brute_lines(before, 10).elements())
    before, after = staged[2]
    prints = [(r["doc_id"], brute_simhash(r["text"])) for r in before]
    assert {r["doc_id"] for r in after} == set(brute_components(prints)) and len(after) == len(set(brute_components(prints)))
    before, after = staged[3]
    texts = {r["doc_id"]: r["text"] for r in after}
    for r in before:
        spans = pii.base_spans(r["text"])
        assert not spans or all(r["text"][s:e] not in texts[r["doc_id"]] or r["text"].count(r["text"][s:e]) > 1 for k, s, e in spans if k != 1)
        assert spans or "[" in texts[r["doc_id"]] or texts[r["doc_id"]] == r["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = staged[4]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}


def test_run_equals_stages(spark, sf, staged):
    got = corpus_pipeline.run(spark, sf).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    want = Counter()
    for r in staged[-1][1]:
        want[r["doc_id"]] += r["length"]
    assert {r["doc_id"]: r["n"] for r in got} == dict(want)


def test_empty_and_null_input(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(1, None, None, None, None), (2, "", None, None, 0), (2, "", None, None, 0)]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, sf)
            assert made.count() <= len(rows), name
