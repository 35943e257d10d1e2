"""Suffix dedup where one anchor hash has more contexts than a task may hold."""

import random
from collections import Counter

from test_operators import brute_repeats, prose

from lodestream.llm import suffix_dedup


def test_a_passage_in_many_contexts(spark, monkeypatch):
    most, sort = 16, suffix_dedup.repeated_windows

    def bounded(contexts, names, back, many, length):
        if max(Counter(names.tolist()).values()) > most:
            raise MemoryError("one anchor hash is held whole")
        return sort(contexts, names, back, many, length)

    monkeypatch.setattr(suffix_dedup, "repeated_windows", bounded)
    r, passage = random.Random(5), prose(6, 60)[:400]
    for length, grain in ((400, 96), (60, 20), (24, 23)):
        monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", most * 2 * length)
        monkeypatch.setattr(suffix_dedup, "OFTEN", 20, raising=False)
        texts = [f"{prose(r.random(), 40)}{passage}{prose(r.random(), 40)}" for _ in range(40)]
        texts += [f"{prose(r.random(), 9)}{passage[r.randrange(200):]}{prose(r.choice((1, 2)), 50)}" for _ in range(30)] + [passage] * 3 + [prose(9, 300)] * 2 + [None, ""]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        want = Counter((i, *x) for i, x in enumerate(brute_repeats(texts, length)))
        got = suffix_dedup.remove_repeats(df, length, grain).collect()
        assert Counter((x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], bytes(x["kept"])) for x in got) == want
