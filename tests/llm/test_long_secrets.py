"""Secrets are found to their ends, however long."""

import random
import string
import time

from lodestream.llm import pii

ALL = frozenset(range(len(pii.KINDS) * 3 ** len(pii.LABELERS)))


def secrets(text):
    return [text[s:e] for k, s, e in pii.spans_of(text, ALL)[1] if pii.KINDS[k] == "secret"]


def test_secrets_to_their_end():
    r = random.Random(4)
    long = "".join(r.choice(string.ascii_letters + "_-") for _ in range(100_000))
    for n in (8, 40, 200, 201, 450, 100_000):
        assert secrets(f"set token={long[:n]} end") == [long[:n]]
    for n in (12, 80, 81, 180, 100_000):
        assert secrets(f"key sk-{long[:n]}, end") == ["sk-" + long[:n]]


def test_secret_around_a_base_span():
    value = "a" * 300 + "4111111111111111" + "b" * 300
    assert secrets(f"token={value} end") == ["a" * 300, "b" * 300]
    assert pii.spans_of(f"token={value} end", ALL)[0] == [(2, 306, 322)]


def test_linear():
    start = time.process_time()
    for text in ("sk-" * 100_000, "token=" * 50_000, "token=" + "1.2.3.4," * 20_000, "password=a " * 30_000):
        pii.spans_of(text, ALL)
    assert time.process_time() - start < 20
