"""Redaction of payloads, fragments, surfaces and files on hand-written cases and against plain loops."""

import json
import re

import pytest
from pyspark.sql import functions as F

from lodestream.functions import json_text
from lodestream.functions import terms as T
from lodestream.operators import detect, redaction
from lodestream.plans import detection, redaction as plans

TOKEN = T.REDACTION_TOKEN


def held(spark, *values):
    """A row for each persona value: text, label, level."""
    rows = [(1, i, t, label, level) for i, (t, label, level) in enumerate(values)]
    return detect.held_by(spark.createDataFrame(rows, "k int, number int, text string, label string, level int"), ["k"])


def changed(spark, texts, column, values):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "k int, i int, text string").join(held(spark, *values), "k")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def walk(value, text, key):
    if isinstance(value, str):
        return text(value)
    if isinstance(value, list):
        return [walk(v, text, key) for v in value]
    return {key(k): walk(v, text, key) for k, v in value.items()} if isinstance(value, dict) else value


def test_json_strings_of_any_depth(spark):
    deep = '"x secret"'
    for i in range(300):
        deep = f'[{deep}, {i}]' if i % 2 else f'{{"secret {i}": {deep}}}'
    odd = ['{"a": "secret \\" \\\\", "secret\\n": "\\u00e9\\ud83d\\ude42 secret", "n": 1.50e3, "e": "", "t": [true, null, {}]}', '"secret"', "[]", " { } ", "12", '{"k":"' + "é\\\\" * 20_000 + 'secret"}', deep]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*odd, "no json secret {", '{"a": }', "", None])], "i int, t string")
    put = lambda c: F.regexp_replace(c, "secret", "***")
    for keys in (False, True):
        got = [r[0] for r in df.orderBy("i").select(json_text.transform_strings(F.col("t"), put, put if keys else None)).collect()]
        said = lambda s: s.replace("secret", "***")
        for old, new in zip(odd, got, strict=False):
            assert json.loads(new) == walk(json.loads(old), said, said if keys else lambda k: k)
        assert got[len(odd) :] == ["no json *** {", '{"a": }', "", None]
        assert "1.50e3" in got[0] and got[3] == " { } "


def test_surfaces(spark):
    """Users' words and arguments keep a value; thoughts, answers, results and approvals lose it."""
    secret = "4000 0000 0000 0002"
    rows = [
        (1, "user", f"use {secret}", None, None, None, None), (2, "assistant", f"I will use {secret}", f"I recall {secret}", None, None, f'{{"command": "charge {secret}"}}'),
        (3, "toolResult", f"processed {secret}", None, f'{{"all": ["processed {secret}"]}}', None, None), (4, "custom", None, None, None, f'{{"reason": {{"x": "approve {secret}"}}}}', None),
    ]
    df = spark.createDataFrame([(1, *r) for r in rows], "k int, i int, role string, text string, thinking string, details string, data string, args string").join(held(spark, (secret, "FIN_CC_FULL", 4)), "k")
    out = {r["i"]: r for r in redaction.redact_events(df, lambda c: redaction.redact(c, F.col("held"))).collect()}
    assert secret in out[1]["text"] and secret in out[2]["args"]
    assert out[2]["text"] == f"I will use {TOKEN}" and out[2]["thinking"] == f"I recall {TOKEN}" and out[3]["text"] == f"processed {TOKEN}"
    assert json.loads(out[3]["details"]) == {"all": [f"processed {TOKEN}"]} and json.loads(out[4]["data"]) == {"reason": {"x": f"approve {TOKEN}"}}


def test_medication_and_profile_lines(spark):
    text = "**Medications:**\n- Montelukast 10mg. daily\n- Metoprolol 25mg. twice daily\n- **__PII_REDACTED__:** Sensitive profile note. Uses Montelukast daily + rescue inhaler.\n"
    values = [("Montelukast 10mg daily", "HEALTH_MEDICATION", 3), ("Metoprolol 25mg twice daily", "HEALTH_MEDICATION", 3)]
    column = redaction.redact(F.col("text"), F.col("held"))
    out = changed(spark, [text], column, values)[0]
    assert not any(w in out for w in ("Montelukast", "Metoprolol", "rescue inhaler", "Sensitive profile note")) and out.count(TOKEN) >= 2
    assert changed(spark, ["- **Respiratory sensitivity:** avoid dusty or moldy produce\n"], column, [("asthma", "HEALTH_DIAGNOSIS", 3)]) == [""]
    assert "138 Central" not in changed(spark, ["ranked by distance from 138 Central Ave"], column, [("138 Central Avenue", "LOC_HOME_ADDR", 3)])[0]


def test_fuzzy(spark):
    values = [("severe peanut allergy", "HEALTH_CONDITION", 3), ("Marta Rossi", "ID_FULL_NAME", 2), ("gold-plan membership 7", "FIN_X", 3)]
    texts = ["A peanut and severe thing.", "peanut only", "Marta Rossi", "severe, PEANUT-allergy!", "peanutty severely", "the membershipping gold-plan x", "", None, "membership of the gold plan"]
    out = changed(spark, texts, redaction.redact_fuzzy(F.col("text"), F.col("held")), values)
    assert out[0] == f"A {TOKEN} and {TOKEN} thing." and out[1:3] == ["peanut only", "Marta Rossi"]
    assert out[3] == f"{TOKEN}, {TOKEN}-{TOKEN}!" and out[4] == TOKEN  # the stems still tell it, so the whole text goes
    assert out[5] == f"the membershipping {TOKEN}-{TOKEN} x" and out[6] == "" and out[8] == f"{TOKEN} of the {TOKEN} {TOKEN}"
    near = changed(spark, ["a severe alergyx case", "metopralol twice", "short allergi"], redaction.redact_fuzzy(F.col("text"), F.col("held"), typos=1), [("metoprolol 25mg twice", "HEALTH_MEDICATION", 3)])
    assert near == ["a severe alergyx case", f"{TOKEN} {TOKEN}", "short allergi"]


def plain_fuzzy(text, values):
    """The second pass as a loop, after the first."""
    for value in values:
        words = [w for w in re.split(r"\W+", value.lower()) if len(w) > 3]
        tells = lambda t: value.lower() in t.lower() or len(words) >= 2 and sum(w in t.lower() for w in words) >= 2  # noqa: B023, E731
        if tells(text):
            for w in words:
                if w not in T.GATE_STOPWORDS:
                    text = re.sub(rf"(?<!\w){re.escape(w)}(?!\w)", TOKEN, text, flags=re.I)
            text = TOKEN if tells(text) else text
    return text


def test_fuzzy_query(spark, sf):
    shown = {}
    first = redaction.redact(F.col("shown"), F.col("held"))
    for r in plans.fuzzy_redactions(spark, sf).collect():
        shown[r["event_id"]] = r["text"]
    extra = F.concat_ws(" ", "text", F.when(F.col("event_id") % 3 == 0, F.lit("it was a PEANUT thing, and the allergy is severe")), F.when(F.col("event_id") % 5 == 0, F.lit("Metoprolol, then twice")))
    base = detection.rows(spark, sf).withColumn("shown", extra).select("event_id", first.alias("text"), redaction.sensitive(F.col("held")).alias("values")).collect()
    assert {r["event_id"]: plain_fuzzy(r["text"], [v["text"] for v in r["values"]]) for r in base} == shown
    assert any(t == TOKEN for t in shown.values()) and sum(r["text"] != shown[r["event_id"]] for r in base) > 20


@pytest.mark.parametrize("label, word", [("ID_FULL_NAME", "the user"), ("HEALTH_X", "[health info]"), ("EMP_TEAM", "[work info]"), ("ID_SSN", "[REDACTED]"), ("OTHER", "Ann Lee-Cox")])
def test_placeholders(spark, label, word):
    texts = ["Ask Ann Lee-Cox today", "Ann said so", "a@b.co and +1 415-555 0100", None]
    out = changed(spark, texts, redaction.fill_placeholders(F.col("text"), F.col("held")), [("Ann Lee-Cox", label, 3)])
    assert out == [f"Ask {word} today", "the user said so" if label == "ID_FULL_NAME" else "Ann said so", "[email] and [phone]", ""]
