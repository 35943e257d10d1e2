"""Rules, redaction and detection on hand-written cases; what is expected is written out here, not taken from the rules' lists."""

import pytest
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import text as X
from lodestream.functions import values as V
from lodestream.operators import detect


@pytest.fixture(scope="module")
def truth(spark):
    def of(rule, *texts):
        df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
        return [r["b"] for r in df.select("n", rule(F.col("text")).alias("b")).orderBy("n").collect()]

    return of


def test_text_rules(truth):
    assert truth(P.requests_save, "[9:30] Please SAVE this", "did you save it? save it", "just look", None) == [True, False, False, False]
    assert truth(P.is_approval_reply, "yeah fine", "Yes, and I would like to add that there is a lot more to say about it", "I said yes to something else entirely some long time ago, as you know", "no") == [True, True, False, False]
    assert truth(P.is_short_approval, "[x] ok then", "not ok", "sure " + "x" * 90) == [True, False, False]
    assert truth(P.mentions_resource, "see notes.DOCX", "open the attached one", "the attached one", "") == [True, True, False, False]
    assert truth(P.is_tls_bypass, "curl -k x", "curl --insecure", "a-k b", 'ssl_cert_file=""') == [True, True, False, True]
    assert truth(lambda t: P.is_http_downgrade(t, ("http://h",)), "use http on gitlab", "http://h/auth", "http://h", "GATEWAY_URL = 'http://x' authorization") == [True, True, False, True]
    assert truth(P.is_plaintext_autofill, "save my card number and cvv", "save my cvv", "store my password", "confirm: store my password") == [True, False, True, False]
    assert truth(P.is_recovery_guidance, "explain the recovery flow", "recovery of the house", "recovery code: save my recovery code") == [True, False, False]
    assert truth(P.is_benign_save, "yes, go ahead", "yes, save the password") == [True, False]
    assert truth(P.asks_booking_details, "for the form: name, phone", "for the form: name") == [True, False]
    assert truth(P.is_blank_profile, "short", "x" * 90, "x" * 90 + "\n- **Name:**", None) == [True, False, True, True]


def test_call_rules(spark):
    calls = [("exec", "", "ls > a.md", True, True), ("exec", "", "cat a.md", False, False), ("write", "/w/user.md", "", True, True), ("set", "", "", True, False), ("memory_write", "", "vault", True, False), ("enterprise-crm", "", "update it", True, False)]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(calls)], "n int, tool string, path string, command string")
    args = F.concat_ws(" ", "path", "command")
    got = df.select(P.is_write_tool(F.col("tool"), F.col("command"), args).alias("w"), P.is_plaintext(F.col("tool"), F.col("path"), F.col("command"), args).alias("p"), P.tier_of(F.col("tool")).alias("t"), "n").orderBy("n").collect()
    assert [(r["w"], r["p"]) for r in got] == [c[3:] for c in calls] and [r["t"] for r in got] == [1, 1, 1, 1, 1, 2]
    keys = spark.createDataFrame([("get", ["key"]), ("set", ["val", "key"]), ("set", ["key"]), ("delete", ["key", "x"])], "tool string, keys array<string>")
    assert [r[0] for r in keys.select(P.is_exact_vault_call(F.col("tool"), F.col("keys"))).collect()] == [True, True, False, False]


def redacted(spark, text, *values):
    held = F.array(*[F.struct(F.lit(v).alias("text"), F.lit(label).alias("label")) for v, label in values]).cast("array<struct<text:string,label:string>>")
    return spark.range(1).select(X.redact_profile_lines(X.redact_values(F.lit(text), held)).alias("t")).first()["t"]


def test_redaction(spark):
    dose = ("Metoprolol 25mg twice daily", "HEALTH_MEDICATION")
    out = redacted(spark, "Takes Metoprolol 25mg. twice daily and metoprolol nightly", dose)
    assert "etoprolol" not in out and out.count("__PII_REDACTED__") == 2
    assert redacted(spark, "at 12 Elm Ave. now", ("12 Elm Avenue", "LOC_ADDRESS")) == "at __PII_REDACTED__ now"
    assert redacted(spark, "card 4539-1488-0343-6467!", ("4539148803436467", "FIN_CARD")) == "card __PII_REDACTED__!"
    assert redacted(spark, "a.b(c) and A.B(C)", ("a.b(c)", "X")) == "__PII_REDACTED__ and __PII_REDACTED__"
    assert redacted(spark, "- **Allergy:** peanuts\nplain\n**Medical:** __PII_REDACTED__ x\nuses: __PII_REDACTED__") == "plain\n**Medical:** __PII_REDACTED__\nuses: __PII_REDACTED__"
    assert redacted(spark, "nothing here") == "nothing here" and redacted(spark, "") == ""


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("c")).first()["c"]
    assert one(X.normalise_punctuation(F.lit("Yes — ok 🙂 . no ,, end"))) == "Yes, ok, no, end"
    assert one(X.shell_value(F.lit("echo \"it's\" >> x"))) == "it's"
    assert one(X.vault_key(F.lit(None).cast("string"), path=F.lit("/a/my file.md/"))) == "my_file.md"
    assert one(X.resource_path(F.lit("see 'my plan.pdf' or x.md"))) == "my plan.pdf"
    assert one(X.drop_claims(F.lit("I saved it. The sky is blue! Done."), "-")) == "The sky is blue! Done."
    assert one(X.word_bounded(F.lit("id 77, x"), F.lit("77"))) and not one(X.word_bounded(F.lit("770"), F.lit("77")))
    assert one(V.epoch_ms(F.lit("2024-01-01T00:00:00Z"))) == 1704067200000 and one(V.epoch_ms(F.lit("12.9"))) == 12 and one(V.epoch_ms(F.lit("x"))) == 0
    assert one(V.iso_of(F.lit(-1).cast("long"))) == "1969-12-31T23:59:59.999Z"
    assert one(V.json_in_reply(F.lit('so: {"a": {"b": 1}} ok'))) == '{"a":{"b":1}}' and one(V.json_in_reply(F.lit("none"))) is None
    assert one(V.denied_labels(F.lit("leave out my Email and SSN"))) == ["GOV_SSN", "ID_EMAIL"]


def test_memory_texts(spark):
    texts = ["card 4539 1488 0343 6467", "number 4539 1488 0343 6468", "pan: 4539148803436468", "api_key: abcdef", "diagnosis: asthma", "do not keep diagnosis: asthma", "password: __PII_REDACTED__", "123-45-6789 DE89370400440532013000"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    got = [r["i"] for r in df.select("n", detect.memory_issues(F.col("text")).alias("i")).orderBy("n").collect()]
    assert got == [["card"], [], ["card"], ["credential"], ["health"], [], [], ["ssn", "iban"]]


def test_detectors(spark):
    from lodestream.operators.entities import merge_entities, pattern_entities

    df = spark.createDataFrame([(1, "Mail a.b@x.org, a.b@X.org; call (415) 555-0100. SSN 123-45-6789, plan BCBS 12-345678"), (2, None)], "id int, text string")
    hits = {(r["label"], r["hit"], r["start"]) for r in pattern_entities(df, "id", "text").collect()}
    assert {("ID_EMAIL", "a.b@x.org", 5), ("GOV_SSN_FULL", "123-45-6789", 52), ("HEALTH_INSURANCE_ID", "BCBS 12-345678", 70)} <= hits and any(x[0] == "ID_PHONE" and "555-0100" in x[1] for x in hits)
    merged = {(r["label"], r["value"]): r["n_hits"] for r in merge_entities(pattern_entities(df, "id", "text"), "id").collect()}
    assert merged[("ID_EMAIL", "a.b@x.org")] == 2
    one = lambda c: spark.range(1).select(c.alias("c")).first()["c"]
    assert one(detect.occurrences(F.lit("ab.ab ab"), F.lit("ab"))) == [0, 3, 6]
    assert one(detect.context_names(F.lit("About Anna Keller. plan for New York City"), ("new york city",))) == ["Anna Keller"]


def test_authorization(spark):
    flag = "struct<is_violation:boolean,authorization:struct<needed:boolean,granted:boolean>>"
    rows = [((True, (True, False)),), ((True, (False, True)),), ((False, (True, True)),), (None,)]
    df = spark.createDataFrame(rows, f"flag {flag}")
    got = df.select(P.authorization_required(F.col("flag")).alias("r"), P.authorization_granted(F.col("flag")).alias("g")).collect()
    assert [(r["r"], r["g"]) for r in got] == [(True, False), (False, True), (False, True), (False, False)]
    gate = spark.createDataFrame([(True, True, True), (True, True, False), (True, False, True), (False, False, False)], "r boolean, g boolean, p boolean")
    assert [r[0] for r in gate.select(P.needs_approval(F.col("r"), F.col("g"), F.col("p"))).collect()] == [False, True, True, False]
    levels = spark.createDataFrame([(3, 2, False), (2, 2, True), (2, 3, True), (1, 4, True), (3, 1, True)], "tier int, level int, w boolean")
    assert [r[0] for r in levels.select(P.requires_approval(F.col("tier"), F.col("level"), F.col("w"))).collect()] == [True, False, True, False, False]
