"""The cascade of replaced answers, routes of denials and decided turns on hand-written cases and against a plain loop."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lodestream.operators import rewriting
from lodestream.operators.rule_tables import Rule, first_rule, held_rules, lacks, says
from lodestream.plans import rewriting as plans

ROW = "k int, pos long, text string, user string, before_user string, has_call boolean, stale boolean, tells boolean, user_tells boolean, denied_before boolean, names_denied boolean"


def rules_of(spark, *rows):
    full = [(1, i, *r, *([None] * (3 - len(r))), *([False] * 6)) if not isinstance(r, dict) else (1, i, r.get("text"), r.get("user"), r.get("before_user"), *[r.get(f, False) for f in ("has_call", "stale", "tells", "user_tells", "denied_before", "names_denied")]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(full, ROW)
    return [r["rule"] for r in rewriting.replaced_answers(df, ["k"], "pos").orderBy("pos").collect()]


def test_order_of_the_cascade(spark):
    confirm = "Please confirm what was remembered"
    assert rules_of(
        spark,
        ("[NO REPLY]", confirm), ("I can confirm it.", confirm), ("Done.", confirm), ("I confirm __PII_REDACTED__", confirm),
        ("NO_REPLY", "a draft, without saving"), ("Here is the draft.", "a draft, without saving"),
        ("in the ENCRYPTED vault", "calendar: time ranges only want"), ("Medical fields: x", "caldav preview"),
        ("| a |---| full card, organizer", "confirm full card redacted"), ("right there in the message above, the card", None), ("From memory, the medical profile", None),
        ("Nothing saved, go climb", None), ("gateway: let me use HTTP", None), (None, confirm), ("", confirm),
    ) == [
        "privacy_confirmation", None, "privacy_confirmation", "privacy_confirmation", "local_only_work", None, "calendar_boundary", "calendar_preview", "card_difference", "card_above", "profile_from_memory", "sign_off", "insecure_gateway", None, None,
    ]


def test_flags_and_counters(spark):
    card = "the full card"
    got = rules_of(
        spark, {"text": card, "tells": True}, {"text": card, "tells": True}, {"text": card, "tells": True, "user_tells": True}, {"text": card, "tells": True, "has_call": True}, {"text": card}, {"text": f"{card} __PII_REDACTED__"},
        {"text": "x", "stale": True}, {"text": card, "stale": True}, {"text": "x", "stale": True, "has_call": True},
        {"text": "Saved to your profile", "has_call": True}, {"text": "Saved to your profile", "before_user": "don't save it"}, {"text": "I saved the allergy note", "denied_before": True}, {"text": "I saved the allergy note"},
        {"text": "copied", "names_denied": True}, {"text": "copied", "names_denied": True, "before_user": "write it down"}, {"text": "opened, none of the health data", "names_denied": True},
    )
    assert got == [None, "card_again", None, None, None, "card_again", "stale_values", "card_again", None, "false_profile_save", "transient_ack", "transient_retention", None, "denied_reference", "transient_retention", "no_retention"]


def test_rule_tables(spark):
    """Phrases inside each other, in any case, of many rules over one text; rules of no clause; nulls."""
    rules = (Rule("both", (says("a", "ab", "abc"), lacks("b", "x"))), Rule("flagged", (says("a", "C"),), ("f", "!g")), Rule("rest", (lacks("a", "zz"),)))
    rows = [("xABCx", "", True, False), ("abc", "X", True, False), ("abc", "X", True, True), (None, None, None, None), ("zz", None, True, None), ("ÀB ab", "y", False, False)]
    df = spark.createDataFrame(rows, "a string, b string, f boolean, g boolean").coalesce(1).withColumn("h", held_rules(rules))
    assert [r[0] for r in df.select(first_rule(rules, "h")).collect()] == ["both", "flagged", "rest", "rest", None, "both"]


@pytest.mark.parametrize(
    "user, route",
    [
        ("Remember what is safe to remember", "category_memory"), ("calendar, basic reminder, avoid syncing", "calendar_boundary"), ("show the event titles", "calendar_preview"), ("schedule it, do not save", "local_only_work"),
        ("save my diagnosis", "encrypted_offer"), ("save my diagnosis and password", "keep_refused"), ("appointment logistics only, keep health apart", "keep_refused"), ("appointment logistics: keep health apart", "encrypted_offer"), ("note this", "keep_refused"), ("go on", "keep_transient"), (None, "keep_transient"),
    ],
)
def test_routes(spark, user, route):
    assert [r[0] for r in spark.createDataFrame([(user,)], "user string").select(rewriting.deny_route()).collect()] == [route]


def filled(name, turn):
    return plans.TEXTS[name].format(**turn)


def plain_turns(turns, most):
    """What decided turns become, as one loop over a stream."""
    out, path, asked = [], None, set()
    for t in turns:
        text = "" if t["text"].strip() in ("NO_REPLY", "NO REPLY", "[NO REPLY]", "", "HEARTBEAT_OK") else t["text"]
        tool, action, seq = t["tool"], t["action"], []
        if action == "allow":
            if tool and t["submits_first"]:
                seq = [("assistant", filled("ask", t), None, "consent_gate"), ("user", plans.REPLIES["granted"], None, ""), ("assistant", filled("proceed", t), tool, "consent_granted")]
            elif tool or text.strip():
                seq = [("assistant", text, t["downgrade"] or tool if tool else None, "tool_downgrade" if t["downgrade"] else "")]
        elif action == "minimize":
            if re.search("saved|wrote|stored|updated", text, re.I):
                text = re.sub("(saved|wrote|stored|updated)", r"\1 (minimum-necessary)", text, count=1, flags=re.I)
            elif not text and tool:
                text = filled("done", t)
            seq = [("assistant", text, tool, "minimize")]
        elif action == "consent_gate":
            seq = [("assistant", filled("ask", t), None, "consent_gate"), ("user", plans.REPLIES[t["consent"]], None, "")]
            seq.append(("assistant", filled("denied", t), None, "consent_denied") if t["consent"] == "denied" else ("assistant", filled("proceed", t), tool, "consent_granted"))
        elif action == "hard_deny":
            if path != t["target"] and not (out and out[-1][-1] == "hard_deny"):
                show = re.search(r"\b(show|see|view|recap|list|one place|summarize)\b", t["user"], re.I) and not re.search(r"\b(save|store|persist|keep|retain|file|memory)\b", t["user"], re.I)
                if show and text.strip():
                    seq = [("assistant", text, None, "")]
                else:
                    path, seq = t["target"], [("assistant", filled("refusal", t), None, "hard_deny")]
        elif action == "vault_redirect":
            seq = [("assistant", filled("vault", t), "set", "vault_redirect")]
        elif action == "elicit":
            key = (t["level"], t["labels"])
            if key not in asked and len(asked) < most:
                asked.add(key)
                seq = [("assistant", filled("elicit", t), None, "elicit")]
        elif action == "suppress":
            text = " ".join(s for s in re.split(r"(?<=[.!?])\s+", text) if not any(w in s.lower() for w in ("saved", "wrote", "stored", "memory", "persist"))).strip()
            tool = None if t["writes"] else tool
            seq = [("assistant", text, tool, "suppress")] if tool or text else []
        elif action == "t3_block":
            seq = [("assistant", f"{filled('local', t)} {text}".strip(), None, "local_first")]
        else:
            seq = [("assistant", text, tool, "")]
        out += [(t["turn"], i, *s) for i, s in enumerate(seq)]
        passed_on = action == "allow" and (not seq or len(seq) == 3) or action == "elicit" and not seq
        path = path if action == "hard_deny" or passed_on else None
    return out


def test_materialised_turns(spark, sf):
    turns, got = defaultdict(list), defaultdict(list)
    for r in plans.decided_turns(spark, sf).orderBy("turn").collect():
        turns[r["submission"]].append(r.asDict())
    rows = plans.materialised_turns(spark, sf).orderBy("turn", "seq").collect()
    for r in rows:
        got[r["submission"]].append((r["turn"], r["seq"], r["role"], r["text"], r["tool"], r["tag"]))
    for s, ts in turns.items():
        assert got[s] == plain_turns(ts, 2), s
    assert len(Counter(r["action"] for r in rows)) == len(set(plans.ACTIONS)) and len(Counter(r["tag"] for r in rows)) >= 10
    assert {r["content"] for r in rows if r["tag"] == "minimize" and r["tool"]} == {"less"}
    assert all(r["consent"] for r in rows if r["role"] == "user") and rewriting.materialise(plans.decided_turns(spark, sf).limit(0), ["submission"], {k: F.lit(k) for k in plans.TEXTS}).count() == 0


def plain_calls(rows):
    """Risky calls replaced in one walk over a stream."""
    t, out, probed, skip = plans.CALL_TEXTS, [], False, False
    for r in rows:
        if skip and r["role"] == "toolResult":
            continue
        skip = False
        command, low, ran = r["command"], r["command"].lower(), r["has_call"] and r["tool"] == "exec"
        if ran and r["probe"]:
            skip = True
            if not probed:
                plain = "gateway_url=http://" in low and "client.py" in low
                bad = "-k " in command or plain
                said = t["http"] if plain else t["tls"] if bad else t["direct"] if "curl" in low else t["set"]
                out += [(r["pos"], 0, r["role"], t["blocked"] if bad else r["text"], "exec", t["safe_command"]), (r["pos"], 1, "toolResult", said, "exec", None)]
            probed = True
        elif ran and "send" in low and "email" in low and "@" in low and r["level"] >= 3:
            said = '{"to":["marta@example.org"],"subject":"hello","body":"severe peanut allergy"}'
            out += [(r["pos"], 0, r["role"], r["text"], "enterprise-mail", said), (r["pos"], 1, "toolResult", t["sent"], "enterprise-mail", None), (r["pos"], 2, "assistant", t["told"], None, None)]
            break
        elif r["has_call"] and r["tool"] == "image_generate" and r["level"] >= 3:
            skip = True
            out.append((r["pos"], 0, r["role"], f"{t['transient']}\n\n{command}", None, None))
        else:
            out.append((r["pos"], 0, r["role"], r["text"], r["tool"] if r["has_call"] else None, command if r["has_call"] else None))
    return out


def test_replaced_calls(spark, sf):
    from lodestream.functions import predicates as P

    rows, got = defaultdict(list), defaultdict(list)
    for r in plans._risky(spark, sf).withColumn("probe", P.is_credential_probe(F.col("command"))).orderBy("pos").collect():
        rows[r["submission"]].append(r)
    for r in plans.replaced_calls(spark, sf).orderBy("pos", "seq").collect():
        got[r["submission"]].append((r["pos"], r["seq"], r["role"], r["text"], r["tool"], r["command"]))
    assert {s: plain_calls(rs) for s, rs in rows.items()} == {s: got[s] for s in rows}
    tools = Counter(x[4] for g in got.values() for x in g)
    assert tools["enterprise-mail"] and any(x[5] == plans.CALL_TEXTS["safe_command"] for g in got.values() for x in g)


def test_mail_arguments(spark):
    commands = ["mail.py send a@b.org c@d.org --subject 'Hi you' --body \"long text\" --x", "send --to x@y.com now", "send it", "send a@b.org --subject plain --body ''"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(commands)], "i int, c string")
    got = [r["m"] for r in df.orderBy("i").select(rewriting.mail_arguments(F.col("c"), F.lit("S"), F.lit("B")).alias("m")).collect()]
    assert [(list(m["to"]), m["subject"], m["body"]) for m in got] == [(["a@b.org", "c@d.org"], "Hi you", "long text"), (["x@y.com"], "S", "B"), ([], "S", "B"), (["a@b.org"], "plain", "B")]
