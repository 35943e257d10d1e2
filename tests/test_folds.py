"""Folds, the decision cascade, edits and repairs against plain loops over the same rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lodestream.functions import terms as T
from lodestream.operators import cascade, policy, preferences, substitution
from lodestream.plans import detection, event_streams, quality_gates, training_pairs
from lodestream.plans.stream import stream


def by_stream(rows, order="pos"):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["submission"], r[order])):
        out[r["submission"]].append(r)
    return out


def covers(held, key):
    kin = set()
    if key in ("browser", "agent-browser", "web_fetch"):
        kin = {"browser", "agent-browser", "web_fetch"}
    elif key == "web_search":
        kin = {"web_search", "browser", "agent-browser", "web_fetch"}
    return any(g in kin or g in key or key in g or g.split("/")[-1] == key.split("/")[-1] for g in held)


def test_consents(spark, sf):
    got = event_streams.consent_cover(spark, sf).collect()
    for rows in by_stream(got).values():
        held = []
        for r in rows:
            key = (r["key"] or "").lower()
            assert r["covered"] == covers(held, key)
            if not r["covered"]:
                held.append(key)
    assert {r["covered"] for r in got} == {True, False}


def test_recent_copies(spark, sf):
    want = []
    for sub, rows in by_stream(stream(spark, sf).select("submission", "pos", "role", "text", "has_call").collect()).items():
        recent = []
        for r in rows:
            free = r["role"] in ("user", "assistant") and r["text"] and not r["has_call"] and len(r["text"]) < 240
            if free and (r["role"], r["text"]) in recent[-8:]:
                continue
            want.append((sub, r["pos"]))
            if free:
                recent.append((r["role"], r["text"]))
    assert sorted(map(tuple, event_streams.recent_copies(spark, sf).collect())) == sorted(want)


def test_cascade(spark, sf):
    """Decisions over facts, again as a plain loop: each rule in turn, with the source of values first."""
    facts = detection.cascade_calls(spark, sf).collect()
    got = {(r["submission"], r["turn"]): r["action"] for r in detection.cascade_decisions(spark, sf).collect()}
    seen = Counter()
    for sub, rows in by_stream(facts, "turn").items():
        consents, asked = [], None
        for r in rows:
            gate = False
            kept_place = r["is_mem"] or r["is_profile"]
            sourced = r["is_mem"] or r["given_now"] or r["given_before"] and (r["approved"] or asked == r["turn"] - 1)
            if r["is_read"]:
                action = "allow"
            elif r["level"] >= 3 and not sourced:
                action = "elicit"
            elif r["reason"] == "":
                if r["level"] < 2 or not r["found"]:
                    action = "allow"
                elif r["writes_l3"] and kept_place and not r["encrypted"]:
                    action = "hard_deny"
                else:
                    action = "suppress" if kept_place and not r["save_asked"] else "minimize"
            elif r["reason"] == "local_write_above_band":
                action = "vault_redirect" if r["later_reads"] in (3, 4) else "hard_deny"
            elif r["approved"] or covers(consents, r["consent_key"]):
                action = "allow" if r["tier"] == 3 and r["tool"] in ("browser", "agent-browser", "web_fetch") else "minimize"
            else:
                action, gate = "consent_gate", True
            seen[action] += 1
            assert got[sub, r["turn"]] == action, r
            if gate:
                consents.append(r["target"])
                asked = r["turn"]
    assert {"allow", "consent_gate", "hard_deny", "minimize"} <= set(seen)


SCHEMA = "submission long, turn long, slot int, tool string, tier int, level int, own string, reason string, approved boolean, consent_key string, target string, is_read boolean, expected string, later_reads long"


@pytest.mark.parametrize(
    "calls, want",
    [
        # The strongest of a turn's calls wins, the first of equal ones.
        ([(0, 0, "write", 1, 2, "minimize", ""), (0, 1, "browser", 3, 2, "ask", "missing_authorization")], ["consent_gate:1"]),
        ([(0, 0, "write", 1, 2, "minimize", ""), (0, 1, "edit", 1, 2, "minimize", "")], ["minimize:0"]),
        # A denied local write ends the turn, whatever follows.
        ([(0, 0, "write", 1, 3, "vault_redirect", "local_write_above_band"), (0, 1, "write", 1, 3, "hard_deny", "local_write_above_band")], ["vault_redirect:0"]),
        # A consent covers the next call of its kind; a search is covered by a submission, not the other way round.
        ([(0, 0, "browser", 3, 2, "ask", "missing_authorization"), (1, 0, "web_fetch", 3, 2, "ask", "missing_authorization"), (2, 0, "web_search", 3, 2, "ask", "missing_authorization")], ["consent_gate:0", "allow:-1", "minimize:0"]),
        ([(0, 0, "web_search", 3, 2, "ask", "missing_authorization"), (1, 0, "browser", 3, 2, "ask", "missing_authorization")], ["consent_gate:0", "consent_gate:0"]),
        # A value given before is bridged only by a consent asked for in the turn before.
        ([(0, 0, "browser", 3, 3, "ask", "missing_authorization"), (1, 0, "web_fetch", 3, 3, "gate?", "missing_authorization"), (3, 0, "web_fetch", 3, 3, "gate?", "missing_authorization")], ["consent_gate:0", "allow:-1", "elicit:0"]),
        # A bridged value goes through the rest of the rules: in a plaintext local write it is denied all the same, or goes to the vault.
        ([(0, 0, "browser", 3, 3, "ask", "missing_authorization"), (1, 0, "write", 1, 3, "gate?", "local_write_above_band")], ["consent_gate:0", "hard_deny:0"]),
        ([(0, 0, "browser", 3, 3, "ask", "missing_authorization"), (1, 0, "write", 1, 3, "gate?", "local_write_above_band", 3)], ["consent_gate:0", "vault_redirect:0"]),
        ([(0, 0, "write", 1, 3, "gate?", "local_write_above_band")], ["elicit:0"]),
        # Reads decide nothing.
        ([(0, 0, "read", 1, 3, "skip", "")], ["allow:-1"]),
    ],
)
def test_turns(spark, calls, want):
    rows = [(1, t, s, tool, tier, level, own, reason, False, tool, tool, own == "skip", "", reads[0] if reads else 0) for t, s, tool, tier, level, own, reason, *reads in calls]
    facts = spark.createDataFrame(rows, SCHEMA)
    facts = facts.withColumns({x: F.lit(False) for x in ("is_mem", "is_profile", "writes_l3", "encrypted", "save_asked")}).withColumn("found", F.array(F.lit(1)))
    from unittest import mock

    with mock.patch.object(cascade, "own_action", lambda _=None: F.col("own")):
        got = cascade.decide(facts, ["submission"]).orderBy("turn").collect()
    assert [f"{r['action']}:{r['slot']}" for r in got] == want


@pytest.mark.parametrize(
    "expected, tool, tier, level, target, want",
    [
        ("hard_deny", "browser", 3, 3, "/w/memory/today.md", "hard_deny"),
        ("hard_deny", "browser", 3, 3, "/w/notes.txt", "allow"),
        ("hard_deny", "browser", 3, 2, "/w/memory/today.md", "allow"),
        ("consent_gate", "browser", 3, 2, "other", "consent_gate"),
        ("consent_gate", "browser", 3, 1, "other", "allow"),
        ("consent_gate", "browser", 2, 2, "other", "allow"),
        ("", "browser", 3, 3, "/w/memory/today.md", "allow"),
    ],
)
def test_expected_actions(spark, expected, tool, tier, level, target, want):
    """What a task expects lifts a turn that would be allowed: a consent given lets the call pass, the task says otherwise."""
    rows = [(1, 0, 0, tool, tier, level, "downgrade", "", False, tool, target, False, expected, 0)]
    from unittest import mock

    with mock.patch.object(cascade, "own_action", lambda _=None: F.col("own")), mock.patch.object(cascade, "sourced_action", lambda _=None: F.col("own")):
        assert [r["action"] for r in cascade.decide(spark.createDataFrame(rows, SCHEMA), ["submission"]).collect()] == [want]


def test_recent_messages(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", None if i == 7 else f"t{i}" * 200) for i in range(1, 12)] + [(2, 1, "assistant", "x"), (None, 1, "user", "y")]
    df = spark.createDataFrame(rows, "submission long, pos long, role string, text string")
    for n in (1, 2, 4):
        got = {(r["submission"], r["pos"]): list(r["said"]) for r in preferences.recent_messages(df, ["submission"], "pos", "said", n, 9).collect()}
        want = {(s, p): [t[:9] for s2, p2, r, t in rows if s2 == s and p2 <= p and r == "user" and t is not None][-n:] for s, p, _, _ in rows}
        assert got == want


def test_values_recur_far_behind(spark):
    """A value 10 000 rows later is found; booleans, 0, 1, objects and common words are no values."""
    result = '{"code": "AB-77", "n": 42, "half": 2.5, "list": ["zz", "ref 9"], "flag": true, "one": 1, "inner": {"v": "AB-77"}, "state": "open", "dots": "...", "none": null}'
    rows = [(1, 0, result), (1, 1, "not json"), (1, 2, "[1]"), (1, 3, '{"x": "AB-77"}'), (2, 0, result), (2, 1, "xAB-77 AB-770 142 12.5 ref 9a"), (3, 5, None), (3, 6, "{}")]
    rows += [(1, i, "word " * 3) for i in range(4, 10_000)] + [(1, 10_000, "so (AB-77), 42. 2.5 and ref 9 true 1 open ...")]
    df = spark.createDataFrame(rows, "submission long, pos long, text string")
    got = {(r["submission"], r["pos"]): list(r["consumed"]) for r in substitution.consumed_fields(df, df, ["submission"], "pos").collect()}
    assert got == {(1, 0): ["code", "dots", "half", "list", "n"], (1, 3): ["x"], (2, 0): [], (3, 6): []}


def test_bands():
    assert policy.FREE_BAND == {(1, False): 4, (1, True): 2, (2, False): 2, (2, True): 2, (3, False): 1, (3, True): 1}


def test_shifted_edits(spark, sf):
    """Operations one after another on lists, each on the stream as it then stands; rows once inserted are changed no more."""
    got = by_stream(training_pairs.shifted_edits(spark, sf).collect(), "line")
    shifted = 0
    for sub, rows in by_stream(training_pairs._events(spark, sf).collect()).items():
        now = [{**r.asDict(), "new": False} for r in rows]
        for r in rows:
            kind, line = r["event_id"] % 4, r["pos"]
            at = now[line - 1] if line <= len(now) else None
            shifted += bool(at) and not at["new"] and at["pos"] != line
            if kind == 0 and at and not at["new"]:
                del now[line - 1]
            elif kind == 1 and line <= len(now) + 1:
                while line <= len(now) and now[line - 1]["new"]:
                    line += 1
                now[line - 1 : line - 1] = [{"role": "assistant", "text": "May I?", "new": True}, {"role": "user", "text": "Yes.", "new": True}]
            elif kind == 2 and at and not at["new"] and at["role"] == "assistant":
                at["text"] = f"seq {r['pos']}"
        assert [(r["role"], r["text"]) for r in got[sub]] == [(x["role"], x["text"]) for x in now]
    assert shifted > 100


def test_lines():
    import random

    from lodestream.operators.edits import Lines

    r = random.Random(3)
    for _ in range(500):
        n = r.randrange(1, 9)
        now, lines = list(range(1, n + 1)), Lines(n)
        for _ in range(r.randrange(1, 8)):
            if r.random() < 0.5:
                at = r.randrange(1, len(now) + 2)
                now[at - 1 : at - 1] = [None, None]
                lines.insert(at, 2)
            elif now:
                at = r.randrange(1, len(now) + 1)
                del now[at - 1]
                lines.remove(at)
            assert [lines.place(i) for i in range(1, len(now) + 2)] == [*now, n + 1]


def test_repairs_find_less_each_pass(spark, sf):
    found = [r["n_hits"] for r in quality_gates.repair_passes(spark, sf).orderBy("pass").collect()]
    assert found[1] < found[0] / 3 and found == sorted(found, reverse=True)


def test_repairs(spark, sf):
    rows = quality_gates.repaired_streams(spark, sf).collect()
    kinds = Counter(k for r in rows for k in r["repairs"].split(",") if k)
    assert len(kinds) >= 18
    for r in rows:
        if "blocked_insecure_gateway_tool_call" in r["repairs"]:
            assert not r["has_call"] and r["text"] == "I can't run this."
        if "converted_sensitive_persistence_to_vault_set" in r["repairs"]:
            assert r["tool"] == "set" and r["exact"] and not r["path"]
        if "redacted_sensitive_tool_result" in r["repairs"]:
            assert r["text"] == T.REDACTION_TOKEN
    asked = Counter(r["kind"] for r in rows if r["role"] == "custom" and r["pos"] % 1)
    assert asked["exec.approval.requested"] == asked["exec.approval.resolved"] == kinds["inserted_exec_approval"] > 0
