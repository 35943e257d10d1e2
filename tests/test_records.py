"""Scenarios, facts on rows, opening rows, record heads, joined tasks and needless scrubs: hand-written cases and a plain loop."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestream.operators import records
from lodestream.plans import records as plans


@pytest.mark.parametrize(
    ("tools", "most", "l3", "l4", "given", "want"),
    [
        (["memory_write"], 3, True, False, "", "D"), (["set", "browser"], 4, False, True, "", "D"), (["web_search"], 3, True, False, "", "C"), (["slack"], 4, False, True, "", "C"),
        (["enterprise-mail", "read"], 3, True, False, "", "B"), (["web_fetch"], 2, False, False, "", "C"), (["read"], 3, True, True, "", "A"), (["image"], 4, False, True, "", "L"),
        (["image"], 4, True, True, "", "L"), (["image"], 3, True, False, "", "A"), ([], 2, False, False, "", "F"), (None, 1, False, False, "K", "K"), (None, 0, False, False, "KK", "A"),
        (["memory_write"], 2, False, False, "", "F"), (["web_search"], 1, False, False, None, "A"), ([None], 0, False, False, "M", "M"),
    ],
)
def test_scenarios_of_turns(spark, tools, most, l3, l4, given, want):
    row = spark.createDataFrame([(tools, most, l3, l4, given)], "tools array<string>, m int, l3 boolean, l4 boolean, given string")
    assert row.select(records.turn_scenario(F.col("tools"), F.col("m"), F.col("l3"), F.col("l4"), F.col("given")).alias("s")).first()["s"] == want


def test_markers(spark):
    rows = spark.createDataFrame(
        [(1, "Use the Clinic Site"), (1, "By OUR RULES no; don't save it"), (1, None), (2, "mednow"), (2, ""), (3, "MedNow may share"), (4, "our rules")], "k int, t string"
    )
    got = {r["k"]: (r["scenarios"], r["points"]) for r in records.marker_scenarios(rows, ["k"], "t", "our rules").collect()}
    assert got == {1: ("C,D", 3), 2: ("", 0), 3: ("C", 1), 4: ("D", 1)}


def test_facts_on_rows(spark):
    schema = "i int, role string, text string, ms long, has_call boolean, tool string, is_error boolean"
    ms = 1_775_496_540_000  # 2026-04-06 17:29
    rows = spark.createDataFrame(
        [
            (1, "user", "hello", ms, False, "", False), (2, "user", "[Sun 2020-01-05 10:00 UTC]  hello", ms, False, "", None), (3, "user", None, ms, False, "", False), (4, "user", "hi", None, False, "", False),
            (5, "assistant", "x", ms, True, "exec", False), (6, "assistant", "x", ms, False, "", False), (7, "toolResult", 'a"b' + "é" * 600, ms, False, "exec", True), (8, "toolResult", None, ms, False, "exec", None),
            (9, "toolResult", "t", ms, False, "read", False), (10, "user", "Sender: me\nhello", ms, False, "", False), (11, "user", "before", -1, False, "", False),
        ],
        schema,
    )
    got = {r["i"]: r for r in records.decorate(rows).collect()}
    stamp = "[Mon 2026-04-06 17:29 UTC] "
    assert [got[i]["text"] for i in (1, 2, 3, 4, 11)] == [stamp + "hello", stamp + "hello", None, "hi", "[Wed 1969-12-31 23:59 UTC] before"]
    assert [got[i]["stop_reason"] for i in (1, 5, 6, 7)] == [None, "toolUse", "stop", None]
    assert json.loads(got[7]["details"]) == {"status": "completed", "exitCode": 1, "aggregated": 'a"b' + "é" * 497}
    assert json.loads(got[8]["details"]) == {"status": "completed", "exitCode": 0, "aggregated": ""} and got[9]["details"] is None and got[5]["text"] == "x"
    sent = {r["i"]: r["text"] for r in records.decorate(rows, sender=F.lit("Sender: me\n")).collect()}
    assert sent[1] == "Sender: me\n" + stamp + "hello" and sent[10] == "Sender: me\nhello"


def test_opening_rows(spark):
    sessions = spark.createDataFrame([("a", 1000, None, "p"), ("b", 0, "/w", None)], "k string, ms long, cwd string, provider string")
    got = sorted(map(tuple, records.opening_rows(sessions, "k").select("k", "pos", "type", "id", "parent", "ms", "data").collect()))
    a = [r for r in got if r[0] == "a"]
    assert [r[2] for r in a] == ["session", "model_change", "thinking_level_change", "custom"] and [r[5] for r in a] == [1000, 1002, 1004, 1006]
    assert a[0][3] == "a" and a[1][4] is None and a[2][4] == a[1][3] and a[3][4] == a[2][3] and len({r[3] for r in got}) == 8
    assert [json.loads(r[6]) for r in got if r[1] != -2] == [{"version": 3}, {"provider": "p"}, {"provider": "p"}, {"version": 3, "cwd": "/w"}, {}, {}]
    assert records.opening_rows(sessions.limit(0), "k").count() == 0


def test_assembled(spark):
    parsed = spark.createDataFrame([(1, "P-7-a"), (2, "T-7-a"), (3, "T-8-a"), (4, None), (5, "odd"), (6, "T-9-z"), (2, "T-7-a")], "s int, task_id string")
    tasks = spark.createDataFrame([("T-7-a", "x"), ("T-8-a", "y")], "task_id string, what string")
    people = spark.createDataFrame([("P-7", "Ann"), ("P-9", "Bob")], "persona_id string, name string")
    got = sorted(map(tuple, records.assemble(parsed, tasks, people).select("s", "what", "name", "error").collect()))
    assert got == [
        (1, "x", "Ann", None), (2, "x", "Ann", None), (2, "x", "Ann", None), (3, "y", None, "no persona"), (4, None, None, "odd task id"), (5, None, None, "odd task id"), (6, None, "Bob", "no task"),
    ]
    assert Counter(r["error"] for r in records.assemble(parsed, tasks.limit(0), people.limit(0)).collect()) == {"no persona": 5, "odd task id": 2}


def _scrubbed(rows: list[tuple]) -> list[int]:
    """Positions that stay, walking the rows (pos, role, call, ref, scrub, dirty) of one stream with its state."""
    last_dirty, used, scrubs, gone, kept = False, False, set(), set(), []
    for pos, role, call, ref, scrub, dirty in rows:
        answer = role == "toolResult" and ref
        if answer and ref in gone:
            continue
        if scrub and call:
            if last_dirty and not used:
                used = True
                kept.append(pos)
            else:
                gone.add(call)
            scrubs.add(call)
            continue
        kept.append(pos)
        if not (answer and ref in scrubs):
            last_dirty, used = bool(dirty), False
    return kept


def test_scrubs_against_a_plain_loop(spark):
    rnd, rows = random.Random(5), []
    for stream in range(60):
        for pos in range(40):
            role = rnd.choice(["assistant", "toolResult", "toolResult", "user"])
            call = rnd.choice(["", None, "x", f"c{pos}", f"c{pos}"]) if role == "assistant" else None
            earlier = [r[3] for r in rows if r[0] == stream and r[3]]
            ref = rnd.choice(["", None, "y", *earlier[-2:]]) if role == "toolResult" else None
            rows.append((stream, pos, role, call, ref, role == "assistant" and rnd.random() < 0.7, rnd.choice([True, True, False, None]) if role == "toolResult" else None, 1))
    df = spark.createDataFrame(rows, "k int, pos int, role string, call_id string, ref string, scrub boolean, dirty boolean, `a.b` int")
    got = records.drop_needless_scrubs(df, ["k"], "pos", F.col("scrub"), F.col("dirty"))
    assert got.columns == df.columns
    want = {(k, p) for k in range(60) for p in _scrubbed([r[1:7] for r in rows if r[0] == k])}
    assert {(r["k"], r["pos"]) for r in got.collect()} == want
    assert 0.3 < len(want) / len(rows) < 0.95 and {r[:2] for r in rows if r[5] and r[3]} & want
    assert records.drop_needless_scrubs(df.limit(0), ["k"], "pos", F.col("scrub"), F.col("dirty")).count() == 0


def test_queries_find_all_kinds(spark, sf):
    kinds = lambda name, column: {r[0] for r in getattr(plans, name)(spark, sf).select(column).distinct().collect()}
    assert kinds("turn_scenarios", "scenario") >= {"A", "B", "C", "D", "F", "G", "L"}
    assert kinds("assembled_streams", "error") >= {None, "odd task id", "no persona"} and kinds("record_heads", "completion") == {"success", "failed"}
    assert len(kinds("marker_scenarios", "scenarios")) >= 2 and 0 < plans.kept_scrubs(spark, sf).filter(F.col("text") == plans.SCRUB).count()
