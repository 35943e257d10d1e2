"""Turns, splices, the composed normaliser and checks of raw lines against plain loops and hand-written cases."""

import json
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lodestream.operators import event_streams as E
from lodestream.operators import log_checks, splices, turns
from lodestream.plans import turns as plans
from lodestream.plans.event_streams import checkpoint

ROWS = "k string, pos long, role string, text string, calls array<string>, ref string"


def test_turns_and_back(spark):
    rows = [
        ("a", 1, "user", "u", [], None), ("a", 2, "assistant", "x", ["c1", "c2"], None), ("a", 3, "toolResult", "r2", [], "c2"), ("a", 4, "custom", None, [], None), ("a", 5, "toolResult", "r1", [], "c1"),
        ("a", 6, "assistant", "y", ["c1", ""], None), ("a", 7, "toolResult", "again", [], "c1"), ("a", 8, "toolResult", "lost", [], "zz"), ("a", 9, "toolResult", "no ref", [], ""), ("b", 1, "toolResult", "early", [], "c1"),
        ("b", 2, "assistant", "x", ["c1"], None), ("b", 3, "toolResult", "twice", [], "c1"), ("b", 4, "toolResult", "twice", [], "c1"),
    ]
    df = spark.createDataFrame(rows, ROWS)
    made = turns.to_turns(df, ["k"], "pos")
    got = {(r["k"], r["pos"]): (r["turn"], [x["pos"] for x in r["results"]]) for r in made.collect()}
    assert got == {("a", 1): (None, []), ("a", 2): (0, [3, 5]), ("a", 4): (None, []), ("a", 6): (1, [7]), ("a", 8): (None, []), ("a", 9): (None, []), ("b", 1): (None, []), ("b", 2): (0, [3, 4])}
    hashed = lambda t: t.agg(F.count("*"), F.sum(F.xxhash64(*[F.col(c).cast("string") for c in df.columns]).cast("decimal(38,0)"))).first()
    assert hashed(turns.to_events(made)) == hashed(df) and turns.to_events(made).columns == df.columns
    assert turns.to_events(turns.to_turns(df.limit(0), ["k"], "pos")).count() == 0


def test_merged_chains(spark):
    rows = [("a", 1, "assistant", "x", ["1"], None), ("a", 2, "toolResult", "", [], "1"), ("a", 3, "assistant", "y", ["2", "3"], None), ("a", 4, "toolResult", "", [], "2"), ("a", 5, "assistant", "says", [], None), ("a", 6, "assistant", "z", ["4"], None)]
    got = turns.merge_chains(spark.createDataFrame(rows, ROWS), ["k"], "pos").orderBy("pos").collect()
    assert [(r["pos"], list(r["calls"]), r["text"]) for r in got] == [(1, ["1", "2", "3"], "x"), (2, [], ""), (4, [], ""), (5, [], "says"), (6, ["4"], "z")]


def test_a_thousand_inserts(spark):
    """Rows go in before and behind rows, and again around those that went in; parents lead up in order and times don't go back."""
    n = 300
    rows = spark.createDataFrame([(1, i, f"e{i}", f"e{i - 1}" if i else None, 1000 * i, f"t{i}") for i in range(n)], "k int, pos long, id string, parent string, ms long, text string")
    now = splices.with_labels(rows, "pos").select("k", "label", "id", "parent", "ms", "text")
    want = [f"e{i}" for i in range(n)]
    for step in range(3):
        picked = [x for i, x in enumerate(want) if i % 3 == step % 3]
        inserts = [(1, x, side, s, f"{x}/{step}{'b' if side < 0 else 'a'}{s}", f"in{step}") for x in picked for side, s in ((-1, 2), (-1, 1), (1, 1))]
        df = spark.createDataFrame([*inserts, (1, "no such row", 1, 1, "never", "x")], "k int, _at string, side int, seq int, id string, text string")
        df = df.join(now.select("k", F.col("id").alias("_at"), "label"), ["k", "_at"], "left")
        now = checkpoint(splices.insert_rows(now, df, ["k"], ["text"], step))
        want = [y for i, x in enumerate(want) for y in ([f"{x}/{step}b1", f"{x}/{step}b2", x, f"{x}/{step}a1"] if i % 3 == step % 3 else [x])]
    got = now.orderBy("label").collect()
    assert [r["id"] for r in got] == want and len(want) > n + 1000
    assert [r["parent"] for r in got] == [None, *want[:-1]]
    assert [r["ms"] for r in got] == sorted(r["ms"] for r in got)


def test_circles_are_marked(spark):
    links = [("a", "x", "y"), ("a", "y", "z"), ("a", "z", "x"), ("a", "w", "x"), ("a", "p", "q"), ("a", "q", "end"), ("b", "m", "n"), ("b", "n", None), ("c", "s", "s")]
    got = {(r["k"], r["node"]): (r["to"], r["cyclic"]) for r in E.follow_links(spark.createDataFrame(links, "k string, node string, to string"), checkpoint).collect()}
    assert got == {**{("a", v): (None, True) for v in "xyzw"}, ("a", "p"): ("end", False), ("a", "q"): ("end", False), ("b", "m"): (None, False), ("b", "n"): (None, False), ("c", "s"): (None, True)}


def by_stream(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["submission"], r["pos"])):
        out[r["submission"]].append(r)
    return out


def plain_normaliser(rows):
    """Branch, stubs, runs, orphans, parents, one after another."""
    at = {r["id"]: r for r in rows}
    way, node, whole = [], rows[-1]["id"], False
    while node in at and node not in way:
        way.append(node)
        node = at[node]["parent"]
        whole |= node is not None and node not in at
    if whole or len(way) < max(2, len(rows) // 2):
        way = list(at)
    kept, moved = [], {}
    for r in [dict(r.asDict()) for r in rows if r["id"] in way]:
        if r["role"] == "assistant" and not r["has_call"] and not r["text"].strip():
            moved[r["id"]] = r["parent"]
        else:
            kept.append(r)
    for r in kept:
        seen = set()
        while r["parent"] in moved and r["parent"] not in seen:
            seen.add(r["parent"])
            r["parent"] = moved[r["parent"]]
    joined = []
    for r in kept:
        before = joined[-1] if joined else None
        if before and all(x["role"] == "assistant" and not x["has_call"] for x in (r, before)):
            dull = [any(p in x["text"].lower() for p in ("denied plaintext", "can't append to the denied plaintext file")) for x in (before, r)]
            if before["text"] == r["text"] or not dull[0] and dull[1]:
                continue
            before["text"] = r["text"] if dull[0] else "\n\n".join(t for t in (before["text"], r["text"]) if t)
        else:
            joined.append(r)
    made, out = set(), []
    for r in joined:
        if r["role"] != "toolResult" or r["ref"] in made and r["ref"]:
            out.append(r)
        if r["call_id"]:
            made.add(r["call_id"])
    ids, last = set(), None
    for r in out:
        r["parent"] = r["parent"] if r["parent"] in ids else last
        ids.add(r["id"])
        last = r["id"]
    return [(r["event_id"], r["text"], r["parent"]) for r in out]


def test_normaliser(spark, sf):
    got = defaultdict(list)
    for r in sorted(plans.normalised_streams(spark, sf).collect(), key=lambda r: r["pos"]):
        assert r["cyclic"] == (r["submission"] % 7 == 0)
        got[r["submission"]].append((r["event_id"], r["text"], r["parent"]))
    want = {s: plain_normaliser(rows) for s, rows in by_stream(plans._circular(spark, sf).collect()).items()}
    assert got == {s: rows for s, rows in want.items() if rows}
    assert 0 < sum(map(len, want.values())) < 1000


def keys_in(value):
    if isinstance(value, dict):
        return set(value) | set().union(*map(keys_in, value.values()), set())
    return set().union(*map(keys_in, value), set()) if isinstance(value, list) else set()


def plain_codes(lines):
    """Both sets of checks over one stream's lines, in one loop."""
    first, second = [], []
    ids, calls, before = set(), set(), None
    ids2, calls2, before2, time, parts = set(), set(), "", None, []
    for at, line in lines:
        try:
            e = json.loads(line)
        except ValueError:
            e = None
        if not isinstance(e, dict):
            first.append((at, "non_object_event"))
            second.append((at, "event is not an object"))
            continue
        name = e.get("id") if isinstance(e.get("id"), str) else None
        message = e.get("message")
        content = message.get("content", []) if isinstance(message, dict) else []
        made = [c["id"] if isinstance(c.get("id"), str) else "" for c in content if c["type"] == "toolCall"]
        text = any(c["type"] == "text" and c["text"].strip() for c in content)
        ref = message.get("toolCallId") if isinstance(message, dict) else None
        parent = e.get("parentId") or None
        # what makes it unusable
        if not name:
            first.append((at, "missing_event_id"))
        elif name in ids:
            first.append((at, "duplicate_event_id"))
        if parent and parent not in ids:
            first.append((at, "parent_not_seen"))
        if e["type"] == "custom" and e["customType"].startswith("exec.approval."):
            before = None
        broken = e["type"] == "message" and not isinstance(message, dict)
        if broken:
            first.append((at, "message_not_object"))
        elif e["type"] == "message":
            role = message["role"] if message["role"] in log_checks.ROLES else None
            if role is None:
                first.append((at, "invalid_message_role"))
            if role == "assistant":
                first += [(at, "consecutive_assistant_messages")] * (before == "assistant") + [(at, "empty_assistant_message")] * (not text and not made)
                for c in made:
                    first += [(at, "tool_call_missing_id")] * (not c) + [(at, "duplicate_tool_call_id")] * (c in calls)
                    calls |= {c} - {""}
            if role == "toolResult":
                first += [(at, "tool_result_missing_tool_call_id")] * (not ref) + [(at, "orphan_tool_result")] * (bool(ref) and ref not in calls)
            before = role or before
        if name and not broken:
            ids.add(name)
        # what a delivered file must not show
        second += [(at, "missing id")] * (name is None) + [(at, "duplicate id")] * (name in ids2) + [(at, "id contains synth")] * ("synth" in (name or ""))
        second += [(at, "parent not prior")] * (parent is not None and parent not in ids2) + [(at, "construction key")] * bool(keys_in(e) & {"is_adversarial", "attack_type", "is_synthetic", "_synthetic"})
        stamp = e["timestamp"]
        if isinstance(stamp, str):
            from datetime import datetime

            stamp = round(datetime.fromisoformat(stamp).timestamp() * 1000)
        parts.append(stamp % 1000)
        second += [(at, "time backwards")] * (time is not None and stamp < time)
        time = stamp
        role = message.get("role") if isinstance(message, dict) else ""
        if role == "assistant":
            second += [(at, "consecutive assistant")] * (before2 == "assistant") + [(at, "empty assistant")] * (not text and not made)
            for c in made:
                second += [(at, "call id missing")] * (not c) + [(at, "duplicate call id")] * (c in calls2) + [(at, "call id contains synth")] * ("synth" in c)
                calls2 |= {c} - {""}
        if role == "toolResult":
            second += [(at, "result id missing")] * (not ref) + [(at, "unknown result ref")] * (bool(ref) and ref not in calls2)
        before2 = role if role in log_checks.ROLES else before2
        ids2 |= {name} - {None}
    if len(parts) >= 4 and len(set(parts)) == 1:
        second.append((lines[-1][0], "constant milliseconds"))
    return set(first), set(second)


def test_codes_of_raw_lines(spark, sf):
    lines = by_stream(plans.log_lines(spark, sf).collect())
    want = {s: plain_codes([(r["pos"], r["line"]) for r in rows]) for s, rows in lines.items()}
    for k, query in enumerate((plans.log_stream_codes, plans.log_delivery_codes)):
        got = defaultdict(set)
        rows = query(spark, sf).collect()
        for r in rows:
            got[r["submission"]].add((r["pos"], r["code"]))
        assert len(rows) == sum(map(len, got.values()))
        for s in want:
            assert got[s] == want[s][k], (s, got[s] ^ want[s][k])
        found = Counter(r["code"] for r in rows)
        assert len(found) >= (12, 14)[k], found


def test_codes_of_odd_lines(spark):
    lines = ['{"type": "session", "id": "s"}', '{"type": "message", "message": {"role": "assistant", "content": "x"}, "createdAt": 1005}', "null", '"id"', '{"type": "message", "id": "m", "message": {"role": "assistant", "content": [{"type": "image", "url": "u"}]}, "timestamp": "2024-01-01T00:00:00.005Z"}', None, '{"id": "z", "timestamp": 1700000000005}', '{"id": "z", "timestamp": 1700000001005}']
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "k int, pos long, line string")
    got = {(r["pos"], r["code"]) for r in log_checks.delivery_codes(df, ["k"], "pos").collect()}
    assert got == {(1, "missing id"), (1, "empty assistant"), (2, "event is not an object"), (3, "event is not an object"), (5, "event is not an object"), (4, "consecutive assistant"), (6, "time backwards"), (7, "duplicate id"), (7, "constant milliseconds")}
    got = {(r["pos"], r["code"]) for r in log_checks.stream_codes(df, ["k"], "pos").collect()}
    assert {(1, "missing_event_id"), (4, "empty_assistant_message"), (7, "duplicate_event_id")} <= got
