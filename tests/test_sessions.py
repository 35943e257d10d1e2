"""Archives, session choice, dimensions and logs on small files written here."""

import json
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from lodestream.sources import sessions as S


def log(*messages):
    return "\n".join([json.dumps({"type": "session", "id": "s"}), *(json.dumps({"type": "message", "id": f"e{i}", "message": m}) for i, m in enumerate(messages))])


CALL = {"type": "toolCall", "id": "c1", "name": "read", "arguments": {"path": "a.md"}}
TALK = log(
    {"role": "user", "content": [{"type": "text", "text": "hello"}]},
    {"role": "assistant", "content": [{"type": "thinking", "thinking": "hm"}, {"type": "text", "text": "hi"}, CALL]},
    {"role": "toolResult", "toolCallId": "c1", "toolName": "read", "content": [{"type": "text", "text": "the contents of it"}]},
    {"role": "user", "content": "HEARTBEAT"},
    {"role": "user", "content": "more"},
    {"role": "assistant", "content": "done"},
)


@pytest.fixture(scope="module")
def members(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("zips")
    index = {"k1": {"sessionId": "one", "sessionStartedAt": "2024-01-01T00:00:10Z", "updatedAt": "2024-01-03T00:00:00Z"}, "k2": {"sessionId": "two", "sessionStartedAt": "2024-01-02T00:00:00Z", "updatedAt": "2024-01-02T01:00:00Z"}, "k3": {"sessionId": "gone", "updatedAt": 9999999999999}}
    with zipfile.ZipFile(d / "a.zip", "w") as z:
        z.writestr("final-snapshot/sessions/sessions.json", json.dumps(index))
        z.writestr("initial-snapshot/sessions/sessions.json", "{}")
        z.writestr("final-snapshot/sessions/one.jsonl", TALK)
        z.writestr("final-snapshot/sessions/one.trajectory.jsonl", TALK * 3)
        z.writestr("final-snapshot/sessions/two.jsonl", log({"role": "user", "content": "only me"}))
        z.writestr("final-snapshot/workspace/trajectories/sess-1704067210000000-T-001-02.jsonl", "{}")
        z.writestr("final-snapshot/workspace/trajectories/sess-1704000000000-T-009-09.jsonl", "{}")
        z.writestr("final-snapshot/x/workspace/notes/a.md", b"caf\xe9")
        z.writestr("final-snapshot/x/workspace/.git/b", "x")
        z.writestr("initial-snapshot/x/workspace/old.md", "old")
    with zipfile.ZipFile(d / "b.zip", "w") as z:
        z.writestr("sessions/p.jsonl", TALK)
        z.writestr("sessions/q.jsonl", "not json")
        z.writestr("z.jsonl", TALK * 9)
        z.writestr("y/workspace/skills/find/SKILL.md", "# Finds things\nmore")
    (d / "c.zip").write_bytes(b"broken")
    return S.read_members(spark, str(d)).withColumn("archive", F.element_at(F.split("archive", "/"), -1))


def test_session_choice(members):
    got = {r["archive"]: (r["task_id"], r["name"]) for r in S.choose_sessions(members).collect()}
    assert got == {"a.zip": ("T-001-02", "final-snapshot/sessions/one.jsonl"), "b.zip": (None, "sessions/p.jsonl")}
    index = {r["session_id"]: (r["started"], r["updated"]) for r in S.session_index(members).collect()}
    assert index == {"one": (1704067210000, 1704240000000), "two": (1704153600000, 1704157200000), "gone": (0, 9999999999999)}


def test_workspaces(members):
    files = lambda s: sorted((r["archive"], r["path"], r["content"]) for r in S.workspace_files(members, s).filter("NOT path LIKE 'trajectories/%'").collect())
    assert files("final") == [("a.zip", "notes/a.md", "caf�"), ("b.zip", "skills/find/SKILL.md", "# Finds things\nmore")]
    assert files("initial") == [("a.zip", "old.md", "old")]
    skills = S.installed_skills(S.workspace_files(members), ["archive"]).collect()
    assert [(r["skill"], r["description"], r["tier"]) for r in skills] == [("find", "Finds things", 3)]


def lines_of(spark, *texts):
    return spark.createDataFrame([(f"s{n}", i, line) for n, t in enumerate(texts) for i, line in enumerate(t.split("\n"))], "session string, pos long, json string")


def test_standard_log(spark):
    m = S.parse_log(lines_of(spark, TALK)).cache()
    assert [(r["number"], r["text"]) for r in S.user_messages(m).orderBy("pos").collect()] == [(0, "hello"), (1, "more")]
    turns = S.assistant_turns(m)
    assert [(r["turn"], r["thinking"], r["texts"], r["event_id"]) for r in turns.orderBy("turn").collect()] == [(0, ["hm"], ["hi"], "e1"), (1, [], ["done"], "e5")]
    calls = S.tool_calls(turns).collect()
    assert [(r["turn"], r["call_id"], r["tool"], json.loads(r["arguments"])) for r in calls] == [(0, "c1", "read", {"path": "a.md"})]
    assert [(r["call_id"], r["tool"], r["content"], r["is_empty"]) for r in S.tool_results(m).collect()] == [("c1", "read", "the contents of it", False)]
    assert [(r["kind"], r["which"]) for r in S.thread_order(m).orderBy("pos").collect()] == [("user", "0"), ("assistant", "0"), ("tool", "c1"), ("user", "1"), ("assistant", "1")]


def test_native_logs(spark):
    done = lambda prompt, *m: json.dumps({"type": "model.completed", "data": {"finalPromptText": prompt, "messagesSnapshot": list(m)}})
    u, a = {"role": "user", "content": "q"}, {"role": "assistant", "content": [{"type": "text", "text": "r"}]}
    start = json.dumps({"type": "session.started", "sessionId": "abc"})
    prompt = json.dumps({"type": "prompt.submitted", "data": {"prompt": "just asked"}})
    logs = ("\n".join([start, done("x", u, a), done("heartbeat", u, a, u, a)]), "\n".join([start, done("heartbeat", u), done("Heartbeat", u, a, u)]), "\n".join([start, prompt, "broken {"]))
    m = S.parse_log(lines_of(spark, *logs))
    got = {}
    for r in m.orderBy("session", "pos").collect():
        got.setdefault(r["session"], []).append((r["role"], r["blocks"][0]["text"], r["session_id"]))
    assert got == {"s0": [("user", "q", "abc"), ("assistant", "r", "abc")], "s1": [("user", "q", "abc"), ("assistant", "r", "abc"), ("user", "q", "abc")], "s2": [("user", "just asked", "abc")]}


def test_dimensions(spark, tmp_path):
    (tmp_path / "tiers.json").write_text('{"T1": ["read", "exec"], "T3": ["browser", "exec"]}')
    assert {r["tool"]: r["tier"] for r in S.read_inverted(spark, str(tmp_path / "tiers.json"), "tier", "tool").collect()} == {"read": "T1", "exec": "T3", "browser": "T3"}
    (tmp_path / "labels.json").write_text('{"ID_EMAIL": "L2", "X": "L4"}')
    assert {r["label"]: r["level"] for r in S.read_labels(spark, str(tmp_path / "labels.json")).collect()} == {"ID_EMAIL": "L2", "X": "L4"}
    (tmp_path / "p.json").write_text('{"personas": [{"persona_id": "P-1", "n": 1}, {"persona_id": "P-2", "n": 2}]}')
    assert S.read_json_dimension(spark, str(tmp_path / "p.json"), "persona_id", "personas").count() == 2
    (tmp_path / "t1.csv").write_text("task_id,goal\nP-1-01,a\nT-2-01,b\n")
    (tmp_path / "t2.csv").write_text("task_id,goal\nT-1-01,c\n")
    tasks = {r["task_id"]: (r["goal"], r["task_uuid"]) for r in S.read_tasks(spark, [str(tmp_path / "t1.csv"), str(tmp_path / "t2.csv")]).collect()}
    assert tasks == {t: (g, str(uuid.uuid5(uuid.NAMESPACE_DNS, t))) for t, g in (("T-1-01", "c"), ("T-2-01", "b"))}
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{broken\n')
    with pytest.raises(Exception):  # noqa: B017
        S.read_strict_lines(spark, str(tmp_path / "bad.jsonl"), "a long").collect()
    (tmp_path / "c").mkdir()
    for n in "ba":
        (tmp_path / "c" / f"{n}.jsonl").write_text(f'{{"file": "{n}"}}\n')
    assert [r["file"] for r in S.read_corpus(spark, str(tmp_path / "c"), 1).collect()] == ["a.jsonl"]
    (tmp_path / "memory").mkdir()
    (tmp_path / "memory" / "x.md").write_text("m")
    (tmp_path / "y.md").write_text("n")
    assert [r["content"] for r in S.read_memory_files(spark, str(tmp_path)).collect()] == ["m"]


def test_sinks(spark, tmp_path):
    reports = spark.createDataFrame([("a", "PASS", 0), ("b", "MINOR_FIXED", 2), ("c", "FAIL", 0)], "submission_id string, status string, n_gate_issues long")
    samples = spark.createDataFrame([(x, "t" + x) for x in "abcd"], "submission_id string, text string")
    S.write_training_records(reports, samples, str(tmp_path / "sft"))
    assert {(r["text"], r["_source"]["status"]) for r in spark.read.json(str(tmp_path / "sft")).collect()} == {("ta", "PASS"), ("tb", "MINOR_FIXED")}
    r = S.batch_report(reports).first()
    assert (r["total"], r["passed"], r["fixed"], r["production_ready"], r["pass_rate"]) == (3, 1, 1, 1, "66.7%")
    S.append_completed(reports, str(tmp_path / "done"))
    assert spark.read.parquet(str(tmp_path / "done")).count() == 3
    new = spark.createDataFrame([("a", "new")], "submission_id string, text string")
    assert {r["submission_id"]: r["text"] for r in S.latest_by_id(samples, new, "submission_id").collect()}["a"] == "new"
    rows = spark.createDataFrame([("s", "1", None, "c", None), ("s", "2", "1", None, "c")], "submission string, id string, parent string, call_id string, ref string")
    got = {r["source_id"]: r for r in S.remap_ids(rows, ["submission"]).collect()}
    assert got["2"]["parent"] == got["1"]["id"] and got["2"]["ref"] == got["1"]["call_id"] and len(got["1"]["id"]) == 24


def test_samples_and_headers(spark, tmp_path):
    rows = spark.createDataFrame([(f"f{i % 4}", "x" * (10 * i)) for i in range(12)] + [("f0", "HEARTBEAT " + "y" * 30)], "file string, text string")
    picked = S.sampled_messages(rows, "file", "text", 2, 15, 100)
    found = picked.collect()
    assert len({r["file"] for r in found}) == 2 and all(15 < len(r["text"]) < 100 and "HEART" not in r["text"] for r in found)
    assert sorted(map(tuple, picked.collect())) == sorted(map(tuple, found))  # the same seed, the same sample
    assert {len(r["opener"]) for r in S.openers(rows, "text", 30, 50).collect()} == {40, 50}
    head = S.session_header(spark.createDataFrame([("a",)], "submission string"), "submission").orderBy("pos").collect()
    assert [(r["pos"], r["type"], r["is_synthetic"]) for r in head] == [(-4, "session", True), (-3, "model_change", True), (-2, "thinking_level_change", True), (-1, "custom", True)]
    (tmp_path / "d.md").write_text("abcdef")
    assert [r["text"] for r in S.digest(spark, str(tmp_path), 4).collect()] == ["abcd"]
    lines = spark.createDataFrame([("keep\ndo not save this\n__PII_REDACTED__",)], "c string")
    assert lines.select(S.safe_lines(F.col("c")).alias("s")).first()["s"] == ["do not save this", "__PII_REDACTED__"]
